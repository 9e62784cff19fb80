"""Phrase collocation mining: the trie, its spilling, the merge, whole results against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sentinela.llm import collocations
from tests.llm.helpers import awkward, empty


def brute(rows, widest=5, least=3, percent=100, first=2000):
    """The contract in plain Python; rows are (lang, text)."""
    counts, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", lowered):
            w = tuple(re.findall("[^\\x20\\x09]+", piece))
            words[lang] += len(w)
            for k in range(1, widest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, w[i:i + k]] += 1
    cands = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in cands.items():
        if any(g == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * b >= percent * a for (g, q), b in cands.items()):
            continue
        cuts = [(1000 * a * words[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], words[lang], score))
    ranked = []
    for lang in sorted({r[0] for r in out}):
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:first])]
    return ranked


def mined(df, **kw):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(df, **kw).collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "é日", "a", "b", "c-d", "<x>", "ß", "İ"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts.append(rng.choice(vocabulary) if rng.random() < 0.7 else "new york of the")
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "; "]))
        rows.append((rng.choice(["en", "fr", "", None, "und"]), "".join(parts)))
    return rows


@pytest.mark.parametrize("seed, percent, first, widest", [(1, 100, 2000, 5), (2, 60, 7, 5), (3, 100, 2000, 2)])
def test_brute_force(spark, seed, percent, first, widest):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert mined(df, widest=widest, least=3, percent=percent, first=first) == brute(rows, widest, 3, percent, first)


def test_spills_do_not_change_counts(spark, monkeypatch):
    rows = corpus(4, 200)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    whole = mined(df, least=3)

    def counts(held, burst, batch):
        monkeypatch.setattr(collocations, "BATCH_BYTES", batch)
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])]
        runs = [b.to_pylist() for b in collocations.counter(3, None, held, burst)(iter(batches))]
        total = Counter()
        for run in runs:
            total.update({(r["lang"], r["phrase"]): r["n"] for r in run})
        return total, runs

    small, runs = counts(40, 5, 500)
    large, one = counts(10**6, 4096, 1 << 22)
    assert small == large and len(runs) > 20 and len(one) == 1
    in_words = [[(r["lang"], r["phrase"].split(" ")) for r in run] for run in runs]
    assert all(run == sorted(run) for run in in_words)  # sorted runs
    assert whole == brute(rows)


def entries(parts):
    return {tuple(row): n for rows, counts in parts for row, n in zip(rows.tolist(), counts.tolist())}


def test_trie_bursts_and_spills_whole_subtrees():
    trie, rng, want = collocations.HatTrie(4, burst=8), random.Random(5), Counter()
    for _ in range(100):
        some = Counter((rng.randint(0, 1), rng.randint(0, 30) ** 3 // 3, rng.randint(0, 9), rng.randint(0, 70_000)) for _ in range(30))
        rows = sorted(some)
        trie.add(np.array(rows), np.array([some[r] for r in rows]))
        want.update(some)
    assert trie.entries == len(want) == trie.root.size() and trie.root.next is not None
    assert all(len(held) <= 8 or len(path) == 7 for path, held in trie.root.containers())
    out = entries(trie.spill(trie.entries // 2))
    assert trie.entries == len(want) - len(out) <= len(want) // 2
    left = Counter(want)
    left.subtract(out)
    left = {k: n for k, n in left.items() if n}
    assert all(want[k] == n for k, n in out.items()) and not {k[:2] for k in out} & {k[:2] for k in left}
    assert entries(trie.spill(0)) == left and trie.entries == 0
    trie.add(np.zeros((0, 4)), np.zeros(0))
    assert list(trie.spill(0)) == []


def test_hot_first_word_and_filter(spark, monkeypatch):
    """A first word with a third of all words takes several partitions; a filter of few bits costs work only."""
    monkeypatch.setattr(collocations, "HEADS", 16)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 16)
    rng = random.Random(6)
    rows = [("en", " ".join(w for _ in range(30) for w in ("hot", f"w{rng.randint(0, 12)}", f"v{rng.randint(0, 300)}"))) for _ in range(60)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert mined(df, least=5) == brute(rows, least=5)


def test_large_counts_are_exact(spark):
    """The quotient of products beyond 64 bits."""
    a, n, l, r = 123_456_789_012, 98_765_432_109_876, 234_567_890_123, 345_678_901_234
    df = spark.createDataFrame([(a, n, l, r)], "a bigint, n bigint, l bigint, r bigint")
    assert df.selectExpr(f"{collocations.SCORE} AS s").first().s == 1000 * a * n // (l * r)


def test_words_of_a_column():
    ids, vocabulary, text, goes_on = collocations.word_ids(pa.array(["A b\tB.c", None, "", " d\x0ce f!", "g"]))
    assert vocabulary.take(pa.array(ids)).to_pylist() == ["a", "b", "b", "c", "d", "e", "f", "g"]
    assert text.tolist() == [0, 0, 0, 0, 3, 3, 3, 4] and goes_on.tolist() == [False, True, True, False, False, False, True, False]
    first, n = collocations.distinct_rows([np.array([1, 1, 2, 1]), np.array([5, 5, 5, 6])])
    assert sorted(zip(first.tolist(), n.tolist())) == [(0, 2), (2, 1), (3, 1)]


def test_awkward(spark):
    docs = awkward(spark, extra=[(30 + i, "same few words. " * 5 + "x" * i) for i in range(4)])
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert mined(docs, least=4) == brute(rows, least=4)
    assert mined(docs, least=10**6) == [] and mined(empty(docs)) == []
    blank = spark.createDataFrame([(None, None), ("en", ""), ("en", " .\n")], "lang string, text string")
    assert mined(blank) == []
