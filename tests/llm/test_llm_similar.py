"""Similarity joins, line dedup, vectors, components."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sentinela import session
from sentinela.llm import ann, ego, jaccard_join, line_dedup
from sentinela.llm.graph import components
from tests.llm.helpers import awkward, documents, empty, words


class Groups:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 500)] + [(600, x) for x in range(601, 700)]
    want = Groups({x for e in edges for x in e})
    for a, b in edges:
        want.link(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*edges, (None, 5), (7, None)], "a bigint, b bigint")).collect()}
    assert got == {x: want.find(x) for x in want.up if any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set()


def brute_force(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    groups = Groups(texts)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                groups.link(a, b)
    return {i: (len(sets[i]), groups.find(i)) for i in texts}


def mutated(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(["alpha", "beta", "gamma", "delta"])
    return " ".join(w)


@pytest.mark.parametrize("block", [256, 8])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(block)
    common = words(rng, 30)
    texts = [words(rng, rng.randint(1, 90)) for _ in range(60)]
    texts += [common + " " + words(rng, rng.randint(1, 60)) for _ in range(30)]
    for family in range(4):
        base = words(rng, 40 + 60 * family)
        texts += [mutated(rng, base, rng.randint(0, 1 + 2 * family)) for _ in range(25)]
    texts += ["one two", "one  TWO", "one two three", texts[0].upper(), "", " "]
    want = brute_force(dict(enumerate(texts)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(spark, texts)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(texts) - 40


def test_jaccard_join_without_families(spark, monkeypatch):
    """The trees alone find every link too."""
    monkeypatch.setattr(jaccard_join, "_families", lambda batches: iter(()))
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rng = random.Random(5)
    base = words(rng, 90)
    texts = [mutated(rng, base, 2) for _ in range(30)] + [words(rng, 40) for _ in range(20)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(spark, texts)).collect()}
    assert got == brute_force(dict(enumerate(texts)))


def test_jaccard_awkward(spark):
    docs = awkward(spark)
    rows = jaccard_join.jaccard_components(docs).collect()
    assert len(rows) == docs.count()
    want = brute_force({r["doc_id"]: r["text"] for r in docs.where("doc_id IS NOT NULL").collect()})
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == ((None, None) if r["doc_id"] is None else want[r["doc_id"]])
    kept = [r["doc_id"] for r in jaccard_join.keep_one(docs).collect()]
    assert sorted(kept, key=lambda x: (x is not None, x)) == [None, None, 1, 4, 5, 6, 7, 8, 10, 11]
    assert jaccard_join.keep_one(docs).columns == docs.columns
    assert jaccard_join.jaccard_components(empty(docs)).collect() == []


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(11)
    pool = [words(rng, rng.randint(4, 40)) for _ in range(60)]
    pool += [mutated(rng, pool[i], 1) for i in range(40)] + [pool[3].upper() + " !!", "short line", ""]
    texts = ["\n".join(rng.choice(pool) if rng.random() < 0.6 else words(rng, 12) for _ in range(rng.randint(1, 6))) for _ in range(80)]
    docs = documents(spark, texts)
    # the hashes are taken from the operator, all else is done again here
    occurrences = line_dedup.occurrences(docs, "doc_id", "text").collect()
    first, sims = {}, {}
    for r in sorted(occurrences, key=lambda r: (r["doc_id"], r["text_hash"], r["pos"])):
        first.setdefault(r["norm"], (r["doc_id"], r["pos"]))
        sims[r["norm"]] = r["sim"]
    groups = Groups(range(len(sims)))
    lines = sorted(sims, key=first.get)
    for j, b in enumerate(lines):
        for i, a in enumerate(lines[:j]):
            if ((sims[a] ^ sims[b]) & (2**64 - 1)).bit_count() <= line_dedup.BITS:
                top = max(len(a), len(b))
                if levenshtein(a, b) <= int(top * (1 - line_dedup.SIMILARITY) + 1e-9):
                    groups.link(i, j)
    keep = {first[lines[groups.find(i)]] for i in range(len(lines))}
    drop = {(r["doc_id"], r["pos"]) for r in occurrences} - keep
    assert any(groups.find(i) != i for i in range(len(lines)))
    for r in line_dedup.drop_duplicate_lines(docs).collect():
        want = [x for k, x in enumerate(texts[r["doc_id"]].split("\n")) if (r["doc_id"], k) not in drop]
        assert (r["text"], r["n_lines"]) == ("\n".join(want), len(texts[r["doc_id"]].split("\n")))


def test_simhash_of_long_lines(spark, monkeypatch):
    rng = random.Random(2)
    rows = spark.createDataFrame([(i, words(rng, n)) for i, n in enumerate((4, 119, 120, 121, 700, 5000))], "i int, norm string").withColumn("words", F.split("norm", " "))
    short = {r["i"]: r["sim"] for r in line_dedup.with_simhash(rows).collect()}
    bits = rows.select("i", F.explode("words").alias("w")).select("i", F.xxhash64("w").alias("h")).collect()
    for i, sim in short.items():
        own = np.array(sorted({r["h"] for r in bits if r["i"] == i}), dtype=np.int64).view(np.uint64)
        want = sum(1 << b for b in range(64) if 2 * int(((own >> np.uint64(b)) & np.uint64(1)).sum()) > len(own))
        assert sim & (2**64 - 1) == want
    monkeypatch.setattr(line_dedup, "WIDE_CHUNKS", 2)
    assert {r["i"]: r["sim"] for r in line_dedup.with_simhash(rows).collect()} == short


def test_line_dedup_awkward(spark):
    docs = awkward(spark)
    rows = line_dedup.drop_duplicate_lines(docs).collect()
    assert len(rows) == docs.count() and rows[0]["score"] == "x"
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[4]["text"] is None and by_id[4]["n_lines"] == 0 and by_id[5]["text"] == "" and by_id[8]["text"] == "one two"
    assert sum((r["text"] or "").startswith(docs.first()["text"][:20]) for r in rows) == 1  # of the copies, the one of the null id
    assert line_dedup.drop_duplicate_lines(empty(docs)).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, score string")


def some_vectors(rng, n=300, d=16):
    x = rng.normal(size=(n, d))
    x[100:160] = x[100] + 0.05 * rng.normal(size=(60, d))
    x[200:230] = x[200] * rng.uniform(0.5, 2, size=(30, 1)) + 0.02 * rng.normal(size=(30, d))
    return x.astype(np.float32)


AWKWARD_VECTORS = [(1000, None, 0, "x"), (1001, [0.0] * 16, 0, "x"), (1002, [1.0, None] + [0.0] * 14, 0, "x"), (1003, [float("nan")] * 16, 0, "x"),
                   (1004, [float("inf")] + [1.0] * 15, 0, "x"), (1005, [1.0, 2.0], 0, "x"), (None, [1.0] * 16, 0, "x"), (1006, [1.0] * 16, None, "x"), (1007, [], 0, "x")]


@pytest.mark.parametrize("block", [256, 16])
def test_grid_order_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ego, "BLOCK_ROWS", block)
    x = some_vectors(np.random.default_rng(3))
    label = np.arange(len(x)) % 2
    got = {r["vec_id"]: r for r in ego.near_duplicates(vectors(spark, [(i, v.tolist(), int(c), "x") for i, (v, c) in enumerate(zip(x, label))] + AWKWARD_VECTORS)).collect()}
    y = x.astype(np.float64)
    cos = (y @ y.T) / np.linalg.norm(y, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None]
    linked = (cos >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    groups = Groups(range(len(x)))
    for a, b in zip(*np.nonzero(linked)):
        groups.link(int(a), int(b))
    assert linked.sum() > 100
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (linked[i].sum(), groups.find(i), groups.find(i) == i)
    for i in (1000, 1001, 1002, 1003, 1004, 1005, 1006, 1007):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert len(got) == len(x) + 9


def test_vectors_empty_and_repeated(spark):
    rows = [(1, [1.0, 0.0], 5, "x"), (1, [1.0, 0.0], 5, "x"), (2, [1.0, 0.0], 5, "x"), (3, [0.0, 1.0], 5, "x")]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in ego.near_duplicates(vectors(spark, rows)).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    none = vectors(spark, rows).where("false")
    assert ego.near_duplicates(none).collect() == [] and ann.search(none, none).collect() == []
    found = ann.search(vectors(spark, rows), vectors(spark, rows), 10).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(found, key=lambda r: (r["query_id"], r["rank"]))] == [
        (1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2)]


def test_graph_search_recall(spark):
    x = some_vectors(np.random.default_rng(8), 2500, 24)
    rows = vectors(spark, [(i, v.tolist(), 0, "x") for i, v in enumerate(x)] + AWKWARD_VECTORS)
    found = ann.search(rows, rows.where("vec_id % 50 = 0"), 10, shard_rows=1000).collect()
    y, hits, queries = x.astype(np.float64), 0, 0
    for q in range(0, 2500, 50):
        d = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = set(np.lexsort((np.arange(len(y)), d))[:10].tolist())
        got = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 11)) and all(abs(d[r["vec_id"]] - r["score"]) < 1e-9 for r in got)
        assert [(r["score"], r["vec_id"]) for r in got] == sorted((r["score"], r["vec_id"]) for r in got)
        hits, queries = hits + len(best & {r["vec_id"] for r in got}), queries + 1
    assert hits / (10 * queries) >= 0.95


def test_graph_search_among_equal_vectors(spark):
    """A third of the rows are one vector, many others are in groups of equal ones."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2400, 16)).astype(np.float32)
    x[::3] = x[0]
    x[1:900:3] = x[rng.integers(0, 20, 300) * 3 + 1]
    x[3:600:30, 0] += np.float32(0.05)
    x[6, 2] = -0.0
    x[9] = x[6]
    x[9, 2] = 0.0
    rows = vectors(spark, [(i, v.tolist(), 0, "x") for i, v in enumerate(x)])
    found = {}
    for r in ann.search(rows, rows.where("vec_id % 48 < 8"), 10, shard_rows=600).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    y, hits = x.astype(np.float64), 0
    assert len(found) == 400
    for q, rows in found.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(y)), d))[:10]
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11)) and all(abs(d[i] - s) < 1e-9 for _, s, i in rows)
        equal = [i for i in best.tolist() if d[i] == 0]
        assert [i for _, _, i in rows][:len(equal)] == equal
        hits += len(set(best.tolist()) & {i for _, _, i in rows})
    assert hits / 4000 >= 0.95


@pytest.mark.parametrize("width, percent", [(5, 80), (3, 60)])
def test_jaccard_join_of_another_rule(spark, width, percent):
    rng = random.Random(width)
    texts = [mutated(rng, base, n) for base in (words(rng, 120), words(rng, 300)) for n in (0, 1, 2, 3, 4, 6, 8, 10)]
    texts += [words(rng, rng.randint(1, 60)) for _ in range(20)] + ["one two three four", "one two three  FOUR", ""]

    def own(text):
        w = text.lower().split()
        return {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()

    sets, groups = [own(t) for t in texts], Groups(range(len(texts)))
    for a, b in ((a, b) for b in range(len(texts)) for a in range(b)):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            groups.link(a, b)
    rows = jaccard_join.jaccard_components(documents(spark, texts), width=width, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {i: (len(s), groups.find(i)) for i, s in enumerate(sets)}


def test_pipeline_takes_five_words_and_four_fifths(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(1000)]
    near = [f"x{i}" if i % 45 == 20 and i < 990 else w for i, w in enumerate(base)]  # 22 spread edits
    more = base + [f"y{i}" for i in range(200)]
    docs = documents(spark, [" ".join(base), " ".join(near), " ".join(more), words(rng, 100)])
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 3]
    assert sorted(r["doc_id"] for r in jaccard_join.keep_one(docs).collect()) == [0, 1, 2, 3]


def test_short_lines_and_lines_without_spaces_take_part(spark):
    han = "".join(chr(0x4E00 + i * 7) for i in range(400))
    kinds = ["Read more", "read MORE!", han, "--", "", "no", han[:200] + "一" + han[201:]]
    lines = [r["norm"] for r in line_dedup.occurrences(documents(spark, ["\n".join(kinds)]), "doc_id", "text").orderBy("pos").collect()]
    assert lines == ["read more", "read more", han, "no", kinds[6]]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_duplicate_lines(documents(spark, ["a\n" + "\n".join(kinds[:6]), "b\n" + "\n".join(kinds[:6]), "Read more"])).collect()}
    assert got == {0: f"a\nRead more\n{han}\n--\n\nno", 1: "b\n--\n", 2: ""}
    grams = spark.createDataFrame([(x,) for x in ("no", "read more", "𝒜𝒷日本", "a b c d")], "norm string").select(line_dedup.features(F.col("norm")).alias("f")).collect()
    assert [r["f"] for r in grams] == [["no"], ["rea", "ead", "ad ", "d m", " mo", "mor", "ore"], ["𝒜𝒷日", "𝒷日本"], ["a", "b", "c", "d"]]


def test_line_dedup_splits_a_text_once_and_counts_bits_without_a_case_a_bit(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    rows = spark.createDataFrame([(["a", "b"],)], "words array<string>")
    assert plan(line_dedup.with_simhash(rows)).count("CASE WHEN") < 64
    lines = [f"line number {i % 40} of the long text" + " x" * (i % 40) for i in range(400)]
    found = line_dedup.drop_duplicate_lines(documents(spark, ["\n".join(lines), "", "a\n" + lines[3]]))
    got = {r["doc_id"]: (r["text"].split("\n"), r["n_lines"], r["n_dropped"]) for r in found.collect()}
    assert all(len(kept) == n - dropped or (kept == [""] and n - dropped <= 1) for kept, n, dropped in got.values())
    assert got[0][0] == [x for i, x in enumerate(lines[:40]) if x in got[0][0]] and got[2][0] == ["a"]
    assert "get(split(" not in plan(found)


def test_simhash_by_adders_at_their_limits(spark, monkeypatch):
    rng = random.Random(11)
    sizes = (1, 2, 3, 4, 31, 120, 121, 254, 255, 256, 300)
    rows = spark.createDataFrame([(i, [f"w{rng.random()}" for _ in range(n)]) for i, n in enumerate(sizes)], "i int, words array<string>")
    hashes = {r["i"]: np.array(r["h"], dtype=np.int64).view(np.uint64) for r in rows.select("i", F.transform("words", lambda w: F.xxhash64(w)).alias("h")).collect()}
    want = {i: sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h)) for i, h in hashes.items()}
    for flat in (255, 7, 1):  # the longer lines go by lanes
        monkeypatch.setattr(line_dedup, "FLAT", flat)
        assert {r["i"]: r["sim"] & (2**64 - 1) for r in line_dedup.with_simhash(rows).collect()} == want


def test_lines_are_normalised_once_and_links_decided_once(spark, monkeypatch):
    docs = documents(spark, ["One two three four five six\n--\n\nÀ 1", "one two three four five seven"])
    lines = line_dedup.occurrences(docs, "doc_id", "text")
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert [r["norm"] for r in lines.orderBy("doc_id", "pos").collect()] == ["one two three four five six", "à 1", "one two three four five seven"]
    plans, write = [], line_dedup.checkpoint_parquet
    monkeypatch.setattr(line_dedup, "checkpoint_parquet", lambda df, name: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())) or write(df, name))
    line_dedup.drop_duplicate_lines(docs).collect()
    assert all(plan.count("levenshtein") == 1 for name, plan in plans if name == "line-links")


def test_small_meetings_are_compared_whole_and_large_ones_lose_no_link(spark, monkeypatch):
    rng = random.Random(12)
    base = [words(rng, 40).split() for _ in range(6)]
    texts = ["\n".join(" ".join(b[:k] + [f"x{k}"] + b[k + 1:]) for b in base) for k in range(0, 36, 3)] + [" ".join(base[0][5:9] + base[0]), " ".join(base[1][:37])]
    docs = documents(spark, texts)
    results = []
    for few in (4, 2, 1):
        monkeypatch.setattr(line_dedup, "FEW", few)
        results.append(sorted((r["doc_id"], r["text"], r["n_dropped"]) for r in line_dedup.drop_duplicate_lines(docs).collect()))
    assert results[0] == results[1] == results[2] and sum(r[2] for r in results[0]) > 0


def test_pipeline_sends_small_batches_of_texts_to_python(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    try:
        for own, most in ((10_000, session.TEXT_ROWS), (0, session.TEXT_ROWS), (300, 300)):  # 0: no limit
            spark.conf.set(key, own)
            corpus_pipeline.near_duplicates(spark, documents(spark, ["a b c d e f"]), "")
            rows = [r["n"] for r in spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n bigint").collect()]
            assert max(rows) == most and sum(rows) == 5000
    finally:
        spark.conf.set(key, before)


def test_verified_lines_are_found_by_broadcast_ids_and_bits_by_few_columns(spark, monkeypatch):
    rows = spark.createDataFrame([(["a", "b"],)], "words array<string>")
    assert line_dedup.with_simhash(rows)._jdf.queryExecution().analyzed().toString().count("Project") < 20
    rng = random.Random(13)
    base = words(rng, 40).split()
    docs = documents(spark, [" ".join(base[:k] + [f"x{k}"] + base[k + 1:]) for k in range(0, 36, 3)])
    seen, count = [], line_dedup.small
    monkeypatch.setattr(line_dedup, "small", lambda df: seen.append(df.columns) or count(df))
    found = sum(r["n_dropped"] for r in line_dedup.drop_duplicate_lines(docs).collect())
    assert found > 0 and ["node"] in seen[:1]


def test_pair_of_documents_is_met_once_a_stretch_and_not_once_a_shingle(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_families", lambda batches: iter(()))
    met, own = [], jaccard_join.pair_rows
    monkeypatch.setattr(jaccard_join, "pair_rows", lambda *a: met.append(own(*a)) or met[-1])
    rng = random.Random(8)
    texts = [mutated(rng, base, rng.randint(0, 8)) for base in (words(rng, 400), words(rng, 900)) for _ in range(12)]
    texts += [words(rng, 60 + 10 * i) + " " + texts[0] for i in range(8)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(spark, texts)).collect()}
    assert got == brute_force(dict(enumerate(texts)))
    rows = met[0].mapInArrow(jaccard_join._candidates(85), "a bigint, b bigint, larger bigint, both bigint")
    n, distinct = rows.count(), rows.distinct().count()
    assert distinct and n <= 8 * distinct  # a row for each of some 40 common shingles of the prefixes before


def test_lines_are_split_and_normalised_once(spark):
    texts = ["One  TWO\n--\nthree, four five six\n", None, "", "\n \n", "ÜN-ï 日本"]
    lines = line_dedup.occurrences(documents(spark, [t or "" for t in texts]).withColumn("text", F.expr("if(doc_id = 1, null, text)")), "doc_id", "text")
    assert sorted((r["doc_id"], r["pos"], r["norm"], r["len"]) for r in lines.collect()) == [
        (0, 0, "one two", 7), (0, 2, "three four five six", 19), (4, 0, "ün ï 日本", 7)]
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and plan.count(", \n, -1)") == 1 and "RLIKE" not in plan
