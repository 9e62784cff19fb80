"""Conversation repair: the grammar, the matrices, whole results against a plain search."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentinela.llm import conversations as cv
from tests.llm.helpers import empty

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def search(rows):
    """Cheapest repair of (role, text, fault) rows: a shortest path over (rows used, state) that keeps
    the ASCII-least audit, without matrices or suffixes."""
    heap, done = [(0, "", 0, "", "")], set()
    while heap:
        cost, audit, i, state, text = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, text[1:]
        for r, name in (("u", "user"), ("a", "assistant")):
            if (state, r) in STEP:
                heapq.heappush(heap, (cost + 3, audit + "I", i, STEP[state, r], text + f"\n{name}:"))
        if i < len(rows):
            role, said, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, text))
            if fault in "kt":
                more = 3 * (fault == "t")
                if (state, role[:1]) in STEP:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, STEP[state, role[:1]], text + f"\n{role}:{said}"))
                for r, name in (("u", "user"), ("a", "assistant")):
                    if (state, r) in STEP:
                        heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, STEP[state, r], text + f"\n{name}:{said}"))


def brute(rows, damaged=True):
    """{conv_id: result} of (conv_id, turn, role, text) rows by the wording of the contract."""
    shown = lambda v: " " if v is None else str(v)
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = shown(role), shown(text)
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20 if damaged else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in own if t is not None}
        seen, found = set(), []
        for _, role, text in own:
            visible = re.findall("[^\\x20\\x09-\\x0D]", text)
            found.append((role, text, "b" if not visible else "d" if (role, text) in seen else "k" if visible[-1] in ".!?" else "t"))
            seen.add((role, text))
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        faults = [f for _, _, f in found]
        cost, audit, text = search(found)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in "bdt"], illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def results(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def some_rows(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"])
            rows.append((c, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 3]), role,
                         rng.choice([None, "", " \t", "Yes.", "Yes.", "no", "what?\n", "é!", "long. words", "日本.", " "])))
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rows = some_rows(seed)
    assert results(cv.damage_and_repair(table(spark, rows).repartition(3))) == brute(rows)


def test_conversation_over_many_partitions(spark):
    """A conversation with most of the rows lies in several partitions; its matrices are multiplied in order."""
    rng = random.Random(7)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice(["a.", f"text {t}.", f"cut {t}"])) for t in range(900)] + some_rows(3, 10)[:40]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    df = table(spark, rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert results(cv.repair(df)) == brute(rows, damaged=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def spell(rules, symbols, seq):
    return [x for s in seq for x in ([s] if s < symbols else spell(rules, symbols, rules[s - symbols]))]


def test_grammar_spells_its_sequences():
    rng = random.Random(8)
    sequences = [np.array([rng.choice([0, 0, 1, 2]) for _ in range(rng.randint(0, 40))], np.int64) for _ in range(50)] + [np.zeros(33, np.int64)]
    rules, left = cv.repair_grammar(sequences, 3)
    assert len(rules) > 10 and sum(map(len, left)) < sum(map(len, sequences)) / 2
    assert all(spell(rules, 3, rest.tolist()) == s.tolist() for rest, s in zip(left, sequences))
    assert all(a < 3 + i and b < 3 + i for i, (a, b) in enumerate(rules))  # from the bottom up
    assert cv.repair_grammar([], 3) == ([], []) and cv.repair_grammar([np.zeros(0, np.int64)], 3)[0] == []


def test_matrices_do_not_depend_on_the_grammar():
    rng = random.Random(9)
    texts = ["".join(rng.choice("suax") + rng.choice("kkktbd") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    shared, alone = cv.transfer_matrices(texts, 2), [cv.transfer_matrices([t], 10**9)[0] for t in texts]
    plain = lambda m: [[None if e is None else (e[0], str(e[1])) for e in row] for row in m]
    assert [plain(m) for m in shared] == [plain(m) for m in alone]
    for text, matrix in zip(texts, shared):
        rows = [({"s": "system", "u": "user", "a": "assistant", "x": "x"}[text[i]], "t", text[i + 1]) for i in range(0, len(text), 2)]
        cost, pieces = cv.cheapest([matrix])
        assert (cost, "".join(pieces)) == search(rows)[:2]


@pytest.mark.parametrize("cuts", [1, 3])
def test_stretches_multiply(cuts):
    rng = random.Random(cuts)
    for _ in range(200):
        text = "".join(rng.choice("suax") + rng.choice("kktd") for _ in range(rng.randint(1, 12)))
        at = sorted({0, len(text), *[2 * rng.randint(0, len(text) // 2) for _ in range(cuts)]})
        whole = cv.cheapest(cv.transfer_matrices([text]))
        parts = cv.cheapest(cv.transfer_matrices([text[i:j] for i, j in zip(at, at[1:])]))
        assert parts[0] == whole[0] and "".join(parts[1]) == "".join(whole[1])


def test_awkward(spark):
    rows = [(None, 0, "user", "Hi."), (None, None, "assistant", None), (1, None, None, None), (1, None, "user", "x."), (2, 0, "system", "Only."),
            (3, 5, "user", "same."), (3, 5, "user", "same."), (3, 5, "user", "same."), (4, 0, "assistant", "w. " * 40_000 + "end"), (6, 0, "user", ".\n\n")]
    df = table(spark, rows).withColumns({"at": F.lit("x"), "seg": F.lit(1), "audit": F.lit(None).cast("string")})
    assert results(cv.damage_and_repair(df)) == brute(rows)
    assert results(cv.repair(df)) == brute(rows, damaged=False)
    assert cv.damage_and_repair(empty(df)).collect() == []
    # every row dropped: the conversation stays, with nothing in it
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert results(cv.damage_and_repair(table(spark, [(conv, 0, "user", "x")]))) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_other_id_types(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("conv_id", "turn_name", "role", "text")])
    df = spark.createDataFrame([("a", "0", "user", "Hi."), ("a", "1", "assistant", "Yes.")], schema).withColumn("turn", F.col("turn_name").cast("int"))
    assert results(cv.repair(df))["a"][:6] == (0, 0, 0, 0, 0, 0) and results(cv.repair(df))["a"][6] == "KK"
