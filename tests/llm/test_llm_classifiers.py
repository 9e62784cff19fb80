"""Quality and toxicity models, the pipeline and the registered queries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sentinela.llm import quality, toxicity
from tests.llm.helpers import awkward, documents, empty, words

SF = "/root/testdata/sf0.01"


def labelled(spark, n=400):
    rng = random.Random(6)
    texts, rows = [], []
    for i in range(n):
        t = words(rng, rng.randint(20, 120)).split()
        junk, toxic = i % 4 == 0, i % 3 == 0
        if toxic:
            for _ in range(4):
                t.insert(rng.randrange(len(t)), rng.choice(["zzrude", "zzfoul", "zzbad"]) + rng.choice("abc"))
        if junk:
            t = [w.upper() + "!!" for w in t]
        texts.append(" ".join(t))
        rows.append((i, int(not junk), int(toxic)))
    rows += [(None, 1, 1), (1, None, None), (99999, 1, 0)]
    return documents(spark, texts), spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.97), (toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = labelled(spark)
    rows = module.score_documents(docs, labels).collect()
    truth = {r["doc_id"]: r[label] for r in labels.collect() if r[label] is not None}
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= module.THRESHOLD) for r in rows)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) >= least


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_awkward(spark, module):
    docs, labels = labelled(spark, 60)
    rows = module.score_documents(awkward(spark), labels).collect()
    assert len(rows) == awkward(spark).count() and all(0 <= r["score"] <= 1 for r in rows)
    assert module.score_documents(empty(docs), labels).collect() == []
    assert len({r["score"] for r in module.score_documents(docs, empty(labels)).collect()}) >= 1
    assert len({r["score"] for r in rows if r["doc_id"] == 3}) == 1


def test_factorisation_identity():
    """The linear-time score equals the sum over all pairs."""
    rng = np.random.default_rng(0)
    model = {"w0": 0.3, "w": rng.normal(size=quality.n_features()), "v": rng.normal(size=(quality.n_features(), quality.RANK))}
    ids, values, of = quality.features(pa.array(["Some WORDS here | 12 !!", "a a a a b"]))
    z = quality.logits(model, ids, values, of)[0]
    for k in range(2):
        j, x = ids[of[k]:of[k + 1]], values[of[k]:of[k + 1]]
        pairs = sum(model["v"][j[a]] @ model["v"][j[b]] * x[a] * x[b] for a in range(len(j)) for b in range(a))
        assert abs(z[k] - (model["w0"] + model["w"][j] @ x + pairs)) < 1e-4


def test_network_gradients():
    model = {k: v.astype(np.float64) for k, v in toxicity.new_model().items()}
    which, of, buckets, grams, gram_of = toxicity.distinct_words(pa.array(["you are so bad today", "fine words here", "x"]))
    _, first, n_words = toxicity.windows(of)
    at, y = toxicity._positions(first, n_words, which, len(buckets)), np.array([1.0, 0, 0])

    def loss(m):
        z = toxicity.window_logits({k: v.astype(np.float32) for k, v in m.items()}, which, of, buckets, grams, gram_of)[3].astype(float)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    g, tables = toxicity.gradients({k: v.astype(np.float32) for k, v in model.items()}, at, n_words, y, buckets, grams, gram_of)
    rng = np.random.default_rng(1)
    for k in ("in", "in0", "back", "att", "pick", "out"):
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        for sign in (1,):
            up, down = dict(model), dict(model)
            up[k], down[k] = model[k].copy(), model[k].copy()
            up[k][i] += 0.01 * sign
            down[k][i] -= 0.01 * sign
            assert abs((loss(up) - loss(down)) / 0.02 - g[k][i]) < 0.02 * abs(g[k][i]) + 1e-4
    assert rng is not None and len(tables["word"][0]) == len(buckets)


def test_windows_cover_every_word():
    of = np.concatenate([[0], np.cumsum([0, 1, 31, 32, 33, 48, 49, 500])])
    text, first, n = toxicity.windows(of)
    for k in range(len(of) - 1):
        seen = set()
        for f, m in zip(first[text == k], n[text == k]):
            seen |= set(range(f, f + m))
        assert seen == set(range(of[k], of[k + 1]))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        after = stage(spark, docs, SF)
        if k == len(corpus_pipeline.STAGES) - 1:
            assert {r["doc_id"] for r in after.collect()} == before
            break
        after = after.persist()
        ids = {r["doc_id"] for r in after.collect()}
        assert after.columns == columns and ids <= before
        if k == 0:
            assert not {i for i, q in labels.items() if q == 1} - ids and len({i for i, q in labels.items() if q == 0} - ids) >= 25
        if k == 3:
            assert ids == before
        docs = after


def test_pipeline_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, empty(docs), SF).collect()
        docs = stage(spark, docs, SF).persist()
        docs.collect()
        if k == 0:
            docs = awkward(spark)


def test_queries_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n[:2] == "op" and n[2].isdigit()} == {f"op{n}" for n in range(1, 11)} and "pipeline" in names


def test_packing_follows_the_mixture_over_many_files(spark, tmp_dir):
    """Many files of unlike sizes, read in another order than they were written."""
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.concat(F.lit("w"), F.col("id")), (F.col("id") * 97 % 60 + F.col("id") / 100).cast("int"))).alias("text"),
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    rows.repartitionByRange(12, "doc_id").sortWithinPartitions("doc_id").write.parquet(f"{tmp_dir}/mixed")
    files = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        docs = spark.read.parquet(f"{tmp_dir}/mixed")
        first = [r["doc_id"] for r in docs.collect()]
        found = corpus_pipeline.sequence_packing(spark, docs, "").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", files)
    assert first != sorted(first)  # Spark reads in another order
    begins = {}
    for r in found:
        begins.setdefault(r["doc_id"], []).append(r["sequence_id"])
    assert sorted(begins) == list(range(6000))
    place = [i for _, i in sorted((min(s), i) for i, s in begins.items())]
    assert max(abs(k - i) for k, i in enumerate(place)) <= 256
    source = {i: i % 4 == 0 for i in begins}
    for n in range(1000, 6001, 500):
        assert abs(sum(source[i] for i in place[:n]) - n / 4) <= 64
    assert corpus_pipeline.in_written_order(docs.where("doc_id > 5")).collect() == docs.where("doc_id > 5").collect()
