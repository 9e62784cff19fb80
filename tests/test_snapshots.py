"""Versioned tables, rules observed by the write, mergeable distinct counts, the baseline classifier."""

import random

import pytest
from pyspark.sql import functions as F

from sentinela.operators.stats import distinct_sketches, merged_distinct
from sentinela.operators.supervised import auc, baseline_scores, held_out
from sentinela.sinks.snapshots import RuleViolation, read_version, replace_version, versions


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_versions_replace_and_read(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    first = spark.createDataFrame([(2020, "a", 1), (2020, "b", 2), (2021, "a", 3), (None, "z", 9)], "anio int, k string, n int")
    assert versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, first.schema)
    assert replace_version(first, path, ["anio"]) == (0, {"n_filas": 4})
    assert rows_of(read_version(spark, path, first.schema)) == rows_of(first)
    redo = spark.createDataFrame([(2020, "c", 7), (2022, "d", 8)], "anio int, k string, n int")
    assert replace_version(redo, path, ["anio"])[0] == 1
    now = [(2020, "c", 7), (2021, "a", 3), (2022, "d", 8), (None, "z", 9)]
    assert rows_of(read_version(spark, path, first.schema)) == sorted(now, key=str)
    assert rows_of(read_version(spark, path, first.schema, version=0)) == rows_of(first)  # the old one is undisturbed
    assert replace_version(first.where("false"), path, ["anio"])[0] == 2
    assert rows_of(read_version(spark, path, first.schema)) == sorted(now, key=str)


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    first = spark.createDataFrame([(2020, 1), (2021, 2)], "anio int, n int")
    replace_version(first, path, ["anio"])
    broken = spark.range(100).select(F.lit(2020).alias("anio"), F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("mid-write"))).cast("int").alias("n")).repartition(5)
    with pytest.raises(Exception, match="mid-write"):
        replace_version(broken, path, ["anio"])
    assert versions(spark, path) == [0] and rows_of(read_version(spark, path, first.schema)) == rows_of(first)
    assert replace_version(first.where("anio = 2020").withColumn("n", F.lit(5)), path, ["anio"])[0] == 1


def test_rules_are_counted_by_the_write(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    df = spark.createDataFrame([(2020, 1), (2020, -2), (2021, None)], "anio int, n int")
    rules = {"negativo": F.col("n") < 0, "nulo": F.col("n").isNull()}
    assert replace_version(df, path, ["anio"], rules) == (0, {"n_filas": 3, "negativo": 1, "nulo": 1})
    with pytest.raises(RuleViolation) as e:
        replace_version(df.withColumn("n", F.lit(-1)), path, ["anio"], rules, strict=True)
    assert e.value.counts == {"negativo": 3}
    assert versions(spark, path) == [0] and rows_of(read_version(spark, path, df.schema)) == rows_of(df)
    assert replace_version(df.where("n > 0"), path, ["anio"], rules, strict=True)[0] == 1


def test_stored_sketches_merge(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(d, rng.randint(0, 30_000)) for d in range(40) for _ in range(2000)] + [(0, None)]
    daily = distinct_sketches(spark.createDataFrame(rows, "dia int, item int"), ["dia"], "item")
    daily.write.parquet(f"{tmp_dir}/sketches")  # from here on the facts are not needed
    stored = spark.read.parquet(f"{tmp_dir}/sketches")
    error = 4 * 0.83 / 2**6
    for days, got in ((range(40), merged_distinct(stored).first()), (range(10), merged_distinct(stored.where("dia < 10")).first())):
        exact = len({i for d, i in rows if d in days and i is not None})
        assert abs(got.n_estimado - exact) <= error * exact
    assert merged_distinct(stored).first().n_filas == len(rows)
    per_half = {r.half: r.n_estimado for r in merged_distinct(stored.withColumn("half", F.floor(F.col("dia") / 20)), ["half"]).collect()}
    assert sum(per_half.values()) > 1.2 * merged_distinct(stored).first().n_estimado  # counts don't add up, sketches do


def test_baseline_classifier_learns_and_holds_out(spark):
    rng = random.Random(2)
    rows = [(i, int(y), rng.gauss(2.0 * y, 1), rng.gauss(0, 1)) for i in range(600) for y in [rng.random() < 0.2]] + [(9001, None, 2.0, 0.0), (9002, 1, None, None)]
    df = spark.createDataFrame(rows, "id bigint, y int, x1 double, x2 double")
    scored = baseline_scores(df, ["x1", "x2"], "y", "id")
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert auc(scored.where("held_out AND y IS NOT NULL"), "y", "score").first().auc > 0.85
    flipped = baseline_scores(df.withColumn("y", F.when(held_out("id"), 1 - F.col("y")).otherwise(F.col("y"))), ["x1", "x2"], "y", "id").collect()
    assert {r.id: r.score for r in got} == pytest.approx({r.id: r.score for r in flipped})  # held-out labels are not used


def test_euclidean_silhouette_and_its_error(spark):
    import numpy as np
    from sentinela.operators.cluster import silhouette_euclidean
    rng = np.random.default_rng(6)
    label = rng.choice(3, size=2000, p=[0.7, 0.25, 0.05])
    points = rng.normal(size=(2000, 4)) + 2.5 * np.eye(4)[label]
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    n = np.bincount(label)
    mean = np.stack([gaps[:, label == k].sum(1) / (n[k] - (label == k)) for k in range(3)], axis=1)
    a = mean[np.arange(2000), label]
    mean[np.arange(2000), label] = np.inf
    b = mean.min(1)
    brute = ((b - a) / np.maximum(a, b)).mean()
    df = spark.createDataFrame([([float(x) for x in p], int(k)) for p, k in zip(points, label)] + [([0.0] * 4, None), (None, 1)], "features array<double>, cluster int").repartition(4)
    exact, none = silhouette_euclidean(df, per_cluster=2000)
    assert exact == pytest.approx(brute, abs=1e-9) and none == 0
    for seed in range(3):
        value, error = silhouette_euclidean(df, per_cluster=150, seed=seed)
        assert 0 < error < 0.05 and abs(value - brute) <= 3 * error
    assert all(np.isnan(silhouette_euclidean(df.where("cluster = 1"))))
