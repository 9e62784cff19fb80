"""K-Means, isolation forest, two-level scans and rank tables against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentinela.operators import forest, kmeans
from sentinela.operators.ranges import in_ranges, previous, running_total
from sentinela.operators.scaling import median_impute, quantiles
from sentinela.operators.stats import percentiles


def points_table(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, features array<double>")


# ------------------------------------------------------------------ scans

def test_running_total_and_previous_over_range_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(g, int(i), int(v)) for g, n in (("a", 900), ("b", 3), (None, 50)) for i, v in zip(rng.permutation(n), rng.integers(0, 9, n))]
    df = spark.createDataFrame(rows, "g string, i int, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would join so few rows to one range
    try:
        placed = in_ranges(df.repartition(3), ["g"], ["i"])
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert placed.select("_segment").distinct().count() > 2  # the group with most rows is cut
    got = previous(running_total(placed, ["g"], ["i"], "v", "before", "total"), ["g"], ["i"], "v", "last").collect()
    assert len(got) == len(rows)
    for g in ("a", "b", None):
        own = sorted((i, v) for h, i, v in rows if h == g)
        found = {r.i: (r.before, r.total, r["last"]) for r in got if r.g == g}
        before, last = 0, None
        for i, v in own:
            assert found[i] == (before, sum(x for _, x in own), last)
            before, last = before + v, v
    everything = running_total(in_ranges(df.where("g = 'a'"), [], ["i"]), [], ["i"], before="place").collect()
    assert [r.place for r in sorted(everything, key=lambda r: r.i)] == list(range(900))


def test_ranks_of_many_columns(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if i % 3 else None, float(rng.integers(0, 20)), None if i % 5 == 0 else float(rng.normal()), None) for i in range(200)] + [("c", None, None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double")
    values = lambda g, k: [r[k] for r in rows if (g is ... or r[0] == g) and r[k] is not None]
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.column, r.q): r.value for r in quantiles(df, ["x", "y", "z"], qs, ["g"]).collect()}
    assert got == {(g, c, q): pytest.approx(np.quantile(values(g, k), q)) for g in ("a", None) for k, c in ((1, "x"), (2, "y")) for q in qs}
    all_of = {(r.column, r.q): r.value for r in quantiles(df, ["x", "y"], qs).collect()}
    assert all_of == {(c, q): pytest.approx(np.quantile(values(..., k), q)) for k, c in ((1, "x"), (2, "y")) for q in qs}
    filled = median_impute(df, ["x", "y", "z"]).collect()
    assert len(filled) == len(rows) and all(r.z is None and r.y is not None for r in filled)
    assert next(r.y for r in filled if r.g == "c") == pytest.approx(np.median(values(..., 2)))
    p = {r.g: (r.p25, r.p90) for r in percentiles(df, ["g"], "y", [0.25, 0.9]).collect()}
    assert p == {"c": (None, None), **{g: tuple(pytest.approx(np.quantile(values(g, 2), q)) for q in (0.25, 0.9)) for g in ("a", None)}}
    assert quantiles(df.where("false"), ["x"], [0.5]).collect() == []


# ----------------------------------------------------------------- K-Means

def lloyd(points, k, steps):
    centers = [points[0]]
    for _ in range(1, k):
        d = np.min([((points - c) ** 2).sum(1) for c in centers], axis=0)
        centers.append(points[d.argmax()])
    centers = np.array(centers, dtype=float)
    for _ in range(steps):
        own = np.array([((points - c) ** 2).sum(1) for c in centers]).argmin(0)
        centers = np.array([points[own == j].mean(0) if (own == j).any() else centers[j] for j in range(k)])
    return centers, np.array([((points - c) ** 2).sum(1) for c in centers]).argmin(0)


@pytest.mark.parametrize("steps", [1, 8])
def test_bounded_lloyd_equals_plain_lloyd(spark, steps):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(size=(150, 3)) + 7 * c for c in rng.normal(size=(4, 3))])
    centers, rows, reads = kmeans.lloyd_bounded(points_table(spark, points).repartition(3), 4, steps=steps)
    want, own = lloyd(points, 4, steps)
    assert np.allclose(centers, want)
    assert [r.cluster for r in sorted(rows.collect(), key=lambda r: r.id)] == own.tolist()
    assert reads[0] == 600 and (steps == 1 or min(reads[1:]) < 600)  # rows with wide margins are not read


def test_bounds_refresh_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(200, 2))
    for refresh in (0.0, 1.0):
        centers, rows, _ = kmeans.lloyd_bounded(points_table(spark, points), 5, steps=6, refresh=refresh)
        assert np.allclose(centers, lloyd(points, 5, 6)[0])
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)] + [(None, [0.0, 0.0]), (20, None)], "id bigint, features array<double>")
    centers, rows, _ = kmeans.lloyd_bounded(same, 3)
    assert {(r.cluster, r.distance) for r in rows.collect()} == {(0, 0.0)} and rows.count() == 9
    assert kmeans.lloyd_bounded(same.where("false"), 3)[1].collect() == []


def test_many_restarts_of_many_k(spark):
    rng = np.random.default_rng(4)
    blobs = np.array([[0, 0], [9, 0], [0, 9], [9, 9]])
    points = np.concatenate([rng.normal(0, 0.5, size=(60, 2)) + b for b in blobs])
    df = points_table(spark, points).repartition(4)
    fits = kmeans.kmeans_many(df, [2, 4, 5], n_init=4)
    assert [f.k for f in fits] == [2, 4, 5] and fits[0].cost > fits[1].cost > fits[2].cost
    assert np.allclose(sorted(map(tuple, np.round(fits[1].centers / 9))), sorted(map(tuple, blobs / 9)), atol=0.01)
    cost = sum(((points - fits[1].centers[:, None]) ** 2).sum(2).min(0))
    assert fits[1].cost == pytest.approx(cost)
    labels = kmeans.assigned(df, fits[1].centers).collect()
    assert all(r.cluster == ((points[r.id] - fits[1].centers) ** 2).sum(1).argmin() for r in labels)


# -------------------------------------------------------- isolation forest

def forest_table(spark, n, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(g, i, float(rng.normal()), float(rng.normal()), 1.0) for g in ("a", None) for i in range(n)] + [("a", 9999, 15.0, -15.0, 1.0), ("one", 1, 0.0, 0.0, 1.0)]
    return spark.createDataFrame(rows, "g string, rid bigint, x double, y double, z double"), rows


def test_boxes_hold_each_row_once_and_carry_path_lengths(spark):
    df, rows = forest_table(spark, 150)
    boxes = forest.forest_boxes(df, ["g"], ["x", "y", "z"], "rid", n_trees=10, max_samples=32).collect()
    of = lambda g: [b for b in boxes if b.g == g]
    inside = lambda b, x: all((b[f"lo_{i}"] is None or x[i] >= b[f"lo_{i}"]) and (b[f"hi_{i}"] is None or x[i] < b[f"hi_{i}"]) for i in range(3))
    for g, rid, *x in rows[::7] + rows[-2:]:
        assert sorted(b.tree for b in of(g) if inside(b, x)) == list(range(10))
    for g in ("a", None):
        for t in range(10):
            tree = [b for b in of(g) if b.tree == t]
            assert sum(b["size"] for b in tree) == 32 and max(b.depth for b in tree) <= 5
            assert all(b.lo_2 is None and b.hi_2 is None for b in tree)  # a constant feature is never split
    c = lambda n: 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
    assert all(b.path == pytest.approx(b.depth + c(b["size"])) for b in boxes)
    assert {(b.tree, b.depth, b["size"]) for b in of("one")} == {(t, 0, 1) for t in range(10)}


def test_scores_do_not_depend_on_partitions_and_find_the_outlier(spark):
    df, rows = forest_table(spark, 400)
    run = lambda d: {(r.g, r.rid): (r.if_score, r.anomalia_if) for r in forest.isolation_forest(d, ["g"], ["x", "y", "z"], "rid", 40, 64).collect()}
    got = run(df)
    assert got == run(df.repartition(7, "rid")) and len(got) == len(rows)
    assert min((v for k, v in got.items() if k[0] == "a")) == got["a", 9999] and got["one", 1] == (0.0, False)
    for g in ("a", None):
        assert 0.05 <= np.mean([f for k, (_, f) in got.items() if k[0] == g]) <= 0.15
    scaled = run(df.withColumns({"x": F.col("x") * 1024, "y": F.col("y") / 512}))  # splits are uniform over a feature's range
    assert scaled == got
    nulls = forest.isolation_forest(df.withColumn("x", F.when(F.col("rid") > 5, F.col("x"))), ["g"], ["x"], "rid", 5, 16)
    assert nulls.where("if_score IS NULL").count() == 0
    assert forest.isolation_forest(df.where("false"), ["g"], ["x"], "rid", 5, 16).collect() == []
