"""Operator properties and quirks on small fixtures (§5.3 items 2-4)."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentinela.operators import bulletin as B
from sentinela.operators.anomaly import cohen_kappa, combine_labels, dbscan_1d
from sentinela.operators.cluster import adjusted_rand, ward_clusters
from sentinela.operators.forest import isolation_forest
from sentinela.operators.joins import dedupe_first, grid_from_values
from sentinela.operators.lagcorr import best_lag, pearson_pvalue
from sentinela.operators.risk import seasonal_weights
from sentinela.operators.scaling import minmax_scale, standardize
from sentinela.operators.stats import guarded_corr
from sentinela.operators.supervised import auc, cumulative_sum
from sentinela.operators.windows import new_from_cumulative


# ---------------------------------------------------------------- windows

def test_new_from_cumulative_first_row_and_clip(spark):
    rows = [("A", 1, 10, 7), ("A", 2, 15, 0), ("A", 4, 12, 0), ("A", 5, 20, 0), ("B", 3, 5, 5)]
    df = spark.createDataFrame(rows, "g string, w int, cum int, weekly int")
    half = {(r.g, r.w): r.casos_nuevos for r in
            new_from_cumulative(df, ["g"], "w", "cum", "weekly", "half").collect()}
    # first row: round_half_even(7/2)=4 and (5/2)=2; drop 15->12 clipped to 0; gap week 3 is positional
    assert half == {("A", 1): 4, ("A", 2): 5, ("A", 4): 0, ("A", 5): 8, ("B", 3): 2}
    full = {(r.g, r.w): r.casos_nuevos for r in
            new_from_cumulative(df, ["g"], "w", "cum", "weekly", "full").collect()}
    assert full[("A", 1)] == 7 and full[("B", 3)] == 5


def test_recode_sex_guard(spark):
    rows = [(2019, 1, "M", 1), (2019, 1, "F", 2), (2019, 2, "H", 3), (2019, 2, "M", 4), (2021, 1, "M", 5)]
    df = spark.createDataFrame(rows, "anio int, semana int, sexo string, v int")
    guarded = {r.v: r.sexo for r in B.recode_sex(df, 2020, guard=True).collect()}
    assert guarded == {1: "H", 2: "M", 3: "H", 4: "M", 5: "M"}
    compat = {r.v: r.sexo for r in B.recode_sex(df, 2020, guard=False).collect()}
    assert compat[4] == "H"  # the unguarded recode turns an H/M file's M into H


def test_densify_grid_size_and_zeros(spark):
    rows = [(2019, 1, "E1", "D1", "H", 3, 3, 1), (2019, 1, "E1", "D1", "H", 9, 9, 9),  # duplicate key
            (2020, 5, "E2", "D2", "M", 2, 4, 1), (1999, 2, "E1", "D1", "H", 1, 1, 1)]
    df = spark.createDataFrame(rows, "anio int, semana int, entidad_federativa string, enfermedad string, "
                                     "sexo string, casos_semana int, casos_acumulado int, casos_acum_anterior int")
    out = B.densify(df, ["E1", "E2", "E3"], ["D1", "D2"], ["H", "M"], min_year=2000)
    # years > 2000 observed: 2019, 2020; weeks observed: 1, 2, 5
    assert out.count() == 2 * 3 * 3 * 2 * 2
    kept = out.where("anio = 2019 AND semana = 1 AND entidad_federativa = 'E1' AND enfermedad = 'D1' "
                     "AND sexo = 'H'").first()
    assert kept.casos_semana == 3  # first row under the explicit order wins
    assert out.where("casos_acumulado = 0").count() == out.count() - 2


def test_grid_from_values_matches_product(spark):
    dims = [("a", [1, 2, 3], "int"), ("b", ["x", "y"], "string"), ("c", [10, 20], "int")]
    got = sorted(tuple(r) for r in grid_from_values(spark, dims, rows_per_partition=4).collect())
    assert got == sorted(itertools.product([1, 2, 3], ["x", "y"], [10, 20]))


def test_dedupe_first_is_partition_independent(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 20), rnd.randint(0, 3), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, v int, o int")
    a = sorted(tuple(r) for r in dedupe_first(df.repartition(3), ["k"], [F.col("o")]).collect())
    b = sorted(tuple(r) for r in dedupe_first(df.repartition(7, "v"), ["k"], [F.col("o")]).collect())
    assert a == b and len(a) == len({r[0] for r in rows})


# ------------------------------------------------------------- statistics

def test_guarded_corr(spark):
    df = spark.createDataFrame([("c", 1.0, 2.0), ("c", 2.0, 2.0), ("c", 3.0, 2.0),
                                ("s", 1.0, 1.0), ("s", 2.0, 3.0),
                                ("p", 1.0, 1.0), ("p", 2.0, 2.0), ("p", 3.0, 3.5)], "g string, x double, y double")
    got = {r.g: r.r for r in df.groupBy("g").agg(guarded_corr("x", "y").alias("r")).collect()}
    assert got["c"] is None and got["s"] is None and got["p"] == pytest.approx(np.corrcoef([1, 2, 3], [1, 2, 3.5])[0, 1])


def test_best_lag_ties_and_short_series(spark):
    import datetime as dt
    months = [dt.date(2020 + i // 12, i % 12 + 1, 1) for i in range(12)]
    x = [float(i % 5) for i in range(12)]
    rows = [("long", m, xv, xv) for m, xv in zip(months, x)] + [("short", m, 1.0, float(i)) for i, m in enumerate(months[:5])]
    df = spark.createDataFrame(rows, "e string, fecha date, x double, y double")
    got = {r.e: (r.mejor_lag, r.mejor_r) for r in best_lag(df, "e", "fecha", "x", "y", list(range(7))).collect()}
    assert got["long"][0] == 0 and got["long"][1] == pytest.approx(1.0)
    assert got["short"] == (1, None)


def test_pearson_pvalue_known_values(spark):
    rows = [(0, 0.5, 10), (1, 0.0, 10), (2, 0.9, 5), (3, -0.264, 68), (4, 1.0, 9), (5, 0.3, 2), (6, None, 9), (7, 0.5, 3), (8, 0.5, 4)]
    df = spark.createDataFrame(rows, "i int, r double, n bigint").withColumn("p", pearson_pvalue(F.col("r"), F.col("n")))
    p = {r.i: r.p for r in df.collect()}
    assert p[0] == pytest.approx(0.14112, abs=1e-4)
    assert p[4] == 0.0 and p[5] is None and p[6] is None
    assert p[7] == pytest.approx(2 / 3) and p[8] == pytest.approx(0.5)
    assert p[1] == pytest.approx(1.0)
    assert p[2] == pytest.approx(0.037386, abs=1e-4)
    assert p[3] == pytest.approx(0.0296, abs=2e-3)


def test_minmax_constant_and_ends(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 5.0), (3, 4.0)], "i int, x double")
    got = {r.i: r.n for r in minmax_scale(df, "x", "n").collect()}
    assert got == {1: 0.0, 2: 10.0, 3: 5.0}
    const = spark.createDataFrame([(1, 2.0), (2, 2.0)], "i int, x double")
    assert {r.n for r in minmax_scale(const, "x", "n").collect()} == {0.0}


def test_standardize_population_std(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0)], "g string, x double")
    got = sorted((r.g, r.x_z) for r in standardize(df, ["x"], ["g"]).collect())
    assert got == [("a", -1.0), ("a", 1.0), ("b", 0.0), ("b", 0.0)]


def test_seasonal_weights_sum_to_one(spark):
    import datetime as dt
    rows = [(dt.date(y, m, 1), float(m * (y - 2000))) for y in (2001, 2002) for m in range(1, 13)]
    w = seasonal_weights(spark.createDataFrame(rows, "fecha date, v double"), "fecha", "v").collect()
    assert len(w) == 12 and sum(r.peso for r in w) == pytest.approx(1.0)


# ---------------------------------------------------------------- anomaly

def _dbscan_reference(xs, eps, min_samples):
    n = len(xs)
    neigh = [[j for j in range(n) if abs(xs[i] - xs[j]) <= eps] for i in range(n)]
    core = [len(nb) >= min_samples for nb in neigh]
    labels, lab = [-1] * n, 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] == -1:
                labels[j] = lab
                if core[j]:
                    stack.extend(k for k in neigh[j] if labels[k] == -1)
        lab += 1
    return labels


@pytest.mark.parametrize("min_samples", [2, 3])
def test_dbscan_matches_bruteforce(spark, min_samples):
    rnd = random.Random(7 + min_samples)
    rows, expected = [], {}
    for g in range(25):
        n = rnd.randint(1, 30)
        xs = [rnd.choice([rnd.randint(0, 12), rnd.randint(0, 40), rnd.uniform(0, 9)]) for _ in range(n)]
        labs = _dbscan_reference(xs, 1.2, min_samples)
        for i, (x, lab) in enumerate(zip(xs, labs)):
            rows.append((g, i, float(x)))
            expected[(g, i)] = lab
    df = spark.createDataFrame(rows, "g int, pos int, x double")
    out = dbscan_1d(df, ["g"], "x", "pos", 1.2, min_samples)
    got = {(r.g, r.pos): r.db_label for r in out.collect()}
    assert got == expected


def test_labels_kappa_ari(spark):
    rows = [(i % 2, bool(i % 3 == 0), bool(i % 3 == 0)) for i in range(30)]
    df = spark.createDataFrame(rows, "g int, a boolean, b boolean")
    lab = combine_labels(df, "a", "b").collect()
    assert all(r.brote_estricto <= r.brote for r in lab)
    k = {r.g: r.kappa for r in cohen_kappa(df, ["g"], "a", "b").collect()}
    assert k == {0: pytest.approx(1.0), 1: pytest.approx(1.0)}
    ari = adjusted_rand(spark.createDataFrame([(i % 4, i % 4) for i in range(40)], "a int, b int"), "a", "b").first()
    assert ari.ari == pytest.approx(1.0)


def test_isolation_forest_ranks_planted_outlier(spark):
    rnd = np.random.default_rng(0)
    rows = []
    for g in ("a", "b"):
        for i in range(60):
            rows.append((g, i, float(rnd.normal()), float(rnd.normal())))
        rows.append((g, 999, 12.0, -12.0))
    df = spark.createDataFrame(rows, "g string, rid long, f1 double, f2 double")
    out = isolation_forest(df, ["g"], ["f1", "f2"], "rid", n_trees=50, contamination=0.1, seed=3).toPandas()
    for g, part in out.groupby("g"):
        assert part.sort_values("if_score").iloc[0]["rid"] == 999
        frac = part["anomalia_if"].mean()
        assert 0.05 <= frac <= 0.15


# --------------------------------------------------------------- clusters

def test_ward_on_separated_blobs(spark):
    from pyspark.ml.linalg import Vectors
    rnd = np.random.default_rng(1)
    centers = [(0, 0), (10, 0), (0, 10)]
    rows = [(i, Vectors.dense(centers[i % 3][0] + rnd.normal(0, .3), centers[i % 3][1] + rnd.normal(0, .3)))
            for i in range(60)]
    df = spark.createDataFrame(rows, ["id", "features"])
    got = {r.id: r.cluster_ward for r in ward_clusters(df, 3, id_col="id").collect()}
    for c in range(3):
        assert len({got[i] for i in range(60) if i % 3 == c}) == 1
    assert len(set(got.values())) == 3


# ------------------------------------------------------------- supervised

def test_auc_and_cumsum_match_bruteforce(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 15))) for _ in range(200)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    got = auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc
    assert got == pytest.approx(brute)
    vals = [(float(i), float(i % 7)) for i in range(100)]
    cs = cumulative_sum(spark.createDataFrame(vals, "k double, v double"), "k", "v", "c", n_buckets=8)
    got = {r.k: r.c for r in cs.collect()}
    run = 0.0
    for k, v in vals:
        run += v
        assert got[k] == pytest.approx(run)


def test_lag_modes(spark):
    import datetime as dt
    from sentinela.operators.windows import lag_features
    rows = [("a", dt.date(2020, 1, 1), 1), ("a", dt.date(2020, 2, 1), 2), ("a", dt.date(2020, 4, 1), 4)]
    df = spark.createDataFrame(rows, "e string, m date, v int")
    row = {r.m.month: r.v_lag1 for r in lag_features(df, ["e"], "m", ["v"], [1], mode="row").collect()}
    cal = {r.m.month: r.v_lag1 for r in lag_features(df, ["e"], "m", ["v"], [1, 2], mode="calendar").collect()}
    assert row == {1: None, 2: 1, 4: 2}      # positional: April's previous row is February
    assert cal == {1: None, 2: 1, 4: None}   # calendar: March is missing


def test_densify_all_weeks_and_unique(spark):
    from sentinela.operators.quality import assert_unique
    rows = [(2021, 5, "E", "D", "H", 1, 1, 1)]
    df = spark.createDataFrame(rows, "anio int, semana int, entidad_federativa string, enfermedad string, "
                                     "sexo string, casos_semana int, casos_acumulado int, casos_acum_anterior int")
    assert B.densify(df, ["E"], ["D"], ["H"], only_observed_weeks=False).count() == 53
    assert_unique(df, ["anio", "semana"])
    with pytest.raises(ValueError):
        assert_unique(df.unionByName(df), ["anio", "semana"])


def test_kmeans_multistart_recovers_blobs(spark):
    from pyspark.ml.linalg import Vectors
    from sentinela.operators.cluster import kmeans_best
    rnd = np.random.default_rng(2)
    centers = [(0, 0), (8, 0), (0, 8), (8, 8)]
    rows = [(i, Vectors.dense(centers[i % 4][0] + rnd.normal(0, .5), centers[i % 4][1] + rnd.normal(0, .5)))
            for i in range(200)]
    df = spark.createDataFrame(rows, ["id", "features"])
    _, pred, cost = kmeans_best(df, 4, n_init=5)
    got = {r.id: r.cluster for r in pred.collect()}
    for c in range(4):
        assert len({got[i] for i in range(200) if i % 4 == c}) == 1
    from pyspark.ml.clustering import KMeans
    cost_ml = min(KMeans(k=4, seed=i).fit(df).summary.trainingCost for i in range(5))
    assert cost <= cost_ml * 1.001


def test_outbreak_months(spark):
    import datetime as dt
    from sentinela.operators.anomaly import outbreak_months
    rows = [("a", dt.date(2020, m, 1), int(m in (3, 1))) for m in (3, 2, 1)]
    got = [(r.g, r.m.month) for r in outbreak_months(spark.createDataFrame(rows, "g string, m date, brote int"),
                                                      ["g"], "m").collect()]
    assert got == [("a", 1), ("a", 3)]


def test_quantile_equals_numpy(spark):
    from sentinela.operators.scaling import median_impute, quantile
    rnd = np.random.default_rng(4)
    rows = [(g, float(v)) for g in ("a", "b", None) for v in rnd.integers(0, 40, 101 if g == "a" else 7) / 4] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    values = lambda g: [x for k, x in rows if k == g and x is not None]
    for q in (0.0, 0.1, 0.5, 0.77, 1.0):
        got = {r.g: r.v for r in quantile(df, "x", q, ["g"], "v").collect()}
        assert got == {g: pytest.approx(np.quantile(values(g), q)) for g in ("a", "b", None)}
        assert quantile(df, "x", q, out="v").first().v == pytest.approx(np.quantile([x for _, x in rows if x is not None], q))
    filled = median_impute(df, ["x"], ["g"])
    assert filled.count() == len(rows) and [r.x for r in filled.where("g = 'c'").collect()] == [None]


def test_counts_beyond_32_bits(spark):
    big = 2**32
    df = spark.createDataFrame([("A", 1, big, big), ("A", 2, 3 * big, 0)], "g string, w int, cum bigint, weekly bigint")
    got = sorted((r.w, r.casos_nuevos) for r in new_from_cumulative(df, ["g"], "w", "cum", "weekly", "full").collect())
    assert got == [(1, big), (2, 2 * big)]
