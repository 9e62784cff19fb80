"""Smaller helpers: inventory, quality modes, supervised baseline, cluster utilities, PCA."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentinela.functions.numeric import band_label
from sentinela.operators.cluster import cluster_profile, label_clusters, label_comparison, pca_2d, preprocess
from sentinela.operators.quality import assert_rules, spot_check, standardization_check, violations
from sentinela.operators.scaling import standardize
from sentinela.operators.supervised import binary_metrics, logistic_baseline, with_weights
from sentinela.sources.surveillance import file_inventory, first_existing


def test_file_inventory_and_first_existing(spark, tmp_dir):
    for y, names in {2019: ["a.pdf", "b.pdf"], 2020: ["a.pdf"]}.items():
        os.makedirs(f"{tmp_dir}/{y}", exist_ok=True)
        for n in names:
            with open(f"{tmp_dir}/{y}/bol_{n}", "wb") as f:
                f.write(b"%PDF-1.4 x")
    per_year, dups = file_inventory(spark, f"{tmp_dir}/*/*.pdf")
    assert {r.anio: r.n_archivos for r in per_year.collect()} == {2019: 2, 2020: 1}
    assert [r.nombre for r in dups.collect()] == ["bol_a.pdf"]
    assert first_existing(spark, f"{tmp_dir}/2020", ["missing.pdf", "bol_a.pdf"]).endswith("bol_a.pdf")
    with pytest.raises(FileNotFoundError):
        first_existing(spark, tmp_dir, ["nope.csv"])


def test_quality_modes(spark):
    df = spark.createDataFrame([(2019, 1, "H"), (2030, 54, "X")], "anio int, semana int, sexo string")
    rules = {"anio": ~F.col("anio").between(2015, 2027), "semana": ~F.col("semana").between(1, 53),
             "sexo": ~F.col("sexo").isin("H", "M")}
    got = {r.regla: r.n_violaciones for r in violations(df, rules, "t").collect()}
    assert got == {"anio": 1, "semana": 1, "sexo": 1}
    assert assert_rules(df.where("anio = 2019"), rules).count() == 1
    with pytest.raises(Exception):
        assert_rules(df, rules).collect()
    exp = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    act = spark.createDataFrame([(1, 10), (2, 21)], "k int, v int")
    assert sorted(r.k for r in spot_check(exp, act, ["k"], "v").collect()) == [2, 3]
    z = standardize(spark.createDataFrame([(float(i),) for i in range(10)], "x double"), ["x"])
    assert standardization_check(z, ["x_z"]).first().ok


def test_supervised_baseline(spark):
    rows = [(float(i), 1 if i > 10 else 0) for i in range(40)]
    df = with_weights(spark.createDataFrame(rows, "x double, y int"), "y")
    model = logistic_baseline(df, ["x"], "y", weight="peso")
    pred = model.transform(df).select("y", F.col("prediction").cast("int").alias("p"))
    m = binary_metrics(pred, "y", "p").first()
    assert m.recall >= 0.9 and m.accuracy >= 0.9


def test_cluster_helpers_and_pca(spark):
    rnd = np.random.default_rng(0)
    rows = [(i, float(rnd.normal(i % 2 * 5, 1)), float(rnd.normal(0, 1)), float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    x = preprocess(df, ["a", "b", "c"], log_cols=[])
    scores, loadings, ratio = pca_2d(x)
    assert ratio[0] >= ratio[1] > 0 and scores.count() == 60
    assert all(loadings[np.argmax(np.abs(loadings[:, j])), j] > 0 for j in range(2))
    lab = x.withColumn("cluster", (F.col("a") > 2.5).cast("int"))
    prof = {r.cluster: r.n for r in cluster_profile(lab, "cluster", ["a"], flag=None).collect()}
    assert sum(prof.values()) == 60
    named = label_clusters(lab, "cluster", {0: "bajo", 1: "alto"})
    assert {r.etiqueta for r in named.select("etiqueta").distinct().collect()} == {"bajo", "alto"}
    cmp = label_comparison(lab, lab.withColumnRenamed("cluster", "otro"), "id", "cluster", "otro").collect()
    assert all(r.cluster == r.otro for r in cmp)


def test_band_label(spark):
    df = spark.createDataFrame([(96.0,), (91.0,), (50.0,), (None,)], "x double")
    got = [r.b for r in df.select(band_label("x", [(95.0, "meta"), (90.0, "aceptable")], "bajo").alias("b")).collect()]
    assert got == ["meta", "aceptable", "bajo", None]
