"""Clustering and matrix analytics (CLU1-9) on Spark ML.

Fits are distributed; what reaches the driver is a fitted model or a summary
of k centres."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.operators.hierarchy import distinct_points, merges_of, ward_labels
from sentinela.operators.kmeans import as_array, assigned, kmeans_many
from sentinela.operators.scaling import median_impute, standardize
from sentinela.sinks.writers import checkpoint_parquet


def preprocess(df: DataFrame, cols: list[str], log_cols: list[str] = (), out: str = "features") -> DataFrame:
    """log1p selected columns, median-impute, standardise with population std,
    assemble a vector (CLU1). The input columns stay as they are; the
    standardised values are added as ``{col}_z``."""
    own = {c: f"_prep_{c}" for c in cols}
    x = df.withColumns({own[c]: F.log1p(F.col(c).cast("double")) if c in log_cols else F.col(c).cast("double") for c in cols})
    x = median_impute(x, list(own.values()))
    x = standardize(x, list(own.values()), suffix="_z").drop(*own.values())
    x = x.withColumnsRenamed({f"{own[c]}_z": f"{c}_z" for c in cols})
    return VectorAssembler(inputCols=[f"{c}_z" for c in cols], outputCol=out).transform(x)


def kmeans_best(df: DataFrame, k: int, features: str = "features", n_init: int = 30, max_iter: int = 1000,
                seed: int = 42, order_by: str | None = None):
    """Best of ``n_init`` seeded K-Means restarts by cost (CLU2): all restarts
    advance in the same pass over the data (``kmeans.kmeans_many``), at any
    size. Cluster ids are renumbered by the mean of ``order_by`` (descending)
    when given, else by the first centroid coordinate. Returns (centres,
    predictions with ``cluster``, cost)."""
    fit = kmeans_many(df, [k], features, n_init, max_iter, seed=seed)[0]
    centers = _ordered(fit.centers)
    pred = assigned(df, centers, features)
    if order_by:
        keyed = pred.groupBy("cluster").agg(F.avg(order_by).alias("_key"))
        remap = keyed.select(F.col("cluster").alias("_raw"),
                             (F.row_number().over(Window.orderBy(F.desc("_key"), "cluster")) - 1).alias("_c"))
        pred = pred.withColumnRenamed("cluster", "_raw").join(F.broadcast(remap), "_raw").drop("_raw") \
            .withColumnRenamed("_c", "cluster")  # k rows
    return centers, pred, fit.cost


def _ordered(centers: np.ndarray) -> np.ndarray:
    return centers[np.lexsort(centers.T[::-1])]


def elbow(df: DataFrame, ks: list[int], features: str = "features", seed: int = 42, n_init: int = 20,
          max_iter: int = 500) -> DataFrame:
    """Inertia (cost of the best of ``n_init`` restarts) for each k (CLU3); the
    restarts of all k share their passes over the data."""
    rows = [(f.k, f.cost) for f in kmeans_many(df, ks, features, n_init, max_iter, seed=seed)]
    return df.sparkSession.createDataFrame(rows, "k int, inercia double")


def silhouette(pred: DataFrame, features: str = "features", label: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distance (CLU4), computed by
    Spark from per-cluster statistics (no pairwise distances)."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=label, metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(pred.withColumn(label, F.col(label).cast("double"))))


def silhouette_euclidean(pred: DataFrame, features: str = "features", label: str = "cluster", per_cluster: int = 512, seed: int = 42) -> tuple[float, float]:
    """Mean Euclidean silhouette (CLU4) and its standard error.

    A stratified estimate: ``per_cluster`` rows of each cluster, those of the lowest
    seeded hashes, against all rows of every cluster. The sample is of a
    fixed size and goes to every task, which adds up its rows' distances to each
    cluster; no pair of rows leaves a task. With clusters of at most
    ``per_cluster`` rows the value is exact and the error 0. Rows alone in their cluster count
    0, rows without a label or vector take no part; one cluster has no silhouette (NaN)."""
    spark = pred.sparkSession
    rows = checkpoint_parquet(pred.select(F.col(label).alias("c"), as_array(pred, features).alias("v")).where("c IS NOT NULL AND v IS NOT NULL"), "silhouette-rows")
    sizes = {r["c"]: r["n"] for r in rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}  # k rows
    if len(sizes) < 2:
        return float("nan"), float("nan")
    names = sorted(sizes)
    place = F.row_number().over(Window.partitionBy("c").orderBy(F.xxhash64(F.lit(seed), "v"), "v"))  # cut to per_cluster before the shuffle
    sample = rows.withColumn("_place", place).where(F.col("_place") <= per_cluster).collect()
    shared = spark.sparkContext.broadcast(np.array([r["v"] for r in sample]))
    own = np.array([names.index(r["c"]) for r in sample])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, total = shared.value, np.zeros((len(shared.value), len(names)))
        for batch in batches:
            X, c = np.array(batch.column(1).to_pylist(), dtype=float), batch.column(0).to_pylist()
            of = np.array([names.index(x) for x in c])
            for i in range(0, len(X), 256):
                gaps = np.sqrt(((points[:, None, :] - X[None, i:i + 256]) ** 2).sum(axis=2))
                for k in range(len(names)):
                    total[:, k] += gaps[:, of[i:i + 256] == k].sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(points))), pa.array(list(total))], names=["i", "s"])

    parts = rows.mapInArrow(add_up, "i bigint, s array<double>").groupBy("i").agg(F.array(*[F.sum(F.col("s")[k]) for k in range(len(names))]).alias("s")).collect()
    total = np.array([r["s"] for r in sorted(parts, key=lambda r: r["i"])])
    n = np.array([sizes[c] for c in names], dtype=float)
    at = np.arange(len(own))
    inside = total[at, own] / np.maximum(n[own] - 1, 1)
    other = total / n
    other[at, own] = np.inf
    outside = other.min(axis=1)
    width = np.maximum(inside, outside)
    s = np.where((n[own] > 1) & (width > 0), (outside - inside) / np.where(width > 0, width, 1), 0.0)
    taken = np.bincount(own)
    means = np.array([s[own == k].mean() for k in range(len(names))])
    spread = np.array([s[own == k].var(ddof=1) if taken[k] > 1 else 0.0 for k in range(len(names))])
    share = n / n.sum()
    return float((share * means).sum()), float(np.sqrt((share**2 * spread / taken * (1 - taken / n)).sum()))


def pca_2d(df: DataFrame, features: str = "features", k: int = 2):
    """Principal components (CLU5). Input should be standardised (PCA's
    transform does not centre). Signs are fixed so that each component's
    largest-magnitude loading is positive. Returns (scores DataFrame with
    pc1..pck, loadings array, explained variance ratios)."""
    model = PCA(k=k, inputCol=features, outputCol="_pc").fit(df)
    pc = model.pc.toArray()
    signs = np.array([1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0 for j in range(k)])
    arr = vector_to_array(F.col("_pc"))
    out = model.transform(df)
    out = out.select("*", *[(arr[j] * F.lit(float(signs[j]))).alias(f"pc{j + 1}") for j in range(k)]).drop("_pc")
    return out, pc * signs, list(model.explainedVariance.toArray())


def ward_clusters(df: DataFrame, k: int, features: str = "features", id_col: str = "id") -> DataFrame:
    """(id, ``cluster_ward``): the Ward hierarchy of all rows cut at k clusters
    (CLU6), numbered by their smallest id (see ``hierarchy``)."""
    points = checkpoint_parquet(distinct_points(df, features, id_col), "ward-clusters")
    return ward_labels(df, merges_of(points), k, features, id_col, points=points)


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labellings from contingency counts (CLU7)."""
    cont = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("nij"))
    c2 = lambda c: c.cast("double") * (c.cast("double") - 1) / 2.0
    rows_a = df.groupBy(a).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(c2(F.col("n"))).alias("sa"), F.sum("n").alias("n"))
    rows_b = df.groupBy(b).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(c2(F.col("n"))).alias("sb"))
    sij = cont.agg(F.sum(c2(F.col("nij"))).alias("sij"))
    x = sij.crossJoin(rows_a).crossJoin(rows_b)
    exp = F.col("sa") * F.col("sb") / c2(F.col("n"))
    mx = (F.col("sa") + F.col("sb")) / 2
    return x.select(F.when(mx == exp, F.lit(1.0)).otherwise((F.col("sij") - exp) / (mx - exp)).alias("ari"))


def cluster_profile(pred: DataFrame, cluster: str, cols: list[str], flag: str | None = None, digits: int = 2) -> DataFrame:
    """Per-cluster means rounded, size and flag count (AGG14/AGG15)."""
    aggs = [F.bround(F.avg(c), digits).alias(c) for c in cols] + [F.count(F.lit(1)).alias("n")]
    if flag:
        aggs.append(F.sum(F.col(flag).cast("int")).alias(f"n_{flag}"))
    return pred.groupBy(cluster).agg(*aggs)


def label_clusters(pred: DataFrame, cluster: str, labels: dict[int, str], out: str = "etiqueta") -> DataFrame:
    """Cluster id -> text label through a small broadcast map (CLU9)."""
    m = F.create_map(*[x for kv in labels.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return pred.withColumn(out, m[F.col(cluster)])


def label_comparison(a: DataFrame, b: DataFrame, key: str, la: str, lb: str) -> DataFrame:
    """Side-by-side labels of two clusterings with an agreement count table (CLU8)."""
    j = a.select(key, la).join(b.select(key, lb), key)
    return j.groupBy(la, lb).agg(F.count(F.lit(1)).alias("n"))


def best_k(df: DataFrame, ks: list[int], features: str = "features", n_init: int = 30, seed: int = 42) -> DataFrame:
    """Euclidean silhouette with its standard error, and inertia, for each k; the
    row with the best silhouette is flagged, first k on ties (CLU4, Q8)."""
    rows = []
    for fit in kmeans_many(df, ks, features, n_init, seed=seed):
        value, error = silhouette_euclidean(assigned(df, _ordered(fit.centers), features), features, seed=seed)
        rows.append((fit.k, value, error, fit.cost))
    best = max(rows, key=lambda r: (r[1], -r[0]))[0]
    return df.sparkSession.createDataFrame([(k, s, e, c, k == best) for k, s, e, c in rows],
                                           "k int, silhouette double, error double, inercia double, mejor boolean")
