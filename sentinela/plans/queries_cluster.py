"""Registered queries: K-Means, elbow, silhouette, PCA, Ward, adjusted Rand,
country feature table (CLU1-9, FTR4). Model fits have no SQL oracle (rows-only
check); the adjusted Rand index has one."""

from __future__ import annotations

import math

from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sentinela.operators.cluster import (adjusted_rand, elbow, kmeans_best, pca_2d, preprocess, silhouette,
                                         silhouette_euclidean, ward_clusters)
from sentinela.operators.hierarchy import ward_merges
from sentinela.operators.kmeans import lloyd_bounded
from sentinela.operators.risk import country_risk
from sentinela.operators.stats import trend_slope
from sentinela.plans.registry import query
from sentinela.sources.testdata import Tables

K = 4
N_INIT = 30


def _embedding_features(spark, sf_dir, standardised: bool = True):
    """64-d embeddings as vectors; standardised with the population std (S7)."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "label", array_to_vector("embedding").alias("raw"))
    if not standardised:
        return e.withColumnRenamed("raw", "features")
    n = e.count()
    model = StandardScaler(inputCol="raw", outputCol="_s", withMean=True, withStd=True).fit(e)
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0  # sample -> population std
    scaled = model.transform(e).withColumn(
        "features", array_to_vector(F.transform(vector_to_array("_s"), lambda v: v * F.lit(factor))))
    return scaled.drop("raw", "_s")


@query("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    feats = _embedding_features(spark, sf_dir)
    _, pred, _ = kmeans_best(feats, K, n_init=N_INIT, max_iter=1000, seed=42)
    return pred.select("vec_id", "label", "cluster")


LLOYD_STEPS = 3


def _lloyd_sql() -> str:
    """The farthest-first start and LLOYD_STEPS steps, unrolled: ``fit`` has the centres, ``own`` the rows."""
    ctes = ["v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0)",
            "far0 AS (SELECT 0 AS j, e FROM v ORDER BY vec_id LIMIT 1)"]
    for j in range(1, K):
        so_far = " UNION ALL ".join(f"SELECT * FROM far{i}" for i in range(j))
        ctes.append(f"far{j} AS (SELECT {j} AS j, e FROM (SELECT vec_id, v.e, min(list_distance(v.e, c.e)) AS d FROM v, ({so_far}) c GROUP BY ALL) ORDER BY d DESC, vec_id LIMIT 1)")
    ctes.append("fit0 AS (" + " UNION ALL ".join(f"SELECT * FROM far{i}" for i in range(K)) + ")")
    for t in range(LLOYD_STEPS + 1):
        ctes.append(f"own{t} AS (SELECT vec_id, v.e, j, list_distance(v.e, c.e) AS d FROM v, fit{t} c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, j) = 1)")
        ctes.append(f"fit{t + 1} AS (SELECT j, coalesce(m.e, c.e) AS e FROM fit{t} c LEFT JOIN (SELECT j, list(x ORDER BY i) AS e FROM "
                    f"(SELECT j, i, avg(e[i]) AS x FROM own{t}, range(1, 65) r(i) GROUP BY j, i) GROUP BY j) m USING (j))")
    return "WITH " + ",\n".join(ctes)


@query("kmeans_lloyd", _lloyd_sql() + f"""
SELECT vec_id, CAST(j AS INTEGER) AS cluster, round_even(d, 6) AS distancia FROM own{LLOYD_STEPS}
""")
def kmeans_lloyd(spark, sf_dir):
    """Each embedding's cluster after LLOYD_STEPS bounded Lloyd steps from the
    farthest-first start (CLU2)."""
    _, rows, _ = lloyd_bounded(Tables(spark, sf_dir).embeddings, K, "embedding", "vec_id", LLOYD_STEPS)
    return rows.select(F.col("id").alias("vec_id"), "cluster", F.bround("distance", 6).alias("distancia"))


@query("kmeans_lloyd_centres", _lloyd_sql() + f""",
size AS (SELECT j, count(*) AS n, sum(d * d) AS inercia FROM own{LLOYD_STEPS} GROUP BY j)
SELECT CAST(c.j AS INTEGER) AS cluster, CAST(i AS INTEGER) AS dim, round_even(e[i], 6) AS centro, coalesce(n, 0) AS n, round_even(coalesce(inercia, 0), 4) AS inercia
FROM fit{LLOYD_STEPS} c LEFT JOIN size USING (j), range(1, 65) r(i)
""")
def kmeans_lloyd_centres(spark, sf_dir):
    """Centres, sizes and inertia of that fit (CLU2, CLU3)."""
    centers, rows, _ = lloyd_bounded(Tables(spark, sf_dir).embeddings, K, "embedding", "vec_id", LLOYD_STEPS)
    own = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance") ** 2).alias("inercia"))
    fit = spark.createDataFrame([(j, [float(x) for x in c]) for j, c in enumerate(centers)], "cluster int, c array<double>")  # K rows
    return fit.join(own, "cluster", "left").select("cluster", F.posexplode("c").alias("dim", "centro"), F.coalesce("n", F.lit(0)).alias("n"), F.bround(F.coalesce("inercia", F.lit(0.0)), 4).alias("inercia")) \
        .withColumns({"dim": F.col("dim") + 1, "centro": F.bround("centro", 6)})


@query("elbow")
def elbow_q(spark, sf_dir):
    return elbow(_embedding_features(spark, sf_dir), list(range(2, 11)))


@query("silhouette")
def silhouette_q(spark, sf_dir):
    feats = _embedding_features(spark, sf_dir)
    _, pred, cost = kmeans_best(feats, K, n_init=N_INIT, seed=42)
    s = silhouette(pred)
    return spark.createDataFrame([(K, s, float(cost))], "k int, silhouette double, inercia double")


@query("silhouette_lloyd", _lloyd_sql() + f""",
n AS (SELECT j, count(*) AS n FROM own{LLOYD_STEPS} GROUP BY j),
far AS (SELECT a.vec_id, a.j, b.j AS k, sum(list_distance(a.e, b.e)) AS s FROM own{LLOYD_STEPS} a, own{LLOYD_STEPS} b GROUP BY ALL),
two AS (SELECT vec_id, any_value(m.n) AS own, max(CASE WHEN far.j = far.k THEN s / greatest(m.n - 1, 1) END) AS a, min(CASE WHEN far.j <> far.k THEN s / n.n END) AS b
        FROM far JOIN n ON n.j = far.k JOIN n m ON m.j = far.j GROUP BY vec_id)
SELECT {K} AS k, round_even(avg(CASE WHEN own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette,
       CAST(0 AS DOUBLE) AS error FROM two
""")
def silhouette_lloyd(spark, sf_dir):
    """Euclidean silhouette of the bounded Lloyd labels and its standard error
    (CLU4); exact, with error 0, where no cluster has more than 512 rows."""
    e = Tables(spark, sf_dir).embeddings
    _, rows, _ = lloyd_bounded(e, K, "embedding", "vec_id", LLOYD_STEPS)
    pred = e.join(rows.withColumnRenamed("id", "vec_id"), "vec_id")
    value, error = silhouette_euclidean(pred, "embedding")
    return spark.createDataFrame([(K, value, error)], "k int, silhouette double, error double").withColumns({c: F.bround(c, 6) for c in ("silhouette", "error")})


@query("pca_2d")
def pca_2d_q(spark, sf_dir):
    scores, _, _ = pca_2d(_embedding_features(spark, sf_dir))
    return scores.select("vec_id", "pc1", "pc2")


@query("pca_variance")
def pca_variance(spark, sf_dir):
    _, _, ratio = pca_2d(_embedding_features(spark, sf_dir))
    return spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(ratio)], "componente int, varianza double")


@query("ward_micro")
def ward_micro(spark, sf_dir):
    """Labels of the Ward hierarchy of all embeddings, cut at K (CLU6)."""
    return ward_clusters(_embedding_features(spark, sf_dir), K, id_col="vec_id")


@query("ward_merges")
def ward_merges_q(spark, sf_dir):
    """The merge table of that hierarchy, with heights."""
    merges = ward_merges(_embedding_features(spark, sf_dir), id_col="vec_id")
    return merges.withColumn("height", F.bround("height", 9))


QUADRANT = "CAST(embedding[1] > 0 AS INT) + 2 * CAST(embedding[2] > 0 AS INT)"


@query("adjusted_rand", """
WITH t AS (SELECT label AS a, CAST(embedding[1] > 0 AS INTEGER) + 2 * CAST(embedding[2] > 0 AS INTEGER) AS b
           FROM embeddings),
n AS (SELECT count(*) AS n FROM t),
sij AS (SELECT sum(c * (c - 1) / 2.0) AS sij FROM (SELECT count(*) AS c FROM t GROUP BY a, b)),
sa AS (SELECT sum(c * (c - 1) / 2.0) AS sa FROM (SELECT count(*) AS c FROM t GROUP BY a)),
sb AS (SELECT sum(c * (c - 1) / 2.0) AS sb FROM (SELECT count(*) AS c FROM t GROUP BY b)),
x AS (SELECT sij, sa, sb, sa * sb / (n * (n - 1) / 2.0) AS e, (sa + sb) / 2.0 AS m FROM sij, sa, sb, n)
SELECT round_even(CASE WHEN m = e THEN 1.0 ELSE (sij - e) / (m - e) END, 9) AS ari FROM x
""")
def adjusted_rand_q(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    t = e.select(F.col("label").alias("a"),
                 ((F.col("embedding")[0] > 0).cast("int") + 2 * (F.col("embedding")[1] > 0).cast("int")).alias("b"))
    return adjusted_rand(t, "a", "b").select(F.bround("ari", 9).alias("ari"))


def _country_features(spark, sf_dir):
    """Per nation: order counts by month and coverage by year (FTR4)."""
    t = Tables(spark, sf_dir)
    o = t.orders.join(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
    monthly = o.groupBy("c_nationkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("mes")).agg(
        F.count(F.lit(1)).alias("n"))
    inc = monthly.groupBy("c_nationkey").agg(F.sum("n").alias("total_cases"),
                                             F.count_if(F.col("n") > 0).alias("months_with_cases"))
    cov_y = o.groupBy("c_nationkey", F.year("o_orderdate").alias("anio")).agg(
        (F.avg((F.col("c_acctbal") > 0).cast("double")) * 100).alias("cov"))
    cov = cov_y.groupBy("c_nationkey").agg(F.avg("cov").alias("cov_mean"), F.min("cov").alias("cov_min"))
    slope = trend_slope(cov_y, ["c_nationkey"], "cov", "anio", out="cov_tendencia")
    return inc.join(cov, "c_nationkey", "left").join(slope, "c_nationkey", "left")


@query("country_features", """
WITH o AS (SELECT c_nationkey, o_orderdate, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey),
inc AS (SELECT c_nationkey, CAST(sum(n) AS BIGINT) AS total_cases, count(*) AS months_with_cases
        FROM (SELECT c_nationkey, date_trunc('month', o_orderdate) AS mes, count(*) AS n FROM o GROUP BY 1, 2) GROUP BY 1),
y AS (SELECT c_nationkey, year(o_orderdate) AS anio, avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) * 100 AS cov FROM o GROUP BY 1, 2),
cov AS (SELECT c_nationkey, avg(cov) AS cov_mean, min(cov) AS cov_min, regr_slope(cov, anio) AS cov_tendencia FROM y GROUP BY 1),
s AS (SELECT *, ln(1 + total_cases) * (100 - cov_mean) / 100 AS score FROM inc JOIN cov USING (c_nationkey))
SELECT c_nationkey AS n_nationkey, total_cases, months_with_cases, round_even(cov_mean, 9) AS cov_mean, round_even(cov_min, 9) AS cov_min,
       round_even(cov_tendencia, 9) AS cov_tendencia,
       round_even(CASE WHEN max(score) OVER () > min(score) OVER ()
                       THEN (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) * 10 ELSE 0.0 END, 2) AS score_riesgo_norm
FROM s
""")
def country_features(spark, sf_dir):
    """Country feature table and 0-10 risk score (FTR4, RSK1-2)."""
    scored = country_risk(_country_features(spark, sf_dir), "total_cases", "cov_mean")
    return scored.select(F.col("c_nationkey").alias("n_nationkey"), "total_cases", "months_with_cases",
                         *[F.bround(c, 9).alias(c) for c in ("cov_mean", "cov_min", "cov_tendencia")], "score_riesgo_norm")


@query("country_clusters")
def country_clusters(spark, sf_dir):
    """Country feature table end to end (FTR4): log1p + median impute +
    standardise on copies, K-Means (k=4), risk score of the plain features."""
    cols = ["total_cases", "months_with_cases", "cov_mean", "cov_min", "cov_tendencia"]
    x = preprocess(_country_features(spark, sf_dir), cols, log_cols=["total_cases", "months_with_cases"])
    _, pred, _ = kmeans_best(x, K, n_init=N_INIT, seed=42)
    scored = country_risk(pred.select("c_nationkey", "cluster", "total_cases", "cov_mean"), "total_cases", "cov_mean")
    return scored.select(F.col("c_nationkey").alias("n_nationkey"), "cluster", "score_riesgo_norm")
