"""Registered queries: 1-D DBSCAN, label union/intersection, kappa, label
summary, isolation forest (ANO1-5) on daily event counts per event type."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentinela.operators.anomaly import cohen_kappa, combine_labels, dbscan_1d, label_summary
from sentinela.operators.forest import forest_boxes, forest_sql, isolation_forest
from sentinela.operators.scaling import standardize
from sentinela.plans.registry import query
from sentinela.sinks.writers import checkpoint_parquet
from sentinela.sources.testdata import Tables

EPS, MIN_SAMPLES = 1.2, 2
Z_LIMIT = 2.0

DAILY_SQL = """SELECT event_type, CAST(ts AS DATE) AS dia, count(*) AS n_eventos FROM events GROUP BY 1, 2"""


# DBSCAN by its definition, with self-joins instead of the operator's windows: neighbours are
# counted, a core point without a core point just below it starts a cluster, a border point
# takes the lowest number of the clusters within reach.
DBSCAN_SQL = f"""WITH daily AS ({DAILY_SQL}),
cores AS (SELECT a.event_type, a.dia, a.n_eventos AS x FROM daily a JOIN daily b
          ON a.event_type = b.event_type AND abs(a.n_eventos - b.n_eventos) <= {EPS}
          GROUP BY ALL HAVING count(*) >= {MIN_SAMPLES}),
starts AS (SELECT DISTINCT event_type, x FROM cores c WHERE NOT EXISTS (
             SELECT 1 FROM cores d WHERE d.event_type = c.event_type AND d.x < c.x AND c.x - d.x <= {EPS})),
member AS (SELECT c.event_type, c.dia, c.x, max(s.x) AS start FROM cores c JOIN starts s
           ON s.event_type = c.event_type AND s.x <= c.x GROUP BY ALL),
numbered AS (SELECT event_type, start, row_number() OVER (PARTITION BY event_type ORDER BY min(dia)) - 1 AS num
             FROM member GROUP BY event_type, start),
reach AS (SELECT t.event_type, t.dia, min(CASE WHEN m.x = t.n_eventos THEN n.num END) AS own, min(n.num) AS num
          FROM daily t JOIN member m ON m.event_type = t.event_type AND abs(m.x - t.n_eventos) <= {EPS}
          JOIN numbered n ON n.event_type = m.event_type AND n.start = m.start GROUP BY ALL),
db AS (SELECT t.*, CAST(coalesce(r.own, r.num, -1) AS INTEGER) AS db_label, coalesce(r.own, r.num, -1) = -1 AS anomalia_db
       FROM daily t LEFT JOIN reach r USING (event_type, dia))
"""


def daily_counts(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return ev.groupBy("event_type", F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("n_eventos"))


@query("dbscan_1d", DBSCAN_SQL + "SELECT * FROM db")
def dbscan_1d_q(spark, sf_dir):
    return dbscan_1d(daily_counts(spark, sf_dir), ["event_type"], "n_eventos", "dia", EPS, MIN_SAMPLES)


def _labels(spark, sf_dir):
    d = dbscan_1d(daily_counts(spark, sf_dir), ["event_type"], "n_eventos", "dia", EPS, MIN_SAMPLES)
    z = standardize(d, ["n_eventos"], ["event_type"])
    z = z.withColumn("anomalia_z", F.abs("n_eventos_z") > Z_LIMIT)
    return combine_labels(z, "anomalia_z", "anomalia_db").drop("n_eventos_z")


LABELS_SQL = DBSCAN_SQL + f""",
z AS (SELECT *, abs((n_eventos - avg(n_eventos) OVER g) /
                    CASE WHEN stddev_pop(n_eventos) OVER g > 0 THEN stddev_pop(n_eventos) OVER g ELSE 1.0 END) > {Z_LIMIT}
                AS anomalia_z
      FROM db WINDOW g AS (PARTITION BY event_type)),
lab AS (SELECT *, CAST(anomalia_z OR anomalia_db AS INTEGER) AS brote,
               CAST(anomalia_z AND anomalia_db AS INTEGER) AS brote_estricto FROM z)
"""


@query("outbreak_labels", LABELS_SQL + "SELECT * FROM lab")
def outbreak_labels(spark, sf_dir):
    return _labels(spark, sf_dir)


@query("kappa", LABELS_SQL + """
SELECT event_type, count(*) AS n,
  round_even(sum(CASE WHEN anomalia_z = anomalia_db THEN 1 ELSE 0 END) / count(*), 9) AS po,
  round_even((sum(CAST(anomalia_z AS INTEGER)) * sum(CAST(anomalia_db AS INTEGER))
    + (count(*) - sum(CAST(anomalia_z AS INTEGER))) * (count(*) - sum(CAST(anomalia_db AS INTEGER))))
    / (count(*) * count(*)), 9) AS pe,
  round_even(CASE WHEN pe_raw < 1 THEN (po_raw - pe_raw) / (1 - pe_raw) END, 9) AS kappa
FROM (SELECT *, sum(CASE WHEN anomalia_z = anomalia_db THEN 1.0 ELSE 0.0 END) OVER g / count(*) OVER g AS po_raw,
             (sum(CAST(anomalia_z AS INTEGER)) OVER g * sum(CAST(anomalia_db AS INTEGER)) OVER g
              + (count(*) OVER g - sum(CAST(anomalia_z AS INTEGER)) OVER g)
              * (count(*) OVER g - sum(CAST(anomalia_db AS INTEGER)) OVER g)) / (count(*) OVER g * count(*) OVER g) AS pe_raw
      FROM lab WINDOW g AS (PARTITION BY event_type))
GROUP BY event_type, po_raw, pe_raw
""")
def kappa(spark, sf_dir):
    k = cohen_kappa(_labels(spark, sf_dir), ["event_type"], "anomalia_z", "anomalia_db")
    return k.select("event_type", "n", *[F.bround(c, 9).alias(c) for c in ["po", "pe", "kappa"]])


@query("label_distribution", LABELS_SQL + """
SELECT event_type, CAST(sum(brote) AS BIGINT) AS n_brote, CAST(sum(brote_estricto) AS BIGINT) AS n_brote_estricto,
       count(*) AS n
FROM lab GROUP BY 1
""")
def label_distribution(spark, sf_dir):
    return label_summary(_labels(spark, sf_dir), ["event_type"], ["brote", "brote_estricto"])


IF_FEATURES = ["n_eventos", "valor_total", "valor_medio", "usuarios"]

FOREST_SQL = f"""WITH daily AS (
SELECT event_type, CAST(ts AS DATE) AS dia, count(*) AS n_eventos, round_even(sum(value), 6) AS valor_total, (round_even(sum(value), 6)) / count(*) AS valor_medio,
       count(DISTINCT user_id) AS usuarios FROM events GROUP BY 1, 2),
{forest_sql("daily", "event_type", "dia", IF_FEATURES)}
"""


def daily_features(spark, sf_dir):
    """Four daily features per event type."""
    ev = Tables(spark, sf_dir).events
    return ev.groupBy("event_type", F.to_date("ts").alias("dia")).agg(
        F.count(F.lit(1)).alias("n_eventos"), F.bround(F.sum("value"), 6).alias("valor_total"),
        (F.bround(F.sum("value"), 6) / F.count(F.lit(1))).alias("valor_medio"), F.count_distinct("user_id").alias("usuarios"))


@query("isolation_forest", FOREST_SQL + """,
limits AS (SELECT g, quantile_cont(score, 0.10) AS threshold FROM scored GROUP BY g)
SELECT event_type, dia, n_eventos, valor_total, valor_medio, usuarios, round_even(score - threshold, 9) AS if_score, score - threshold < 0 AS anomalia_if
FROM daily JOIN scored ON g = event_type AND rid = CAST(dia AS VARCHAR) JOIN limits USING (g)
""")
def isolation_forest_q(spark, sf_dir):
    """A forest per event type over the daily features (ANO1): boxes, scores,
    threshold and flag."""
    daily = checkpoint_parquet(daily_features(spark, sf_dir), "daily-features")
    out = isolation_forest(daily, ["event_type"], IF_FEATURES, "dia", n_trees=100, max_samples=256, contamination=0.10, seed=42)
    return out.withColumn("if_score", F.bround("if_score", 9))


@query("forest_model", FOREST_SQL + """
SELECT g AS event_type, CAST(tree AS INTEGER) AS tree, psi, depth, size, round_even(path, 9) AS path,
       round_even(lo0, 6) AS lo_0, round_even(lo1, 6) AS lo_1, round_even(lo2, 6) AS lo_2, round_even(lo3, 6) AS lo_3,
       round_even(hi0, 6) AS hi_0, round_even(hi1, 6) AS hi_1, round_even(hi2, 6) AS hi_2, round_even(hi3, 6) AS hi_3 FROM boxes
""")
def forest_model(spark, sf_dir):
    """The boxes of that forest, one row a leaf."""
    boxes = forest_boxes(daily_features(spark, sf_dir), ["event_type"], IF_FEATURES, "dia", n_trees=100, max_samples=256, seed=42)
    return boxes.withColumns({c: F.bround(c, 9 if c == "path" else 6) for c in boxes.columns if c == "path" or c[:3] in ("lo_", "hi_")})


@query("outbreak_join", LABELS_SQL + """,
v AS (SELECT CAST(ts AS DATE) AS dia, event_type, round_even(sum(value), 6) AS valor_total FROM events GROUP BY 1, 2)
SELECT lab.event_type, lab.dia, lab.n_eventos, v.valor_total FROM lab JOIN v USING (event_type, dia)
WHERE lab.brote = 1
""")
def outbreak_join(spark, sf_dir):
    """Outbreak days joined to another daily series (JN4): inner join on the
    flagged (type, day) rows only."""
    lab = _labels(spark, sf_dir).where("brote = 1").select("event_type", "dia", "n_eventos")
    ev = Tables(spark, sf_dir).events
    v = ev.groupBy("event_type", F.to_date("ts").alias("dia")).agg(F.bround(F.sum("value"), 6).alias("valor_total"))
    return lab.join(v, ["event_type", "dia"], "inner")
