"""Registered queries: coverage and completeness, pivot max, rule violations,
NULL counts, supervised metrics, partition replace, stored sketches (AGG9-10,
AGG12, AGG20, DQ1-3, SUP1-3, SNK4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentinela.operators.pivot import pivot_fill, slug
from sentinela.operators.quality import violations
from sentinela.operators.stats import distinct_coverage, distinct_sketches, merged_distinct, null_counts
from sentinela.operators.supervised import auc, baseline_scores, binary_metrics, class_weights
from sentinela.plans.queries_counts import CASE_COUNTS_SQL, monthly_counts
from sentinela.plans.queries_series import WEEKLY_SQL, weekly_bulletin
from sentinela.plans.registry import query
from sentinela.session import scratch_path
from sentinela.sinks.snapshots import RuleViolation, read_version, replace_version
from sentinela.sinks.writers import checkpoint_parquet, replace_partitions
from sentinela.sources.testdata import TABLES, Tables

# The event types of the test stream (spell the oracle's pivot columns).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
REQUIRED_TYPES = 5


@query("coverage_report", f"""
SELECT CAST(ts AS DATE) AS dia, count(DISTINCT event_type) AS n_distintos, count(*) AS n_filas,
       count(DISTINCT event_type) < {REQUIRED_TYPES} AS incompleto
FROM events GROUP BY 1
""")
def coverage_report(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.withColumn("dia", F.to_date("ts"))
    return distinct_coverage(ev, ["dia"], "event_type", REQUIRED_TYPES)


@query("incomplete_weeks", f"""
SELECT date_trunc('hour', ts) AS franja, count(DISTINCT event_type) AS n_distintos, count(*) AS n_filas
FROM events GROUP BY 1 HAVING count(DISTINCT event_type) < {REQUIRED_TYPES}
""")
def incomplete_weeks(spark, sf_dir):
    """Time slots (hours here, weeks in the bulletin) missing some required type (AGG10)."""
    ts = F.col("ts")
    # hour floor built from the wall-clock fields: independent of the session time zone
    hour = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
    ev = Tables(spark, sf_dir).events.withColumn("franja", hour)
    cov = distinct_coverage(ev, ["franja"], "event_type", REQUIRED_TYPES)
    return cov.where("incompleto").drop("incompleto")


@query("pivot_max", "SELECT CAST(ts AS DATE) AS dia, "
       + ", ".join(f"coalesce(max(value) FILTER (WHERE event_type = '{t}'), 0) AS value_{slug(t)}" for t in EVENT_TYPES)
       + " FROM events GROUP BY 1")
def pivot_max(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.withColumn("dia", F.to_date("ts"))
    return pivot_fill(ev, ["dia"], "event_type", "value", EVENT_TYPES, "max", 0)


def _rules():
    return {
        "bulletin": {
            "anio_fuera_rango": ~F.col("anio").between(1992, 2027),
            "semana_fuera_rango": ~F.col("semana").between(1, 53),
            "sexo_invalido": ~F.col("sexo").isin("O", "F"),
            "acumulado_negativo": F.col("casos_acumulado") < 0,
        },
        "orders": {
            "estado_invalido": ~F.col("o_orderstatus").isin("F", "O", "P"),
            "precio_no_positivo": F.col("o_totalprice") <= 0,
        },
        "events": {
            "valor_negativo": F.col("value") < 0,
            "tipo_nulo": F.col("event_type").isNull(),
        },
    }


@query("dq_violations", f"""
WITH wk AS ({WEEKLY_SQL})
SELECT 'bulletin' AS tabla, 'anio_fuera_rango' AS regla, count_if(NOT anio BETWEEN 1992 AND 2027) AS n_violaciones FROM wk
UNION ALL SELECT 'bulletin', 'semana_fuera_rango', count_if(NOT semana BETWEEN 1 AND 53) FROM wk
UNION ALL SELECT 'bulletin', 'sexo_invalido', count_if(sexo NOT IN ('O', 'F')) FROM wk
UNION ALL SELECT 'bulletin', 'acumulado_negativo', count_if(casos_acumulado < 0) FROM wk
UNION ALL SELECT 'orders', 'estado_invalido', count_if(o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
UNION ALL SELECT 'orders', 'precio_no_positivo', count_if(o_totalprice <= 0) FROM orders
UNION ALL SELECT 'events', 'valor_negativo', count_if(value < 0) FROM events
UNION ALL SELECT 'events', 'tipo_nulo', count_if(event_type IS NULL) FROM events
""")
def dq_violations(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = _rules()
    parts = [violations(weekly_bulletin(spark, sf_dir), r["bulletin"], "bulletin"),
             violations(t.orders, r["orders"], "orders"), violations(t.events, r["events"], "events")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Column lists of the driver's tables (for the oracle text).
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


@query("null_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS tabla, '{c}' AS columna, count(*) - count({c}) AS n_nulos FROM {t}"
    for t in TABLES for c in TABLE_COLUMNS[t]))
def null_counts_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = None
    for name in TABLES:
        part = null_counts(getattr(t, name), name)
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- supervised

@query("class_weights", """
SELECT toxic, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS peso FROM labels GROUP BY 1
""")
def class_weights_q(spark, sf_dir):
    return class_weights(Tables(spark, sf_dir).labels, "toxic")


@query("binary_metrics", """
WITH c AS (SELECT count_if(toxic = 1 AND quality = 0) AS tp, count_if(toxic = 0 AND quality = 0) AS fp,
                  count_if(toxic = 1 AND quality <> 0) AS fn, count_if(toxic = 0 AND quality <> 0) AS tn FROM labels),
m AS (SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall FROM c)
SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1,
       CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy FROM m
""")
def binary_metrics_q(spark, sf_dir):
    lab = Tables(spark, sf_dir).labels.withColumn("pred", (F.col("quality") == 0).cast("int"))
    return binary_metrics(lab, "toxic", "pred")


@query("auc_score", """
WITH d AS (SELECT CAST(d.n_chars AS DOUBLE) AS s, count_if(l.toxic = 1) AS pos, count_if(l.toxic = 0) AS neg
           FROM labels l JOIN documents d USING (doc_id) GROUP BY 1),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM d)
SELECT round_even(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS auc FROM c
""")
def auc_score(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return auc(j, "toxic", "n_chars").select(F.bround("auc", 9).alias("auc"))


# ---------------------------------------------------------------- sinks

REPLACED_YEAR = 1999


@query("replace_partition", f"""
SELECT *, CAST(year(anio_mes_dt) AS INTEGER) AS anio FROM ({CASE_COUNTS_SQL})
""")
def replace_partition(spark, sf_dir):
    """Write the monthly counts partitioned by year, recompute one year and
    replace just that partition (dynamic overwrite), read the table back."""
    counts = monthly_counts(spark, sf_dir).withColumn("anio", F.year("anio_mes_dt"))
    path = scratch_path(spark, "case_counts_by_year")
    counts.write.mode("overwrite").partitionBy("anio").parquet(path)
    redo = monthly_counts(spark, sf_dir).withColumn("anio", F.year("anio_mes_dt")).where(
        F.col("anio") == REPLACED_YEAR)
    replace_partitions(redo, path, ["anio"])
    return spark.read.parquet(path)


@query("replace_version", f"""
SELECT *, CAST(year(anio_mes_dt) AS INTEGER) AS anio FROM ({CASE_COUNTS_SQL})
""")
def replace_version_q(spark, sf_dir):
    """The same with versions (SNK4): a wrong year is committed, then replaced by
    one commit; a replacement that breaks a rule is not committed."""
    counts = monthly_counts(spark, sf_dir).withColumn("anio", F.year("anio_mes_dt"))
    path = scratch_path(spark, "case_counts_versions")
    year = F.col("anio") == REPLACED_YEAR
    replace_version(counts.withColumn("total_registros", F.when(year, F.col("total_registros") + 1).otherwise(F.col("total_registros"))), path, ["anio"])
    replace_version(counts.where(year), path, ["anio"])
    try:
        replace_version(counts.where(year), path, ["anio"], {"muy_pocos": F.col("total_registros") >= 0}, strict=True)
    except RuleViolation:
        pass  # the version before stays
    return read_version(spark, path, counts.schema)


@query("observed_rules", f"""
WITH wk AS ({WEEKLY_SQL}),
one AS (SELECT count(*) AS n_filas, count_if(NOT anio BETWEEN 1992 AND 2027) AS anio_fuera_rango, count_if(NOT semana BETWEEN 1 AND 53) AS semana_fuera_rango,
               count_if(sexo NOT IN ('O', 'F')) AS sexo_invalido, count_if(casos_acumulado < 0) AS acumulado_negativo FROM wk)
SELECT * FROM (UNPIVOT one ON n_filas, anio_fuera_rango, semana_fuera_rango, sexo_invalido, acumulado_negativo INTO NAME regla VALUE n)
""")
def observed_rules(spark, sf_dir):
    """Rule counts of the weekly fact, taken while it is written (DQ1-3)."""
    path = scratch_path(spark, "weekly-versions")
    _, found = replace_version(weekly_bulletin(spark, sf_dir), path, ["anio"], _rules()["bulletin"])
    return spark.createDataFrame([(k, int(n)) for k, n in found.items()], "regla string, n bigint")  # one row a rule


#: Allowed error of a stored sketch: four standard errors.
SKETCH_ERROR = 4 * 0.83 / 2**6


@query("distinct_sketches", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, count(DISTINCT o_custkey) AS n_clientes, true AS dentro_del_error FROM orders GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT o_custkey), true FROM orders
""")
def distinct_sketches_q(spark, sf_dir):
    """Distinct customers of every year and of all years: exact, and whether the
    estimate from stored daily sketches is within its error (AGG9)."""
    o = Tables(spark, sf_dir).orders
    daily = checkpoint_parquet(distinct_sketches(o, ["o_orderdate"], "o_custkey"), "customer-sketches")
    per_year = merged_distinct(daily.withColumn("anio", F.year("o_orderdate")), ["anio"])
    estimates = per_year.unionByName(merged_distinct(daily).withColumn("anio", F.lit(None).cast("int")))
    exact = o.groupBy(F.year("o_orderdate").alias("anio")).agg(F.count_distinct("o_custkey").alias("n_clientes"))
    exact = exact.unionByName(o.agg(F.count_distinct("o_custkey").alias("n_clientes")).withColumn("anio", F.lit(None).cast("int")))
    both = exact.join(estimates.withColumnRenamed("anio", "_anio"), F.col("anio").eqNullSafe(F.col("_anio")))
    return both.select("anio", "n_clientes", (F.abs(F.col("n_estimado") - F.col("n_clientes")) <= SKETCH_ERROR * F.col("n_clientes")).alias("dentro_del_error"))


BASELINE_FEATURES = ["n_chars", "n_words", "share_upper", "share_blank"]


@query("baseline_classifier")
def baseline_classifier(spark, sf_dir):
    """Metrics of a fitted baseline on its held-out fold (SUP1-3): text statistics
    against the quality label; confusion counts, F1 and exact AUC."""
    t = Tables(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    rows = t.labels.join(t.documents.select("doc_id", "text"), "doc_id").where(F.col("quality").isNotNull()).select(
        "doc_id", "quality", F.length(text).cast("double").alias("n_chars"), F.size(F.split(text, r"\s+")).cast("double").alias("n_words"),
        (F.length(F.regexp_replace(text, "[^A-Z]", "")) / n).alias("share_upper"), (F.length(F.regexp_replace(text, r"[^\s]", "")) / n).alias("share_blank"))
    scored = checkpoint_parquet(baseline_scores(checkpoint_parquet(rows, "baseline-rows"), BASELINE_FEATURES, "quality", "doc_id"), "baseline-scores")
    held = scored.where("held_out")
    return binary_metrics(held, "quality", "predicted").crossJoin(F.broadcast(auc(held, "quality", "score")))  # one row each


@query("weeks_with_data", f"""
WITH wk AS ({WEEKLY_SQL})
SELECT anio, semana, CAST(sum(casos_acumulado) AS BIGINT) AS total, sum(casos_acumulado) > 0 AS con_datos
FROM wk GROUP BY 1, 2
""")
def weeks_with_data(spark, sf_dir):
    """Per (year, week): total cumulative cases and the has-data flag (AGG22)."""
    from sentinela.operators.quality import grouped_flag
    wk = weekly_bulletin(spark, sf_dir).withColumn("_k", F.struct("anio", "semana"))
    return grouped_flag(wk, "_k", "casos_acumulado").select("_k.anio", "_k.semana", "total", "con_datos")


@query("basic_checks", f"""
WITH wk AS ({WEEKLY_SQL})
SELECT count(*) AS n_filas, count_if(casos_semana < 0) AS neg_casos_semana,
       count_if(casos_semana IS NULL) AS null_casos_semana, count_if(casos_acumulado < 0) AS neg_casos_acumulado,
       count_if(casos_acumulado IS NULL) AS null_casos_acumulado FROM wk
""")
def basic_checks_q(spark, sf_dir):
    """Row count, negatives and NULLs of the weekly bulletin measures (DQ3)."""
    from sentinela.operators.quality import basic_checks
    return basic_checks(weekly_bulletin(spark, sf_dir), ["casos_semana", "casos_acumulado"])


@query("round_trip", f"""
SELECT count(*) AS n_filas, true AS iguales FROM ({CASE_COUNTS_SQL})
""")
def round_trip(spark, sf_dir):
    """Write the monthly counts to the shared checkpoint folder, read them back
    and compare count, column names and an order-free content hash (SNK5)."""
    from sentinela.sinks.writers import round_trip_ok
    counts = monthly_counts(spark, sf_dir)
    path = scratch_path(spark, "round_trip")
    counts.write.mode("overwrite").parquet(path)
    ok = round_trip_ok(spark, counts, path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_filas")).withColumn("iguales", F.lit(ok))
