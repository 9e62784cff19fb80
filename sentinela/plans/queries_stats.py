"""Registered queries: grouped statistics, trend, percentiles, correlations,
seasonal split, projection, risk scores, imputation, scaling (AGG3-5, AGG16-19,
TS7-8, RSK1-5, CLN9, ANO0)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentinela.functions.calendar import month_start, year_between
from sentinela.operators.risk import (city_mean_score, composite_index, country_risk, scenario_projection,
                                      seasonal_split, seasonal_weights)
from sentinela.operators.scaling import median_impute, standardize
from sentinela.operators.stats import (correlation_pairs, coverage_stats, incidence_stats, percentiles,
                                       trend_slope)
from sentinela.plans.bindings import MONTHLY_QUANTITY_SQL, monthly_quantity
from sentinela.plans.queries_counts import CASE_COUNTS_SQL, monthly_counts
from sentinela.plans.registry import query
from sentinela.sinks.writers import checkpoint_parquet
from sentinela.sources.testdata import Tables

WINDOW_YEARS = (1996, 2000)
SEASON_MONTHS = [6, 7]
GROWTH = 1.35


def _orders_by_nation(t: Tables):
    return t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))


ORDERS_NATION_SQL = "orders o JOIN customer c ON o.o_custkey = c.c_custkey"


# ------------------------------------------------------------------ trend

@query("trend_slope", f"""
WITH y AS (SELECT c.c_nationkey, year(o.o_orderdate) AS anio, sum(o.o_totalprice) AS total
           FROM {ORDERS_NATION_SQL} GROUP BY ALL)
SELECT c_nationkey, round_even(CASE WHEN regr_count(total, anio) >= 3 THEN regr_slope(total, anio) END, 4) AS tendencia
FROM y GROUP BY 1
""")
def trend_slope_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    y = _orders_by_nation(t).groupBy("c_nationkey", F.year("o_orderdate").alias("anio")).agg(
        F.sum("o_totalprice").alias("total"))
    return trend_slope(y, ["c_nationkey"], "total", "anio").withColumn("tendencia", F.bround("tendencia", 4))


# ------------------------------------------------------------ group stats

@query("group_stats", f"""
WITH m AS (SELECT c.c_nationkey, date_trunc('month', o.o_orderdate) AS mes, count(*) AS n
           FROM {ORDERS_NATION_SQL} WHERE year(o.o_orderdate) BETWEEN {WINDOW_YEARS[0]} AND {WINDOW_YEARS[1]}
           GROUP BY ALL),
i AS (SELECT c_nationkey, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_cases, round_even(avg(n), 6) AS avg_monthly_cases,
             count_if(n > 0) AS months_with_cases, max(n) AS peak_month FROM m GROUP BY 1),
v AS (SELECT c_nationkey, round_even(avg(c_acctbal), 6) AS saldo_mean, min(c_acctbal) AS saldo_min,
             round_even(stddev_samp(c_acctbal), 6) AS saldo_std FROM customer GROUP BY 1)
SELECT i.*, v.saldo_mean, v.saldo_min, v.saldo_std FROM i LEFT JOIN v USING (c_nationkey)
""")
def group_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    m = (_orders_by_nation(t).where(year_between("o_orderdate", *WINDOW_YEARS))
         .groupBy("c_nationkey", month_start("o_orderdate").alias("mes")).agg(F.count(F.lit(1)).alias("n")))
    inc = incidence_stats(m, ["c_nationkey"], "n")
    cov = coverage_stats(t.customer, ["c_nationkey"], "c_acctbal", "saldo")
    out = inc.join(cov, "c_nationkey", "left")
    return out.withColumns({c: F.bround(c, 6) for c in ["avg_monthly_cases", "saldo_mean", "saldo_std"]})


# ------------------------------------------------------------ percentiles

@query("baseline_percentiles", f"""
WITH c AS ({CASE_COUNTS_SQL})
SELECT entidad, round_even(quantile_cont(total_registros, 0.75), 6) AS p75,
       round_even(quantile_cont(total_registros, 0.90), 6) AS p90,
       round_even(quantile_cont(total_registros, 0.95), 6) AS p95
FROM c GROUP BY 1
""")
def baseline_percentiles(spark, sf_dir):
    c = monthly_counts(spark, sf_dir)
    p = percentiles(c, ["entidad"], "total_registros", [0.75, 0.90, 0.95])
    return p.withColumns({k: F.bround(k, 6) for k in ["p75", "p90", "p95"]})


# ------------------------------------------------------------ correlation

CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_pairs_sql():
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            r = (f"CASE WHEN count(*) >= 2 AND stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 "
                 f"THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END")
            parts.append(f"SELECT '{a}' AS var_1, '{b}' AS var_2, {r} AS r FROM lineitem "
                         f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    return ("SELECT var_1, var_2, round_even(r, 9) AS r, round_even(abs(r), 9) AS abs_r, abs(r) > 0.7 AS strong FROM ("
            + " UNION ALL ".join(parts) + ")")


@query("corr_pairs", _corr_pairs_sql())
def corr_pairs(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    out = correlation_pairs(li, CORR_COLS, 0.7)
    return out.withColumns({"r": F.bround("r", 9), "abs_r": F.bround("abs_r", 9)})


# ------------------------------------------------- seasonal split, projection

@query("seasonal_split", f"""
WITH q AS ({MONTHLY_QUANTITY_SQL}),
m AS (SELECT month(fecha) AS mes_num, avg(pasajeros) AS a FROM q GROUP BY 1),
w AS (SELECT mes_num, a / sum(a) OVER () AS peso FROM m),
y AS (SELECT year(o_orderdate) AS anio, count(*) AS n FROM orders GROUP BY 1)
SELECT make_date(CAST(y.anio AS INTEGER), CAST(w.mes_num AS INTEGER), 1) AS fecha,
       CAST(round_even(y.n * w.peso, 0) AS BIGINT) AS valor_mensual
FROM y CROSS JOIN w
""")
def seasonal_split_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    weights = seasonal_weights(monthly_quantity(t), "fecha", "pasajeros")
    annual = t.orders.groupBy(F.year("o_orderdate").alias("anio")).agg(F.count(F.lit(1)).alias("n"))
    return seasonal_split(annual, "anio", "n", weights)


@query("scenario_projection", f"""
WITH q AS ({MONTHLY_QUANTITY_SQL})
SELECT round_even(avg(pasajeros), 4) AS base_mensual, CAST({GROWTH} AS DOUBLE) AS factor,
       round_even(avg(pasajeros) * {GROWTH}, 4) AS proyectado
FROM q WHERE month(fecha) IN ({', '.join(map(str, SEASON_MONTHS))})
  AND year(fecha) BETWEEN {WINDOW_YEARS[0]} AND {WINDOW_YEARS[1]}
""")
def scenario_projection_q(spark, sf_dir):
    q = monthly_quantity(Tables(spark, sf_dir))
    out = scenario_projection(q, "fecha", "pasajeros", SEASON_MONTHS, WINDOW_YEARS, GROWTH)
    return out.withColumns({"base_mensual": F.bround("base_mensual", 4), "proyectado": F.bround("proyectado", 4)})


# ------------------------------------------------------------- risk scores

def _nation_months(spark, sf_dir):
    """Orders per nation and month, from one pass over the orders; what comes
    after reads this small written table."""
    return checkpoint_parquet(_orders_by_nation(Tables(spark, sf_dir)).groupBy(
        F.col("c_nationkey").alias("n_nationkey"), month_start("o_orderdate").alias("mes")).agg(F.count(F.lit(1)).alias("n")), "nation-months")


def _nation_coverage(spark, sf_dir):
    return Tables(spark, sf_dir).customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        (F.avg((F.col("c_acctbal") > 0).cast("double")) * 100).alias("cobertura"))


def _nation_risk(spark, sf_dir, months=None):
    months = months if months is not None else _nation_months(spark, sf_dir)
    cases = months.groupBy("n_nationkey").agg(F.sum("n").alias("total_cases"))
    base = checkpoint_parquet(cases.join(_nation_coverage(spark, sf_dir), "n_nationkey", "left"), "nation-risk")
    return country_risk(base, "total_cases", "cobertura")


NATION_RISK_SQL = f"""
WITH k AS (SELECT c.c_nationkey AS n_nationkey, count(*) AS total_cases FROM {ORDERS_NATION_SQL} GROUP BY 1),
v AS (SELECT c_nationkey AS n_nationkey, avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) * 100 AS cobertura
      FROM customer GROUP BY 1),
s AS (SELECT k.n_nationkey, k.total_cases, v.cobertura,
             ln(1 + CAST(k.total_cases AS DOUBLE)) * (100.0 - v.cobertura) / 100.0 AS score_riesgo
      FROM k LEFT JOIN v USING (n_nationkey)),
mm AS (SELECT min(score_riesgo) AS lo, max(score_riesgo) AS hi FROM s),
r AS (SELECT s.*, CASE WHEN hi > lo THEN round_even((score_riesgo - lo) / (hi - lo) * 10.0, 2)
                       WHEN score_riesgo IS NOT NULL THEN 0.0 END AS score_riesgo_norm
      FROM s CROSS JOIN mm)
"""


@query("risk_score_minmax", NATION_RISK_SQL + """
SELECT n_nationkey, total_cases, round_even(cobertura, 6) AS cobertura, round_even(score_riesgo, 6) AS score_riesgo,
       score_riesgo_norm FROM r
""")
def risk_score_minmax(spark, sf_dir):
    out = _nation_risk(spark, sf_dir)
    return out.withColumns({"cobertura": F.bround("cobertura", 6), "score_riesgo": F.bround("score_riesgo", 6)})


@query("composite_index", NATION_RISK_SQL + f""",
cities AS (SELECT n.n_regionkey, count(*) AS partidos FROM nation n GROUP BY 1),
sc AS (SELECT n.n_regionkey, avg(r.score_riesgo_norm) AS m FROM r JOIN nation n USING (n_nationkey) GROUP BY 1),
g AS (SELECT avg(score_riesgo_norm) AS g FROM r),
mo AS (SELECT n.n_regionkey, date_trunc('month', o.o_orderdate) AS mes, count(*) AS n
       FROM {ORDERS_NATION_SQL} JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY ALL),
bl AS (SELECT n_regionkey, round_even(avg(n), 1) AS baseline FROM mo
       WHERE month(mes) IN ({', '.join(map(str, SEASON_MONTHS))}) AND year(mes) BETWEEN 1998 AND 2000 GROUP BY 1),
base AS (SELECT cities.n_regionkey, cities.partidos, coalesce(sc.m, g.g) AS score_equipos, bl.baseline
         FROM cities LEFT JOIN sc USING (n_regionkey) CROSS JOIN g LEFT JOIN bl USING (n_regionkey)),
ix AS (SELECT *, partidos * 0.30 + score_equipos * 0.40 + baseline * 0.30 AS indice_riesgo FROM base),
ixm AS (SELECT min(indice_riesgo) AS lo, max(indice_riesgo) AS hi, max(partidos) AS mp, max(score_equipos) AS ms,
               max(baseline) AS mb FROM ix)
SELECT n_regionkey, partidos, round_even(score_equipos, 6) AS score_equipos, baseline,
       round_even(indice_riesgo, 6) AS indice_riesgo,
       CASE WHEN hi > lo THEN round_even((indice_riesgo - lo) / (hi - lo) * 10.0, 2)
            WHEN indice_riesgo IS NOT NULL THEN 0.0 END AS indice_riesgo_norm,
       round_even(partidos / nullif(mp, 0) * 10.0, 6) AS partidos_rel,
       round_even(score_equipos / nullif(ms, 0) * 10.0, 6) AS score_equipos_rel,
       round_even(baseline / nullif(mb, 0) * 10.0, 6) AS baseline_rel
FROM ix CROSS JOIN ixm
""")
def composite_index_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nation = t.nation.select("n_nationkey", "n_regionkey")
    months = _nation_months(spark, sf_dir)
    scores = checkpoint_parquet(_nation_risk(spark, sf_dir, months), "nation-scores").join(nation, "n_nationkey")
    cities = nation.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("partidos"))
    with_score = city_mean_score(scores, cities, "n_regionkey", "score_riesgo_norm")
    mo = months.join(nation, "n_nationkey").groupBy("n_regionkey", "mes").agg(F.sum("n").alias("n"))
    bl = (mo.where(F.month("mes").isin(SEASON_MONTHS) & F.year("mes").between(1998, 2000))
          .groupBy("n_regionkey").agg(F.bround(F.avg("n"), 1).alias("baseline")))
    base = checkpoint_parquet(with_score.join(bl, "n_regionkey", "left"), "city-base")  # one row per city
    out = composite_index(base, "partidos", "score_equipos", "baseline")
    return out.withColumns({c: F.bround(c, 6) for c in ["score_equipos", "indice_riesgo", "partidos_rel",
                                                         "score_equipos_rel", "baseline_rel"]})


# ----------------------------------------------------- imputation, scaling

@query("median_impute", """
WITH h AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer)
SELECT c_custkey, coalesce(c_acctbal, (SELECT median(c_acctbal) FROM h)) AS c_acctbal FROM h
""")
def median_impute_q(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    return median_impute(c, ["c_acctbal"])


@query("zscore_group", """
SELECT event_id, event_type,
       round_even((value - avg(value) OVER g) / CASE WHEN stddev_pop(value) OVER g > 0 THEN stddev_pop(value) OVER g
                                                     ELSE 1.0 END, 9) AS value_z
FROM events WINDOW g AS (PARTITION BY event_type)
""")
def zscore_group(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "event_type", "value")
    out = standardize(ev, ["value"], ["event_type"])
    return out.select("event_id", "event_type", F.bround("value_z", 9).alias("value_z"))


# ---------------------------------------------------------------- ranking, range

@query("risk_ranking", NATION_RISK_SQL + """
SELECT r.n_nationkey, n.n_name, r.score_riesgo_norm FROM r JOIN nation n USING (n_nationkey)
ORDER BY r.score_riesgo_norm DESC, n.n_name LIMIT 10
""")
def risk_ranking(spark, sf_dir):
    """Top-10 nations by normalised risk score, ties by name (RSK6, SRT2):
    the limit is the feature; it plans as TakeOrderedAndProject."""
    from sentinela.operators.risk import ranked
    t = Tables(spark, sf_dir)
    r = _nation_risk(spark, sf_dir).join(t.nation.select("n_nationkey", "n_name"), "n_nationkey")
    return ranked(r.select("n_nationkey", "n_name", "score_riesgo_norm"), "score_riesgo_norm", 10, "n_name")


@query("range_summary", """
SELECT min(o_totalprice) AS minimo, max(o_totalprice) AS maximo, count(o_totalprice) AS n,
       count(DISTINCT o_totalprice) AS n_distintos FROM orders
""")
def range_summary_q(spark, sf_dir):
    from sentinela.operators.stats import range_summary
    return range_summary(Tables(spark, sf_dir).orders, "o_totalprice")


@query("zscore_check", """
WITH z AS (SELECT event_type, (value - avg(value) OVER g) /
                  CASE WHEN stddev_pop(value) OVER g > 0 THEN stddev_pop(value) OVER g ELSE 1.0 END AS value_z
           FROM events WINDOW g AS (PARTITION BY event_type))
SELECT event_type, round_even(avg(value_z), 6) + 0.0 AS media, round_even(stddev_pop(value_z), 6) AS std,
       count_if(value_z IS NULL) AS nulos,
       abs(avg(value_z)) <= 1e-6 AND abs(stddev_pop(value_z) - 1) <= 1e-6 AND count_if(value_z IS NULL) = 0 AS ok
FROM z GROUP BY 1
""")
def zscore_check(spark, sf_dir):
    """Per-group standardisation check: mean ~ 0, std ~ 1, no NULLs (DQ5)."""
    ev = Tables(spark, sf_dir).events.select("event_type", "value")
    z = standardize(ev, ["value"], ["event_type"])
    out = z.groupBy("event_type").agg(F.avg("value_z").alias("m"), F.stddev_pop("value_z").alias("s"),
                                      F.count_if(F.col("value_z").isNull()).alias("nulos"))
    ok = (F.abs("m") <= 1e-6) & (F.abs(F.col("s") - 1) <= 1e-6) & (F.col("nulos") == 0)
    return out.select("event_type", (F.bround("m", 6) + F.lit(0.0)).alias("media"), F.bround("s", 6).alias("std"),
                      "nulos", ok.alias("ok"))


@query("city_team_features", NATION_RISK_SQL + """
SELECT n.n_regionkey, round_even(avg(r.cobertura), 6) AS cobertura_media_equipos,
       round_even(avg(r.score_riesgo_norm), 6) AS score_riesgo_norm_media_equipos
FROM r JOIN nation n USING (n_nationkey) GROUP BY 1
""")
def city_team_features_q(spark, sf_dir):
    """Mean features of the teams (nations) of each host city (region) (TS11)."""
    from sentinela.operators.risk import city_team_features
    t = Tables(spark, sf_dir)
    feats = _nation_risk(spark, sf_dir).withColumnRenamed("n_nationkey", "Country")
    team_city = t.nation.select(F.col("n_nationkey").alias("Country"), "n_regionkey")
    out = city_team_features(feats, team_city, "n_regionkey", ["cobertura", "score_riesgo_norm"])
    return out.select("n_regionkey", *[F.bround(c, 6).alias(c) for c in out.columns if c != "n_regionkey"])


# Coverage bands (target 95 %, acceptable from 90 %).
COVERAGE_BANDS = [(95.0, "meta"), (90.0, "aceptable")]


@query("coverage_bands", NATION_RISK_SQL + """
SELECT n_nationkey, round_even(cobertura, 6) AS cobertura,
       CASE WHEN cobertura IS NULL THEN NULL WHEN cobertura >= 95.0 THEN 'meta'
            WHEN cobertura >= 90.0 THEN 'aceptable' ELSE 'bajo' END AS banda
FROM r
""")
def coverage_bands(spark, sf_dir):
    """Coverage threshold bands of the nations that have orders (SCL15)."""
    from sentinela.functions.numeric import band_label
    t = Tables(spark, sf_dir)
    ordering = _orders_by_nation(t).select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    r = _nation_coverage(spark, sf_dir).join(ordering, "n_nationkey", "left_semi")
    return r.select("n_nationkey", F.bround("cobertura", 6).alias("cobertura"),
                    band_label("cobertura", COVERAGE_BANDS, "bajo").alias("banda"))
