"""Registered queries: pivots, panels, weekly bulletin series, lags (AGG11, JN1,
TRF2-5, WIN1-5, TS1-3)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sentinela.functions.calendar import in_calendar_window
from sentinela.operators import bulletin as B
from sentinela.operators.joins import bounded_distinct
from sentinela.operators.lagcorr import best_lag, lag_correlations, lag_pvalues, ols_at_lag
from sentinela.operators.pivot import pivot_metrics, slug
from sentinela.operators.windows import group_totals, lag_features, new_from_cumulative
from sentinela.plans.bindings import MONTHLY_QUANTITY_SQL, monthly_quantity
from sentinela.plans.queries_counts import CASE_COUNTS_SQL, monthly_counts
from sentinela.plans.registry import query
from sentinela.sources.testdata import Tables

# TPC-H order priorities, used only to spell the oracle's pivot columns.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PANEL_METRICS = ["casos_confirmados", "total_registros", "tasa_confirmacion"]
LAGS = list(range(0, 7))
EVENT_YEAR, EVENT_MONTHS = 2001, [6, 7]


# ------------------------------------------------------------------ panel

def _panel(spark, sf_dir):
    counts = monthly_counts(spark, sf_dir)
    values = bounded_distinct(counts, "entidad", 1000)
    wide = pivot_metrics(counts.withColumnRenamed("anio_mes_dt", "fecha"), ["fecha"], "entidad", PANEL_METRICS, values)
    qty = monthly_quantity(Tables(spark, sf_dir))
    return (wide.join(qty, "fecha", "left")
            .withColumns({"mes_num": F.month("fecha"),
                          "es_ventana": in_calendar_window("fecha", EVENT_YEAR, EVENT_MONTHS)}))


def _panel_sql():
    cols = ",\n  ".join(f"first({m}) FILTER (WHERE entidad = '{p}') AS {m}_{slug(p)}"
                        for p in PRIORITIES for m in PANEL_METRICS)
    return f"""
WITH c AS ({CASE_COUNTS_SQL}),
w AS (SELECT anio_mes_dt AS fecha,
  {cols}
  FROM c GROUP BY 1),
q AS ({MONTHLY_QUANTITY_SQL})
SELECT w.*, q.pasajeros, CAST(month(w.fecha) AS INTEGER) AS mes_num,
       CAST(year(w.fecha) = {EVENT_YEAR} AND month(w.fecha) IN ({', '.join(map(str, EVENT_MONTHS))}) AS INTEGER) AS es_ventana
FROM w LEFT JOIN q ON w.fecha = q.fecha
"""


@query("panel_wide", _panel_sql())
def panel_wide(spark, sf_dir):
    return _panel(spark, sf_dir)


# ------------------------------------------------- weekly bulletin binding

def weekly_bulletin(spark, sf_dir):
    """lineitem as weekly bulletin rows (ISO year and week): disease = return flag, state = supplier
    region, sex = line status; cumulative counts are running sums within the
    year (with corrections that can go down)."""
    t = Tables(spark, sf_dir)
    # Dimension joins carry no hint: the planner broadcasts them from file
    # statistics and AQE re-plans from the real shuffle sizes, both behind
    # the broadcast threshold (a checked bound), else a shuffle join.
    geo = (t.supplier.select("s_suppkey", "s_nationkey")
           .join(t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
           .join(t.region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("s_suppkey", F.col("r_name").alias("entidad_federativa")))
    li = t.lineitem.join(geo, F.col("l_suppkey") == F.col("s_suppkey"))
    wk = li.groupBy(F.extract(F.lit("YEAROFWEEK"), F.col("l_shipdate")).cast("int").alias("anio"), F.weekofyear("l_shipdate").alias("semana"),
                    "entidad_federativa", F.col("l_returnflag").alias("enfermedad"),
                    F.col("l_linestatus").alias("sexo")).agg(
        F.count(F.lit(1)).alias("casos_semana"),
        F.sum(F.when(F.col("l_tax") < 0.04, 1).when(F.col("l_tax") >= 0.06, -1).otherwise(0)).alias("_delta"))
    w = (Window.partitionBy("enfermedad", "entidad_federativa", "sexo", "anio").orderBy("semana")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return wk.select("anio", "semana", "entidad_federativa", "enfermedad", "sexo", "casos_semana",
                     F.sum("_delta").over(w).cast("bigint").alias("casos_acumulado"),
                     F.sum("casos_semana").over(w).cast("bigint").alias("casos_acum_anterior"))


WEEKLY_SQL = """
SELECT anio, semana, entidad_federativa, enfermedad, sexo, casos_semana,
       CAST(sum(_delta) OVER w AS BIGINT) AS casos_acumulado,
       CAST(sum(casos_semana) OVER w AS BIGINT) AS casos_acum_anterior
FROM (
  SELECT CAST(isoyear(l.l_shipdate) AS INTEGER) AS anio, CAST(weekofyear(l.l_shipdate) AS INTEGER) AS semana,
         r.r_name AS entidad_federativa,
         l.l_returnflag AS enfermedad, l.l_linestatus AS sexo, CAST(count(*) AS BIGINT) AS casos_semana,
         sum(CASE WHEN l.l_tax < 0.04 THEN 1 WHEN l.l_tax >= 0.06 THEN -1 ELSE 0 END) AS _delta
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL)
WINDOW w AS (PARTITION BY enfermedad, entidad_federativa, sexo, anio ORDER BY semana
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

NEW_CASES_SQL = f"""
WITH wk AS ({WEEKLY_SQL})
SELECT anio, semana, entidad_federativa, enfermedad, sexo, casos_semana, casos_acumulado,
  CAST(greatest(CASE WHEN lag(casos_acumulado) OVER s IS NULL THEN round_even(casos_semana / 2.0, 0)
                     ELSE casos_acumulado - lag(casos_acumulado) OVER s END, 0) AS BIGINT) AS casos_nuevos
FROM wk
WINDOW s AS (PARTITION BY enfermedad, entidad_federativa, sexo, anio ORDER BY semana)
"""


@query("new_from_cumulative", NEW_CASES_SQL)
def new_from_cumulative_q(spark, sf_dir):
    wk = weekly_bulletin(spark, sf_dir).drop("casos_acum_anterior")
    return new_from_cumulative(wk, ["enfermedad", "entidad_federativa", "sexo", "anio"], "semana",
                               "casos_acumulado", "casos_semana", "half")


BOTH_SQL = f"""
WITH wk AS ({WEEKLY_SQL}),
t AS (
  SELECT *, CAST(sum(casos_acumulado) OVER c AS BIGINT) AS casos_ambos_sexos,
         CAST(sum(casos_semana) OVER c AS BIGINT) AS casos_sem_total,
         CAST(sum(casos_acum_anterior) OVER c AS BIGINT) AS casos_ant_total
  FROM wk WINDOW c AS (PARTITION BY anio, semana, entidad_federativa, enfermedad))
SELECT *, CASE WHEN casos_ant_total > 0 THEN CAST(casos_ambos_sexos AS DOUBLE) / casos_ant_total END AS tasa_crecimiento,
       casos_ambos_sexos - casos_ant_total AS incr_semanal
FROM t
"""


@query("both_groups_total", BOTH_SQL)
def both_groups_total(spark, sf_dir):
    wk = weekly_bulletin(spark, sf_dir)
    out = group_totals(wk, ["anio", "semana", "entidad_federativa", "enfermedad"],
                       {"casos_acumulado": "casos_ambos_sexos", "casos_semana": "casos_sem_total",
                        "casos_acum_anterior": "casos_ant_total"})
    return out.withColumns({
        "tasa_crecimiento": F.when(F.col("casos_ant_total") > 0,
                                   F.col("casos_ambos_sexos").cast("double") / F.col("casos_ant_total")),
        "incr_semanal": F.col("casos_ambos_sexos") - F.col("casos_ant_total")})


def _dims(spark, sf_dir):
    """State catalogue = region names; diseases and sexes = observed values."""
    return Tables(spark, sf_dir).region.select("r_name"), None, None


MIN_YEAR = 1990
DENSE_SQL = f"""
WITH wk AS ({WEEKLY_SQL}),
y AS (SELECT DISTINCT anio FROM wk WHERE anio > {MIN_YEAR}),
s AS (SELECT DISTINCT semana FROM wk WHERE semana BETWEEN 1 AND 53),
e AS (SELECT r_name AS entidad_federativa FROM region),
d AS (SELECT DISTINCT l_returnflag AS enfermedad FROM lineitem),
x AS (SELECT DISTINCT l_linestatus AS sexo FROM lineitem)
SELECT y.anio, s.semana, e.entidad_federativa, d.enfermedad, x.sexo,
       coalesce(wk.casos_semana, 0) AS casos_semana, coalesce(wk.casos_acumulado, 0) AS casos_acumulado,
       coalesce(wk.casos_acum_anterior, 0) AS casos_acum_anterior
FROM y CROSS JOIN s CROSS JOIN e CROSS JOIN d CROSS JOIN x
LEFT JOIN wk USING (anio, semana, entidad_federativa, enfermedad, sexo)
"""


@query("densify_zero", DENSE_SQL)
def densify_zero(spark, sf_dir):
    ents, dis, sx = _dims(spark, sf_dir)
    return B.densify(weekly_bulletin(spark, sf_dir), ents, dis, sx, MIN_YEAR)


FACT_SQL = f"""
WITH g AS ({DENSE_SQL}),
t AS (
  SELECT *, sum(casos_acumulado) OVER c AS casos_ambos_sexos, sum(casos_semana) OVER c AS casos_sem_total,
         sum(casos_acum_anterior) OVER c AS casos_ant_total,
         CAST(greatest(CASE WHEN lag(casos_acumulado) OVER s IS NULL THEN round_even(casos_semana / 2.0, 0)
                            ELSE casos_acumulado - lag(casos_acumulado) OVER s END, 0) AS BIGINT) AS casos_nuevos
  FROM g
  WINDOW c AS (PARTITION BY anio, semana, entidad_federativa, enfermedad),
         s AS (PARTITION BY enfermedad, entidad_federativa, sexo, anio ORDER BY semana))
SELECT anio, semana, entidad_federativa, enfermedad, sexo, casos_semana, casos_acumulado, casos_acum_anterior,
  CAST(date_trunc('week', make_date(anio, 1, 4)) AS DATE)
    + CAST(7 * ((CASE WHEN semana = 53 AND weekofyear(make_date(anio, 12, 28)) < 53 THEN 52 ELSE semana END) - 1)
           AS INTEGER) AS fecha_inicio,
  CAST(anio AS VARCHAR) || '-W' || lpad(CAST(semana AS VARCHAR), 2, '0') AS "semana_año",
  CAST(casos_ambos_sexos AS BIGINT) AS casos_ambos_sexos, CAST(casos_sem_total AS BIGINT) AS casos_sem_total,
  CAST(casos_ant_total AS BIGINT) AS casos_ant_total,
  CASE WHEN casos_ant_total > 0 THEN CAST(casos_ambos_sexos AS DOUBLE) / casos_ant_total END AS tasa_crecimiento,
  CAST(casos_ambos_sexos - casos_ant_total AS BIGINT) AS incr_semanal,
  round_even(sin(2 * pi() * semana / 52), 9) AS semana_sin, round_even(cos(2 * pi() * semana / 52), 9) AS semana_cos,
  casos_acumulado > 0 AS es_brote, casos_nuevos,
  CAST(sum(casos_nuevos) OVER c AS BIGINT) AS casos_nuevos_total
FROM t
WINDOW c AS (PARTITION BY anio, semana, entidad_federativa, enfermedad)
"""


@query("bulletin_fact", FACT_SQL)
def bulletin_fact(spark, sf_dir):
    ents, dis, sx = _dims(spark, sf_dir)
    dense = B.densify(weekly_bulletin(spark, sf_dir), ents, dis, sx, MIN_YEAR)
    out = B.finalize(B.derive_columns(dense, "half"))
    return out.withColumns({"semana_sin": F.bround("semana_sin", 9), "semana_cos": F.bround("semana_cos", 9)})


# ------------------------------------------------------------------- lags

LAG_SQL = f"""
WITH c AS ({CASE_COUNTS_SQL})
SELECT entidad, anio_mes_dt, total_registros,
       lag(total_registros, 1) OVER w AS total_registros_lag1,
       lag(total_registros, 4) OVER w AS total_registros_lag4
FROM c WINDOW w AS (PARTITION BY entidad ORDER BY anio_mes_dt)
"""


@query("lag_features", LAG_SQL)
def lag_features_q(spark, sf_dir):
    c = monthly_counts(spark, sf_dir).select("entidad", "anio_mes_dt", "total_registros")
    return lag_features(c, ["entidad"], "anio_mes_dt", ["total_registros"], [1, 4])


def _lag_input(spark, sf_dir):
    c = monthly_counts(spark, sf_dir).select("entidad", F.col("anio_mes_dt").alias("fecha"), "casos_confirmados")
    return c.join(monthly_quantity(Tables(spark, sf_dir)), "fecha", "left")


LAG_INPUT_SQL = f"""
SELECT c.entidad, c.anio_mes_dt AS fecha, c.casos_confirmados, q.pasajeros
FROM ({CASE_COUNTS_SQL}) c LEFT JOIN ({MONTHLY_QUANTITY_SQL}) q ON c.anio_mes_dt = q.fecha
"""

LAG_PAIRS_SQL = f"""
WITH i AS (SELECT * FROM ({LAG_INPUT_SQL}) WHERE pasajeros IS NOT NULL AND casos_confirmados IS NOT NULL),
l AS (SELECT entidad, fecha, CAST(pasajeros AS DOUBLE) AS x, count(*) OVER (PARTITION BY entidad) AS n_puntos,
             {', '.join(f'lead(casos_confirmados, {k}) OVER w AS y{k}' for k in LAGS)}
      FROM i WINDOW w AS (PARTITION BY entidad ORDER BY fecha)),
p AS ({' UNION ALL '.join(f'SELECT entidad, fecha, x, n_puntos, {k} AS lag, CAST(y{k} AS DOUBLE) AS y FROM l WHERE y{k} IS NOT NULL' for k in LAGS)})
"""

CORR_SQL = LAG_PAIRS_SQL + """,
r AS (
  SELECT entidad, lag, count(*) AS n_pares, max(n_puntos) AS n_puntos,
         CASE WHEN count(*) >= 3 AND stddev_pop(x) > 0 AND stddev_pop(y) > 0
              THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END AS r
  FROM p GROUP BY entidad, lag)
"""

BEST_SQL = CORR_SQL + """,
b AS (SELECT entidad, lag, r, row_number() OVER (PARTITION BY entidad ORDER BY abs(r) DESC, lag) AS rn
      FROM r WHERE r IS NOT NULL),
n AS (SELECT entidad, max(n_puntos) AS n_puntos FROM r GROUP BY entidad)
SELECT n.entidad, CASE WHEN n.n_puntos >= 8 AND b.lag IS NOT NULL THEN b.lag ELSE 1 END AS mejor_lag,
       CASE WHEN n.n_puntos >= 8 THEN round_even(b.r, 9) END AS mejor_r, n.n_puntos
FROM n LEFT JOIN (SELECT * FROM b WHERE rn = 1) b ON n.entidad = b.entidad
"""


def _best(spark, sf_dir):
    return best_lag(_lag_input(spark, sf_dir), "entidad", "fecha", "pasajeros", "casos_confirmados", LAGS)


@query("lag_correlation_best", BEST_SQL)
def lag_correlation_best(spark, sf_dir):
    return _best(spark, sf_dir).withColumn("mejor_r", F.bround("mejor_r", 9))


# The Student t tail for whole degrees of freedom, with the products of the series written as gamma functions.
PVALUE_SQL = CORR_SQL + """,
v AS (SELECT *, n_pares - 2 AS df, 1 - r * r AS c2 FROM r),
a AS (SELECT *, CASE
        WHEN r IS NULL OR df < 1 THEN NULL
        WHEN c2 <= 0 THEN 1.0
        WHEN df % 2 = 0 THEN abs(r) * list_sum(list_transform(range(0, df // 2),
             lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1)) * pow(c2, j)))
        WHEN df = 1 THEN 2 / pi() * asin(abs(r))
        ELSE 2 / pi() * (asin(abs(r)) + abs(r) * sqrt(c2) * list_sum(list_transform(range(0, (df - 1) // 2),
             lambda j: exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5)) * pow(c2, j)))) END AS inside FROM v)
SELECT entidad, lag, round_even(r, 9) AS r, n_pares, n_puntos,
       round_even(r * sqrt(CASE WHEN c2 <> 0 THEN df / c2 END), 6) AS t, round_even(1 - inside, 9) AS p_valor, 1 - inside < 0.05 AS significativo
FROM a
"""


@query("lag_pvalue", PVALUE_SQL)
def lag_pvalue(spark, sf_dir):
    corr = lag_correlations(_lag_input(spark, sf_dir), "entidad", "fecha", "pasajeros", "casos_confirmados", LAGS)
    return lag_pvalues(corr).withColumns({"r": F.bround("r", 9), "t": F.bround("t", 6), "p_valor": F.bround("p_valor", 9)})


OLS_SQL = LAG_PAIRS_SQL + """,
r AS (
  SELECT entidad, lag, count(*) AS n_pares, max(n_puntos) AS n_puntos,
         CASE WHEN count(*) >= 3 AND stddev_pop(x) > 0 AND stddev_pop(y) > 0
              THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END AS r
  FROM p GROUP BY entidad, lag),
b AS (SELECT entidad, lag, r, row_number() OVER (PARTITION BY entidad ORDER BY abs(r) DESC, lag) AS rn
      FROM r WHERE r IS NOT NULL),
n AS (SELECT entidad, max(n_puntos) AS n_puntos FROM r GROUP BY entidad),
best AS (SELECT n.entidad, CASE WHEN n.n_puntos >= 8 AND b.lag IS NOT NULL THEN b.lag ELSE 1 END AS mejor_lag
         FROM n LEFT JOIN (SELECT * FROM b WHERE rn = 1) b ON n.entidad = b.entidad)
SELECT p.entidad, p.lag, round_even(regr_slope(y, x), 9) AS pendiente, round_even(regr_intercept(y, x), 6) AS intercepto,
       round_even(CASE WHEN count(*) >= 3 AND stddev_pop(x) > 0 AND stddev_pop(y) > 0
              THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END, 9) AS r, count(*) AS n_pares
FROM p JOIN best ON p.entidad = best.entidad AND p.lag = best.mejor_lag
GROUP BY p.entidad, p.lag
"""


@query("lag_ols", OLS_SQL)
def lag_ols(spark, sf_dir):
    inp = _lag_input(spark, sf_dir)
    best = best_lag(inp, "entidad", "fecha", "pasajeros", "casos_confirmados", LAGS)
    out = ols_at_lag(inp, "entidad", "fecha", "pasajeros", "casos_confirmados", best, LAGS)
    return out.withColumns({"pendiente": F.bround("pendiente", 9), "intercepto": F.bround("intercepto", 6),
                            "r": F.bround("r", 9)})
