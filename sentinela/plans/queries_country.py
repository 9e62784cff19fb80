"""Registered query: the country table end to end over the given tables (FTR1-4,
JN2, CLN9, RSK1-2).

Nations stand for countries. Teams of every third nation have a name of their own,
which the attendance rows use while the history rows use the nation's: both
meet through the alias table. One team has no rows anywhere, some nations no
coverage: their gaps are filled with medians."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentinela.plans.entries import country_features
from sentinela.plans.queries_sets import MATCHES_SQL, PLACEHOLDER_REGION, _matches
from sentinela.plans.registry import query
from sentinela.sources.testdata import Tables

MISSING_TEAM = "ATLANTIS"
CASE_YEARS, VACCINE_YEARS = (1993, 1996), (1992, 1997)
ATTENDANCE_PRICE, HISTORY_BELOW = 300_000, 2_000

NUMBERS = ["asistencia_promedio", "total_cases", "avg_monthly_cases", "months_with_cases", "mcv1_mean", "mcv1_min", "mcv1_tendencia"]
_FILLED = ["partidos_en_mexico", "partidos_historicos", *NUMBERS]


def _sql() -> str:
    medians = ", ".join(f"coalesce({c}, quantile_cont({c}, 0.5) OVER ()) AS {c}" for c in _FILLED)
    return "WITH " + MATCHES_SQL + f""",
names AS (SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 3 = 0 THEN replace(n_name, 'NATION', 'TEAM') ELSE n_name END AS team FROM nation),
alias AS (SELECT team AS "Country", n_name AS "Country_who" FROM names JOIN nation USING (n_nationkey, n_name) JOIN region ON n_regionkey = r_regionkey
          WHERE r_name <> '{PLACEHOLDER_REGION}' UNION ALL SELECT '{MISSING_TEAM}', '{MISSING_TEAM}'),
o AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY partidos DESC, ciudad) AS rn, sum(partidos) OVER (PARTITION BY team) AS total FROM pc),
city AS (SELECT team AS who, ciudad AS ciudad_sede, CAST(total AS DOUBLE) AS partidos_en_mexico FROM o WHERE rn = 1),
c AS (SELECT o_orderkey, o_orderdate, o_totalprice, n_name AS who, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT l_orderkey, l_quantity, n_name AS who FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
att AS (SELECT who, avg(l_quantity) AS asistencia_promedio FROM (
          SELECT c.who, l_quantity FROM c JOIN s ON l_orderkey = o_orderkey WHERE o_totalprice > {ATTENDANCE_PRICE}
          UNION ALL SELECT s.who, l_quantity FROM c JOIN s ON l_orderkey = o_orderkey WHERE o_totalprice > {ATTENDANCE_PRICE}) GROUP BY 1),
hist AS (SELECT who, CAST(count(*) AS DOUBLE) AS partidos_historicos FROM (
          SELECT c.who FROM c JOIN s ON l_orderkey = o_orderkey WHERE o_orderkey < {HISTORY_BELOW}
          UNION ALL SELECT s.who FROM c JOIN s ON l_orderkey = o_orderkey WHERE o_orderkey < {HISTORY_BELOW}) GROUP BY 1),
meas AS (SELECT who, CAST(sum(n) AS DOUBLE) AS total_cases, avg(n) AS avg_monthly_cases, CAST(count(*) AS DOUBLE) AS months_with_cases
         FROM (SELECT who, date_trunc('month', o_orderdate) AS mes, count(*) AS n FROM c WHERE year(o_orderdate) BETWEEN {CASE_YEARS[0]} AND {CASE_YEARS[1]} GROUP BY 1, 2) GROUP BY 1),
y AS (SELECT who, year(o_orderdate) AS anio, avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) * 100 AS cov FROM c
      WHERE year(o_orderdate) BETWEEN {VACCINE_YEARS[0]} AND {VACCINE_YEARS[1]} AND CAST(split_part(who, '_', 2) AS INTEGER) % 7 <> 0 GROUP BY 1, 2),
cov AS (SELECT who, avg(cov) AS mcv1_mean, min(cov) AS mcv1_min, CASE WHEN count(*) >= 3 THEN regr_slope(cov, anio) END AS mcv1_tendencia FROM y GROUP BY 1),
t AS (SELECT "Country", "Country_who", ciudad_sede, {medians}
      FROM alias LEFT JOIN city ON city.who = "Country_who" LEFT JOIN att ON att.who = "Country_who" LEFT JOIN hist ON hist.who = "Country_who"
      LEFT JOIN meas ON meas.who = "Country_who" LEFT JOIN cov ON cov.who = "Country_who"),
r AS (SELECT *, ln(1 + total_cases) * (100 - mcv1_mean) / 100 AS score FROM t)
SELECT "Country", "Country_who", ciudad_sede, CAST(trunc(partidos_en_mexico) AS INTEGER) AS partidos_en_mexico, CAST(trunc(partidos_historicos) AS INTEGER) AS partidos_historicos,
       1 AS clasificado_2026, {", ".join(f"round_even({c}, 6) AS {c}" for c in NUMBERS)},
       round_even(CASE WHEN max(score) OVER () > min(score) OVER () THEN (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) * 10 ELSE 0.0 END, 2) AS score_riesgo_norm
FROM r
"""


@query("country_table", _sql())
def country_table(spark, sf_dir):
    t = Tables(spark, sf_dir)
    own = lambda c: F.when(F.col("n_nationkey") % 3 == 0, F.replace(c, F.lit("NATION"), F.lit("TEAM"))).otherwise(c)
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    names = nations.select(F.col("n_name").alias("_who"), own(F.col("n_name")).alias("_team"))
    alias = nations.where(F.col("r_name") != PLACEHOLDER_REGION).select(own(F.col("n_name")).alias("Country"), F.col("n_name").alias("Country_who"))
    alias = alias.unionByName(spark.createDataFrame([(MISSING_TEAM, MISSING_TEAM)], alias.schema))

    def team_name(df, col):
        return df.join(names, F.col(col) == F.col("_who")).withColumn(col, F.col("_team")).drop("_who", "_team")

    fixtures = team_name(team_name(_matches(t), "home"), "away")
    placeholders = nations.where(F.col("r_name") == PLACEHOLDER_REGION).select(own(F.col("n_name")).alias("Country"))
    home = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "o_orderkey", "o_orderdate", "o_totalprice", "c_acctbal", F.col("n_name").alias("Home"))
    away = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "l_orderkey", F.col("l_quantity").alias("Attendance"), F.col("n_name").alias("Away"))
    games = home.join(away, F.col("o_orderkey") == F.col("l_orderkey"))
    attendance = team_name(team_name(games.where(F.col("o_totalprice") > ATTENDANCE_PRICE), "Home"), "Away")
    history = games.where(F.col("o_orderkey") < HISTORY_BELOW).select(F.col("Home").alias("home_team"), F.col("Away").alias("away_team"))
    measles = home.groupBy(F.col("Home").alias("Country"), F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("Month")).agg(
        F.count(F.lit(1)).alias("measles_total"))
    vax = home.where(F.split("Home", "_")[1].cast("int") % 7 != 0).groupBy(F.col("Home").alias("Country"), F.year("o_orderdate").alias("Year")).agg(
        (F.avg((F.col("c_acctbal") > 0).cast("double")) * 100).alias("mcv1"))
    out = country_features(measles, vax, attendance, history, fixtures, alias, placeholders, CASE_YEARS, VACCINE_YEARS)
    return out.withColumns({c: F.bround(c, 6) for c in NUMBERS})
