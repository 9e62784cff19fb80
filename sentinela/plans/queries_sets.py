"""Registered queries: unpivot, exclusion, main group, dedupe, longest prefix
(SET2-5, AGG6, WIN7, JN8, FTR1)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sentinela.operators.joins import longest_prefix as join_longest_prefix
from sentinela.operators.joins import (dedupe_first, duplicate_count, exclude_values,
                                       top_per_group, unpivot_sides)
from sentinela.plans.registry import query
from sentinela.sources.testdata import Tables

# Binding: teams of this region stand for the placeholder teams (SET3).
PLACEHOLDER_REGION = "MIDDLE EAST"


def _matches(t: Tables):
    """Each line item is a match: home = customer nation, away = supplier
    nation, city = order priority."""
    nat = t.nation.select("n_nationkey", "n_name")
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("ciudad"))
    c = t.customer.select("c_custkey", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    m = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(nat.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home")), "c_nationkey")
         .join(nat.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("away")), "s_nationkey"))
    return m.select("ciudad", "home", "away")


MATCHES_SQL = f"""
m AS (SELECT o.o_orderpriority AS ciudad, hn.n_name AS home, an.n_name AS away
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN nation hn ON c.c_nationkey = hn.n_nationkey JOIN nation an ON s.s_nationkey = an.n_nationkey),
u AS (SELECT ciudad, home AS team FROM m UNION ALL SELECT ciudad, away AS team FROM m),
ph AS (SELECT n.n_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
       WHERE r.r_name = '{PLACEHOLDER_REGION}'),
pc AS (SELECT team, ciudad, count(*) AS partidos FROM u WHERE team NOT IN (SELECT n_name FROM ph) GROUP BY 1, 2)
"""


def _team_city(spark, sf_dir):
    t = Tables(spark, sf_dir)
    long = unpivot_sides(_matches(t), ["ciudad"], ["home", "away"], "lado", "team")
    ph = (t.nation.join(t.region.where(F.col("r_name") == PLACEHOLDER_REGION), F.col("n_regionkey") == F.col("r_regionkey"))
          .select("n_name"))
    kept = exclude_values(long, "team", ph)
    return kept.groupBy("team", "ciudad").agg(F.count(F.lit(1)).alias("partidos"))


@query("unpivot_pairs", "WITH " + MATCHES_SQL + "SELECT * FROM pc")
def unpivot_pairs(spark, sf_dir):
    return _team_city(spark, sf_dir)


@query("main_group", "WITH " + MATCHES_SQL + """,
r AS (SELECT team, ciudad, partidos, row_number() OVER (PARTITION BY team ORDER BY partidos DESC, ciudad) AS rn,
             CAST(sum(partidos) OVER (PARTITION BY team) AS BIGINT) AS partidos_total FROM pc)
SELECT team, ciudad AS ciudad_sede, partidos AS partidos_sede, partidos_total FROM r WHERE rn = 1
""")
def main_group(spark, sf_dir):
    """Main host city per team: most matches, ties to the first city name (WIN7, FTR1)."""
    pc = _team_city(spark, sf_dir)
    tot = pc.withColumn("partidos_total", F.sum("partidos").over(Window.partitionBy("team")))
    top = top_per_group(tot, ["team"], [F.col("partidos").desc(), F.col("ciudad").asc()])
    return top.select("team", F.col("ciudad").alias("ciudad_sede"), F.col("partidos").alias("partidos_sede"),
                      "partidos_total")


@query("dedupe_first", """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey) AS rn
  FROM lineitem) WHERE rn = 1
""")
def dedupe_first_q(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity")
    out = dedupe_first(li, ["l_orderkey", "l_partkey"], [F.col("l_linenumber"), F.col("l_suppkey")])
    return out.drop("l_suppkey")


@query("dup_count", """
SELECT count(*) - count(DISTINCT (l_orderkey, l_partkey)) AS n_duplicados FROM lineitem
""")
def dup_count(spark, sf_dir):
    return duplicate_count(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_partkey"])


@query("longest_prefix", """
WITH l AS (SELECT c.c_custkey, n.n_name || ' ' || CAST(c.c_custkey AS VARCHAR) || ' ' || CAST(c.c_nationkey AS VARCHAR) AS linea
           FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
m AS (SELECT l.c_custkey, l.linea, arg_max(n.n_name, length(n.n_name)) AS entidad
      FROM l LEFT JOIN nation n ON starts_with(l.linea, n.n_name) GROUP BY 1, 2)
SELECT c_custkey, entidad, trim(substr(linea, length(entidad) + 1)) AS resto FROM m
""")
def longest_prefix(spark, sf_dir):
    """Lines 'NATION_12 …' are matched to the nation catalogue by longest
    prefix, so NATION_12 is not read as NATION_1 (JN8)."""
    t = Tables(spark, sf_dir)
    lines = t.customer.join(t.nation.select("n_nationkey", "n_name"),
                            F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.concat_ws(" ", "n_name", F.col("c_custkey").cast("string"),
                                 F.col("c_nationkey").cast("string")).alias("linea"))
    return join_longest_prefix(lines, "linea", t.nation, "n_name", ["c_custkey"])
