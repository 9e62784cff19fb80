"""Registered queries that write the tables in the formats of the raw files
(yearly CSVs with untidy headers, ';' files with multi-line headers, thousands
separators, Spanish month names) and read them back through the typed readers
(SRC1-5, SRC9, SNK1-2, TS9-10, CLN4-6, SUP1), and of operators on top of them
(AGG14-15, CLU8-9, DQ4, TRF1, TRF6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentinela.functions.calendar import SPANISH_MONTHS
from sentinela.operators import bulletin as B
from sentinela.operators.cluster import cluster_profile, label_clusters, label_comparison
from sentinela.operators.quality import spot_check
from sentinela.operators.supervised import with_weights
from sentinela.plans.entries import correction_pass
from sentinela.plans.queries_series import NEW_CASES_SQL, WEEKLY_SQL, weekly_bulletin
from sentinela.plans.registry import query
from sentinela.session import scratch_path
from sentinela.sinks.writers import save_table, write_csv
from sentinela.sources import surveillance as S
from sentinela.sources.testdata import Tables


@query("csv_linelist", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS anio_fuente, strftime(o_orderdate, '%Y-%m') AS anio_mes,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS "ENTIDAD_RES", count(*) AS n,
       count_if(o_orderstatus = 'F') AS confirmados, CAST(sum(o_orderkey) AS BIGINT) AS claves
FROM orders GROUP BY 1, 2, 3
""")
def csv_linelist(spark, sf_dir):
    """Orders as yearly line-list CSVs: the later years lack a column, and the
    small orders have a pending diagnosis date."""
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate").cast("date")
    rows = o.select(F.year(d).alias("anio"), F.col("o_orderkey").alias("ID_REGISTRO"),
                    F.substring("o_orderpriority", 1, 1).alias("  ENTIDAD_RES"),
                    F.when(F.col("o_orderstatus") == "F", "1").otherwise("3").alias("DIAGNOSTICO "),
                    F.when(F.col("o_totalprice") < 100000.0, "9999-99-99").otherwise(F.date_format(d, "yyyy-MM-dd")).alias("FECHA_DIAGNOSTICO"),
                    F.date_format(F.last_day(d), "yyyy-MM-dd").alias("FECHA_ACTUALIZACION"), F.lit("1").alias("SEXO"))
    root = scratch_path(spark, "linelist")
    years = sorted(r["anio"] for r in rows.select("anio").distinct().collect())  # calendar years
    for half, part in (("old", rows.where(F.col("anio") < 1996)), ("new", rows.where(F.col("anio") >= 1996).drop("SEXO"))):
        part.write.partitionBy("anio").option("header", True).csv(f"{root}/{half}")
    files = {y: f"{'old' if y < 1996 else 'new'}/anio={y}" for y in years}
    return S.load_case_linelist(spark, root, files).groupBy("anio_fuente", "anio_mes", "ENTIDAD_RES").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("DIAGNOSTICO") == 1).alias("confirmados"), F.sum("ID_REGISTRO").alias("claves"))


@query("csv_annual", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS BIGINT) AS pax_nacionales,
       CAST(sum(CASE WHEN l_linestatus <> 'F' THEN l_quantity ELSE 0 END) AS BIGINT) AS pax_internacionales,
       CAST(sum(l_quantity) AS BIGINT) AS pax_total
FROM lineitem GROUP BY 1
""")
def csv_annual(spark, sf_dir):
    """Yearly quantities as a ';' file with '.' thousands separators."""
    li = Tables(spark, sf_dir).lineitem
    home = F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0)
    y = li.groupBy(F.year("l_shipdate").alias("Año")).agg(F.sum(home).alias("n"), F.sum(F.col("l_quantity") - home).alias("i"), F.sum("l_quantity").alias("t"))
    dots = lambda c: F.translate(F.format_number(F.col(c).cast("double"), 0), ",", ".")
    path = scratch_path(spark, "annual")
    y.select("Año", *[dots(c).alias(c) for c in ("n", "i", "t")]).write.option("header", True).option("sep", ";").csv(path)
    return S.load_annual_arrivals(spark, path)


@query("csv_national", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha, CAST(count(*) AS DOUBLE) AS casos_who
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = 'NATION_3' GROUP BY 1
""")
def csv_national(spark, sf_dir):
    """Orders per nation and month as a ';' file whose headers hold line breaks;
    one country's series read from it (TS9)."""
    t = Tables(spark, sf_dir)
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    m = o.groupBy(F.col("n_name").alias("Country"), F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("Month")).agg(
        F.count(F.lit(1)).alias("Measles\ntotal"))
    path = scratch_path(spark, "national")
    m.write.option("header", True).option("sep", ";").csv(path)
    return S.national_series(S.load_who_measles(spark, path), "NATION_3")


@query("csv_terminal", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha,
       CAST(count_if(l_linestatus = 'F') + count_if(l_linestatus <> 'F' AND l_returnflag = 'N') AS BIGINT) AS pax_intl_total
FROM lineitem GROUP BY 1
""")
def csv_terminal(spark, sf_dir):
    """Two monthly counts with Spanish month names, empty where zero (TS10)."""
    li = Tables(spark, sf_dir).lineitem
    names = F.array(*[F.lit(m) for m in SPANISH_MONTHS])
    m = li.groupBy(F.year("l_shipdate").alias("anio"), F.get(names, F.month("l_shipdate") - 1).alias("mes")).agg(
        F.nullif(F.count_if(F.col("l_linestatus") == "F"), F.lit(0)).alias("pasajeros_llegadas_internacionales_t1"),
        F.nullif(F.count_if((F.col("l_linestatus") != "F") & (F.col("l_returnflag") == "N")), F.lit(0)).alias("pasajeros_llegadas_internacionales_t2"))
    return S.load_terminal(spark, write_csv(m, scratch_path(spark, "terminal")))


@query("saved_copies", """
SELECT c.copia, n_nationkey, n_name, n_regionkey FROM nation CROSS JOIN (VALUES ('csv'), ('parquet')) AS c(copia)
""")
def saved_copies(spark, sf_dir):
    """Both copies of a saved table, found again by the first name that exists (SNK2, SRC5)."""
    root = scratch_path(spark, "saved")
    save_table(Tables(spark, sf_dir).nation.select("n_nationkey", "n_name", "n_regionkey"), "nation", root)
    csv = S.read_csv_strings(spark, S.first_existing(spark, root, ["absent.csv", "nation.csv"]))
    csv = csv.select(F.lit("csv").alias("copia"), F.col("n_nationkey").cast("bigint"), "n_name", F.col("n_regionkey").cast("bigint"))
    both = spark.read.parquet(f"{root}/nation.parquet").select(F.lit("parquet").alias("copia"), F.col("n_nationkey").cast("bigint"), "n_name", F.col("n_regionkey").cast("bigint"))
    return csv.unionByName(both).withColumns({c: F.col(c).cast(dict(Tables(spark, sf_dir).nation.dtypes)[c]) for c in ("n_nationkey", "n_regionkey")})


@query("file_inventory", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(1 AS BIGINT) AS n_archivos FROM orders WHERE year(o_orderdate) >= 2000 GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT year(o_orderdate)) FROM orders WHERE year(o_orderdate) < 2000 HAVING count(*) > 0
""")
def file_inventory(spark, sf_dir):
    """Files per year in their names (SRC9); the years before 2000 match no pattern."""
    o = Tables(spark, sf_dir).orders.select(F.year("o_orderdate").alias("anio")).distinct()
    root = scratch_path(spark, "inventory")
    o.withColumn("a", F.col("anio")).repartition("anio").write.partitionBy("anio").option("header", True).csv(root)
    per_year, _ = S.file_inventory(spark, f"{root}/anio=*/*.csv", r"anio=(20\d{2})")
    return per_year.select("anio", "n_archivos")


@query("recode_sex", f"""
WITH wk AS ({WEEKLY_SQL}),
s AS (SELECT anio, semana, entidad_federativa, enfermedad, CASE WHEN sexo = 'O' THEN 'M' ELSE sexo END AS sexo, casos_semana FROM wk),
f AS (SELECT *, max(sexo = 'F') OVER (PARTITION BY anio, semana) AS has_f FROM s)
SELECT anio, semana, entidad_federativa, enfermedad, casos_semana,
       CASE WHEN anio <= 1995 AND has_f AND sexo = 'M' THEN 'H' WHEN anio <= 1995 AND has_f AND sexo = 'F' THEN 'M' ELSE sexo END AS sexo
FROM f
""")
def recode_sex_q(spark, sf_dir):
    """Old sex labels (TRF1): line status F and O stand for F and M."""
    wk = weekly_bulletin(spark, sf_dir).select("anio", "semana", "entidad_federativa", "enfermedad", "casos_semana",
                                               F.when(F.col("sexo") == "O", "M").otherwise(F.col("sexo")).alias("sexo"))
    return B.recode_sex(wk, 1995)


@query("correction_pass", f"""
WITH n AS ({NEW_CASES_SQL})
SELECT *, CAST(sum(casos_nuevos) OVER (PARTITION BY anio, semana, entidad_federativa, enfermedad) AS BIGINT) AS casos_nuevos_total FROM n
""")
def correction_pass_q(spark, sf_dir):
    """New cases of a stored fact computed again (TRF6); wrong values are replaced."""
    wk = weekly_bulletin(spark, sf_dir).drop("casos_acum_anterior")
    return correction_pass(wk.withColumns({"casos_nuevos": F.lit(-1), "casos_nuevos_total": F.lit(-1)}))


@query("spot_check", """
SELECT n_nationkey, n AS n, CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 5 = 1 THEN n + 1 END AS n_actual
FROM (SELECT c_nationkey AS n_nationkey, count(*) AS n FROM customer GROUP BY 1) WHERE n_nationkey % 5 < 2
""")
def spot_check_q(spark, sf_dir):
    """Expected customers per nation against a table that lacks some and has others wrong (DQ4)."""
    want = Tables(spark, sf_dir).customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    have = want.where("n_nationkey % 5 <> 0").withColumn("n", F.when(F.col("n_nationkey") % 5 == 1, F.col("n") + 1).otherwise(F.col("n")))
    return spot_check(want, have, ["n_nationkey"], "n")


@query("cluster_profile", """
SELECT label, round_even(avg(CAST(embedding[1] AS DOUBLE)), 2) AS x, round_even(avg(CAST(embedding[2] AS DOUBLE)), 2) AS y, count(*) AS n,
       count_if(embedding[3] > 0) AS n_sede
FROM embeddings GROUP BY 1
""")
def cluster_profile_q(spark, sf_dir):
    """Means, size and flag count of the given clusters (AGG14, AGG15)."""
    e = Tables(spark, sf_dir).embeddings
    at = lambda i: F.col("embedding")[i].cast("double")
    return cluster_profile(e.select("label", at(0).alias("x"), at(1).alias("y"), (at(2) > 0).alias("sede")), "label", ["x", "y"], "sede")


@query("label_comparison", """
SELECT CASE WHEN embedding[1] > 0 THEN 'alto' ELSE 'bajo' END AS etiqueta, label, count(*) AS n FROM embeddings GROUP BY 1, 2
""")
def label_comparison_q(spark, sf_dir):
    """Two labellings side by side, one of them by name (CLU8, CLU9)."""
    e = Tables(spark, sf_dir).embeddings
    named = label_clusters(e.select("vec_id", (F.col("embedding")[0] > 0).cast("int").alias("c")), "c", {0: "bajo", 1: "alto"})
    return label_comparison(named, e, "vec_id", "etiqueta", "label")


@query("weighted_rows", """
WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
w AS (SELECT o_orderstatus, sum(n) OVER () / (count(*) OVER () * n) AS peso FROM c)
SELECT o_orderstatus, count(*) AS n, round_even(max(peso), 9) AS peso FROM orders JOIN w USING (o_orderstatus) GROUP BY 1
""")
def weighted_rows(spark, sf_dir):
    """The balanced class weight at every row (SUP1, SUP3)."""
    o = with_weights(Tables(spark, sf_dir).orders.select("o_orderstatus"), "o_orderstatus")
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.bround(F.max("peso"), 9).alias("peso"))
