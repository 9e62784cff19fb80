"""Registered query: bulletin page extraction (EXT1-8) on pages built from the
test tables.

Each region is one weekly bulletin file; its nations are the states. Page
text carries the issue number, week and year; the page grid carries two
disease blocks (one 'primary' block at column 1 whose weekly count follows
the state name, one at column 5 with its own weekly column), sex labels in
row 3 ([M, F] or [H, M]), counts formatted with narrow no-break thousands
separators, and a TOTAL line that is not a state. Odd regions get a cover
page 1 whose text matches but whose grid is too short, so page 2 is the
first good page. The extractor must return, for each state, disease and
sex, the counts the pages were built from; the oracle computes those counts
directly from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentinela.operators.bulletin import OUTPUT_COLUMNS, extract
from sentinela.operators.joins import bounded_distinct
from sentinela.plans.registry import query
from sentinela.session import scratch_path
from sentinela.sinks.writers import checkpoint_parquet
from sentinela.sources.literal import DISEASES, disease_config
from sentinela.sources.testdata import Tables
from sentinela.streaming.bulletins import read_table, run_available

NNBSP = "\u202f"


def _fmt(c):
    """Integer with narrow no-break thousands separators."""
    return F.replace(F.format_number(c.cast("long"), 0), F.lit(","), F.lit(NNBSP))


def nation_counts(t: Tables):
    o = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    hi = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    per = o.groupBy("c_nationkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("v_sem"), F.count_if(hi).alias("v_a1"),
        F.count_if(~hi).alias("v_a2"), F.count(F.lit(1)).alias("v_ant"),
        F.count_if(F.col("o_totalprice") > 300000).alias("e_sem"),
        F.count_if(F.col("o_orderstatus") == "O").alias("e_a1"),
        F.count_if(F.col("o_orderstatus") == "P").alias("e_a2"),
        F.count_distinct("o_custkey").alias("e_ant"))
    nat = t.nation.join(per, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return nat.select("n_nationkey", "n_name", "n_regionkey",
                      *[F.coalesce(F.col(c), F.lit(0)).alias(c)
                        for c in ["v_sem", "v_a1", "v_a2", "v_ant", "e_sem", "e_a1", "e_a2", "e_ant"]])


def bulletin_pages_from_tables(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nat = nation_counts(t)

    def col_lines(expr, total):
        s = F.array_sort(F.collect_list(F.struct("n_nationkey", expr.alias("l"))))
        return F.concat_ws("\n", F.transform(s, lambda x: x["l"]), F.lit(total))

    per_region = nat.groupBy("n_regionkey").agg(
        col_lines(F.concat_ws(" ", "n_name", _fmt(F.col("v_sem"))), "TOTAL 0").alias("c0"),
        col_lines(F.concat_ws(" ", F.col("v_a1").cast("string"), F.col("v_a2").cast("string")), "0 0").alias("c2"),
        col_lines(F.col("v_ant").cast("string"), "0").alias("c4"),
        col_lines(_fmt(F.col("e_sem")), "0").alias("c5"),
        col_lines(F.concat_ws(" ", F.col("e_a1").cast("string"), F.col("e_a2").cast("string")), "0 0").alias("c6"),
        col_lines(F.col("e_ant").cast("string"), "0").alias("c8"))
    reg = per_region.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    e = F.lit("")
    header = F.array(F.lit("ENTIDAD"), F.lit("Varicela B01"), e, e, e, F.lit("Escarlatina ª38"), e, e, e)
    even = (F.col("r_regionkey") % 2) == 0
    sexrow = F.when(even, F.array(e, F.lit("M"), F.lit("F"), e, e, e, F.lit("M"), F.lit("F"), e)).otherwise(
        F.array(e, F.lit("H"), F.lit("M"), e, e, e, F.lit("H"), F.lit("M"), e))
    data = F.array("c0", e, "c2", e, "c4", "c5", "c6", e, "c8")
    filler = F.array(*[e] * 9)
    grid = F.array(header, filler, filler, sexrow, data)
    week = (F.col("r_regionkey") + 10).cast("string")
    year = (F.col("r_regionkey") + 2000).cast("string")
    kw = F.lit(" ENTIDAD FEDERATIVA Casos por Varicela B01 y Escarlatina A38")
    text_full = F.concat(F.lit("Boletín Número "), F.col("r_regionkey").cast("string"), F.lit(" | Semana "), week,
                         F.lit(" | del "), year, kw)
    fname = F.concat(F.lit("boletin_"), F.regexp_replace("r_name", " ", "_"), F.lit("_sem"), week, F.lit(".pdf"))
    pages = reg.select(
        fname.alias("file"),
        F.explode(F.when(even, F.array(F.struct(F.lit(1).alias("page"), text_full.alias("text"), grid.alias("grid"))))
                  .otherwise(F.array(
                      F.struct(F.lit(1).alias("page"), text_full.alias("text"),
                               F.array(header, filler, filler).alias("grid")),
                      F.struct(F.lit(2).alias("page"), F.concat(F.lit("Cuadro"), kw).alias("text"),
                               grid.alias("grid"))))).alias("p"))
    return pages.select("file", "p.page", "p.text", "p.grid")


BLOCK_SQL = """
WITH o AS (SELECT o.*, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
per AS (SELECT c_nationkey,
          count_if(o_orderstatus = 'F') AS v_sem, count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS v_a1,
          count_if(o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS v_a2, count(*) AS v_ant,
          count_if(o_totalprice > 300000) AS e_sem, count_if(o_orderstatus = 'O') AS e_a1,
          count_if(o_orderstatus = 'P') AS e_a2, count(DISTINCT o_custkey) AS e_ant
        FROM o GROUP BY 1),
n AS (SELECT n.n_name, n.n_regionkey, coalesce(v_sem, 0) AS v_sem, coalesce(v_a1, 0) AS v_a1,
             coalesce(v_a2, 0) AS v_a2, coalesce(v_ant, 0) AS v_ant, coalesce(e_sem, 0) AS e_sem,
             coalesce(e_a1, 0) AS e_a1, coalesce(e_a2, 0) AS e_a2, coalesce(e_ant, 0) AS e_ant
      FROM nation n LEFT JOIN per ON n.n_nationkey = per.c_nationkey),
s AS (SELECT *, CASE WHEN n_regionkey % 2 = 0 THEN 'M' ELSE 'H' END AS s1,
                CASE WHEN n_regionkey % 2 = 0 THEN 'F' ELSE 'M' END AS s2 FROM n)
SELECT 2000 + n_regionkey AS anio, 10 + n_regionkey AS semana, n_name AS entidad_federativa,
       'Varicela' AS enfermedad, 'B01' AS cie10, s1 AS sexo, CAST(v_sem AS INTEGER) AS casos_semana,
       CAST(v_a1 AS INTEGER) AS casos_acumulado, CAST(v_ant AS INTEGER) AS casos_acum_anterior FROM s
UNION ALL SELECT 2000 + n_regionkey, 10 + n_regionkey, n_name, 'Varicela', 'B01', s2, CAST(v_sem AS INTEGER),
       CAST(v_a2 AS INTEGER), CAST(v_ant AS INTEGER) FROM s
UNION ALL SELECT 2000 + n_regionkey, 10 + n_regionkey, n_name, 'Escarlatina', 'A38', s1, CAST(e_sem AS INTEGER),
       CAST(e_a1 AS INTEGER), CAST(e_ant AS INTEGER) FROM s
UNION ALL SELECT 2000 + n_regionkey, 10 + n_regionkey, n_name, 'Escarlatina', 'A38', s2, CAST(e_sem AS INTEGER),
       CAST(e_a2 AS INTEGER), CAST(e_ant AS INTEGER) FROM s
"""


@query("block_parse", BLOCK_SQL)
def block_parse(spark, sf_dir):
    pages = bulletin_pages_from_tables(spark, sf_dir)
    states = bounded_distinct(Tables(spark, sf_dir).nation, "n_name", 10_000)
    return extract(pages, disease_config(spark), states).select(*OUTPUT_COLUMNS)


def _streamed(spark, sf_dir, name):
    """The bulletins land in two runs, one of them twice; one of the tables the runs wrote."""
    pages = checkpoint_parquet(bulletin_pages_from_tables(spark, sf_dir), "landed-pages")
    states = bounded_distinct(Tables(spark, sf_dir).nation, "n_name", 10_000)
    root = scratch_path(spark, "bulletin-stream")
    early = F.regexp_extract("file", r"_sem(\d+)", 1).cast("int") < 13
    for landed in (pages.where(early), pages):  # the second folder of files repeats the first bulletins
        landed.coalesce(1).write.mode("append").parquet(f"{root}/landing")
        run_available(spark, f"{root}/landing", f"{root}/out", disease_config(spark), states)
    return read_table(spark, f"{root}/out", name)


@query("stream_bulletins", BLOCK_SQL)
def stream_bulletins(spark, sf_dir):
    """The raw rows of the incremental runs: those of one run over all pages (SRC8, EXT1-6)."""
    return _streamed(spark, sf_dir, "rows").select(*OUTPUT_COLUMNS)


_CONFIG_SQL = ", ".join(f"('{name}', {str(optional).lower()})" for name, _, _, _, optional in DISEASES)


@query("stream_missing", f"""
SELECT 'boletin_' || replace(r_name, ' ', '_') || '_sem' || CAST(r_regionkey + 10 AS VARCHAR) || '.pdf' AS file, enfermedad, optional
FROM region, (VALUES {_CONFIG_SQL}) d(enfermedad, optional) WHERE enfermedad NOT IN ('Varicela', 'Escarlatina')
""")
def stream_missing(spark, sf_dir):
    """Configured diseases that a bulletin has no row of (EXT7)."""
    return _streamed(spark, sf_dir, "missing").select("file", "enfermedad", "optional")


@query("stream_quarantine", """
SELECT 'boletin_' || replace(r_name, ' ', '_') || '_sem' || CAST(r_regionkey + 10 AS VARCHAR) || '.pdf' AS file, 1 AS page, unnest(['Varicela', 'Escarlatina']) AS enfermedad
FROM region WHERE r_regionkey % 2 = 1
""")
def stream_quarantine(spark, sf_dir):
    """Pages that match a disease and give no row: the cover pages (EXT8)."""
    return _streamed(spark, sf_dir, "quarantine").select("file", "page", "enfermedad")
