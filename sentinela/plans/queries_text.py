"""Registered queries: regex capture with fallback, count parsing, ISO weeks,
cyclic week, Spanish month names (EXT1, SCL2-3, SCL6, SCL8, SCL14, CLN4-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentinela.functions.calendar import SPANISH_MONTHS, cyclic_week, iso_week_monday, month_name_to_date, week_label
from sentinela.functions.numeric import tcast, parse_count, strip_thousands
from sentinela.functions.text import capture_with_fallback
from sentinela.plans.registry import query
from sentinela.sources.testdata import Tables

# Patterns: page number from the URL query, else the tracking id in the page;
# language from the URL path, else the html lang attribute.
NUM_PRIMARY, NUM_FALLBACK = r"page=(\d+)", r"track\((\d+)\)"
LANG_PRIMARY, LANG_FALLBACK = r"/([a-z]{2})/", r"lang=\"(\w+)\""


@query("regex_issue", f"""
SELECT page_id,
  coalesce(TRY_CAST(nullif(regexp_extract(url, '{NUM_PRIMARY}', 1), '') AS INTEGER),
           TRY_CAST(nullif(regexp_extract(html, '{NUM_FALLBACK}', 1), '') AS INTEGER), 0) AS numero,
  coalesce(nullif(regexp_extract(url, '{LANG_PRIMARY}', 1), ''),
           nullif(regexp_extract(html, '{LANG_FALLBACK}', 1), ''), 'und') AS idioma
FROM pages
""")
def regex_issue(spark, sf_dir):
    p = Tables(spark, sf_dir).pages
    num = F.coalesce(tcast(F.nullif(F.regexp_extract("url", NUM_PRIMARY, 1), F.lit("")), "int"),
                     tcast(F.nullif(F.regexp_extract("html", NUM_FALLBACK, 1), F.lit("")), "int"), F.lit(0))
    lang = capture_with_fallback("url", "html", LANG_PRIMARY, LANG_FALLBACK, default="und")
    return p.select("page_id", num.alias("numero"), lang.alias("idioma"))


NARROW_NBSP = "\u202f"


@query("num_parse", """
WITH b AS (SELECT o_orderkey, o_orderstatus, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS s_coma FROM orders),
c AS (SELECT *, replace(s_coma, ',', '.') AS s_punto, replace(s_coma, ',', chr(8239)) AS s_nbsp FROM b)
SELECT o_orderkey,
  coalesce(TRY_CAST(regexp_replace(CASE o_orderstatus WHEN 'F' THEN s_nbsp WHEN 'O' THEN 'n.d.' ELSE '-' END,
                                   '[\\x{202f}\\x{00a0} ]', '', 'g') AS INTEGER), 0) AS celda,
  coalesce(TRY_CAST(regexp_replace(s_coma, '[\\x{202f}\\x{00a0} ]', '', 'g') AS INTEGER), 0) AS celda_coma,
  TRY_CAST(trim(replace(s_punto, '.', '')) AS DOUBLE) AS miles_punto,
  TRY_CAST(trim(replace(s_coma, ',', '')) AS DOUBLE) AS miles_coma
FROM c
""")
def num_parse(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    s_coma = F.format_number(F.floor("o_totalprice").cast("long"), 0)
    b = o.select("o_orderkey", "o_orderstatus", s_coma.alias("s_coma"))
    c = b.withColumns({"s_punto": F.replace("s_coma", F.lit(","), F.lit(".")),
                       "s_nbsp": F.replace("s_coma", F.lit(","), F.lit(NARROW_NBSP))})
    cell = (F.when(F.col("o_orderstatus") == "F", F.col("s_nbsp"))
            .when(F.col("o_orderstatus") == "O", F.lit("n.d.")).otherwise(F.lit("-")))
    return c.select("o_orderkey", parse_count(cell).alias("celda"), parse_count("s_coma").alias("celda_coma"),
                    strip_thousands("s_punto", ".").alias("miles_punto"),
                    strip_thousands("s_coma", ",").alias("miles_coma"))


WEEKS_SQL = ("SELECT DISTINCT CAST(isoyear(o_orderdate) AS INTEGER) AS anio, "
             "CAST(weekofyear(o_orderdate) AS INTEGER) AS semana FROM orders")


@query("iso_week_start", f"""
SELECT anio, semana,
  CAST(date_trunc('week', make_date(anio, 1, 4)) AS DATE)
    + CAST(7 * ((CASE WHEN semana = 53 AND weekofyear(make_date(anio, 12, 28)) < 53 THEN 52 ELSE semana END) - 1)
           AS INTEGER) AS fecha_inicio,
  CAST(anio AS VARCHAR) || '-W' || lpad(CAST(semana AS VARCHAR), 2, '0') AS "semana_año"
FROM ({WEEKS_SQL})
""")
def iso_week_start(spark, sf_dir):
    w = _weeks(spark, sf_dir)
    return w.select("anio", "semana", iso_week_monday("anio", "semana").alias("fecha_inicio"),
                    week_label("anio", "semana").alias("semana_año"))


def _weeks(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select(F.extract(F.lit("YEAROFWEEK"), "o_orderdate").alias("anio"), F.weekofyear("o_orderdate").alias("semana")).distinct()


@query("cyclic_week", f"""
SELECT anio, semana, round_even(sin(2 * pi() * semana / 52), 9) AS semana_sin,
       round_even(cos(2 * pi() * semana / 52), 9) AS semana_cos
FROM ({WEEKS_SQL})
""")
def cyclic_week_q(spark, sf_dir):
    w = _weeks(spark, sf_dir)
    s, c = cyclic_week("semana")
    return w.select("anio", "semana", F.bround(s, 9).alias("semana_sin"), F.bround(c, 9).alias("semana_cos"))


def _month_sql():
    names = ", ".join(f"'{m}'" for m in SPANISH_MONTHS)
    case = " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(SPANISH_MONTHS, 1))
    return f"""
WITH t AS (
  SELECT o_orderkey, year(o_orderdate) AS anio,
    CASE WHEN day(o_orderdate) = 31 THEN 'desconocido'
         WHEN day(o_orderdate) % 3 = 0 THEN upper([{names}][month(o_orderdate)])
         WHEN day(o_orderdate) % 3 = 1 THEN '  ' || [{names}][month(o_orderdate)] || ' '
         ELSE [{names}][month(o_orderdate)] END AS mes_texto
  FROM orders)
SELECT o_orderkey, mes_texto,
  CASE WHEN (CASE lower(trim(mes_texto)) {case} END) IS NOT NULL
       THEN make_date(anio, CASE lower(trim(mes_texto)) {case} END, 1) END AS fecha
FROM t
"""


@query("month_name_date", _month_sql())
def month_name_date(spark, sf_dir):
    """Month names spelled with mixed case and padding, one unknown name;
    parsed back to the first of the month (CLN5)."""
    o = Tables(spark, sf_dir).orders
    name = F.element_at(F.array(*[F.lit(m) for m in SPANISH_MONTHS]), F.month("o_orderdate"))
    d = F.dayofmonth("o_orderdate")
    txt = (F.when(d == 31, F.lit("desconocido")).when(d % 3 == 0, F.upper(name))
           .when(d % 3 == 1, F.concat(F.lit("  "), name, F.lit(" "))).otherwise(name))
    t = o.select("o_orderkey", F.year("o_orderdate").alias("anio"), txt.alias("mes_texto"))
    return t.select("o_orderkey", "mes_texto", month_name_to_date("anio", "mes_texto").alias("fecha"))
