"""Typed readers for the surveillance inputs (SRC1-9, CLN1-6, TS9-10).

Every CSV is read with all columns as strings (no ``inferSchema``), headers
are repaired, then columns are cast explicitly with coerce-to-NULL casts.
Paths may be on any Hadoop-compatible file system.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.functions.calendar import month_name_to_date, month_start, year_month_label, year_month_to_date
from sentinela.functions.numeric import sentinel_date, strip_thousands, tcast
from sentinela.functions.text import clean_header

# Integer columns of the case line-list.
LINELIST_INT_COLUMNS = [
    "ID_REGISTRO", "EDAD_ANOS", "EDAD_MESES", "EDAD_DIAS", "SEXO", "HABLA_LENGUA_INDIG", "INDIGENA",
    "ENTIDAD_UM_NOTIF", "MUNICIPIO_UM_NOTIF", "ENTIDAD_RES", "MUNICIPIO_RES", "INSTITUCION_NOTIF", "VACUNACION",
    "EXANTEMA", "FIEBRE", "COMPLICACIONES", "DEFUNCION", "DIAGNOSTICO", "CRITERIO_DIAGNOSTICO",
]

# Surveillance table column renames.
WHO_RENAMES = {
    "Measles total": "measles_total", "Measles lab-confirmed": "measles_lab", "Measles epi-linked": "measles_epi",
    "Measles clinical": "measles_clinical", "Measles suspect": "measles_suspect",
}
VACCINATION_RENAMES = {"Entity": "Country", "Code": "ISO3", "Measles, first dose (MCV1)": "mcv1"}


def read_csv_strings(spark: SparkSession, path: str, sep: str = ",", multiline: bool = False) -> DataFrame:
    """All-string CSV scan with a header (SRC1/SRC2). A UTF-8 BOM is dropped
    by the reader; ``multiline`` is needed when a quoted header holds a newline."""
    df = (spark.read.option("header", True).option("sep", sep).option("multiLine", multiline)
          .option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(path))
    return repair_headers(df)


def repair_headers(df: DataFrame) -> DataFrame:
    """strip, newline -> space, double space -> single (SRC3)."""
    return df.toDF(*[clean_header(c).lstrip("\ufeff") for c in df.columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
        return True
    except AnalysisException:
        return False


def first_existing(spark: SparkSession, raw_dir: str, candidates: list[str]) -> str:
    """First candidate file that exists under ``raw_dir``; fails early (SRC5)."""
    for name in candidates:
        p = f"{raw_dir.rstrip('/')}/{name}"
        if path_exists(spark, p):
            return p
    raise FileNotFoundError(f"none of {candidates} under {raw_dir}")


def load_case_linelist(spark: SparkSession, raw_dir: str, files: dict[int, str]) -> DataFrame:
    """Yearly line-list files -> one typed table (SRC4, CLN1-3).

    Each year keeps its lineage in ``anio_fuente``; missing columns in a year
    become NULL (union by name). Diagnosis dates with the 9999 sentinels or
    impossible values are NULL and fall back to the update date
    (``fecha_base``, Q12); ``anio_mes_dt`` is the month of ``fecha_base``."""
    parts = []
    for year, name in sorted(files.items()):
        p = f"{raw_dir.rstrip('/')}/{name}"
        parts.append(read_csv_strings(spark, p).withColumn("anio_fuente", F.lit(int(year))))
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = set(raw.columns)
    typed = raw.withColumns({c: tcast(c, "int") for c in LINELIST_INT_COLUMNS if c in cols})
    if "ID_REGISTRO" in cols:
        typed = typed.withColumn("ID_REGISTRO", tcast(F.col("ID_REGISTRO"), "long"))
    if "ORIGEN_CASO" in cols:
        typed = typed.withColumn("ORIGEN_CASO", tcast("ORIGEN_CASO", "double"))
    diag = sentinel_date("FECHA_DIAGNOSTICO") if "FECHA_DIAGNOSTICO" in cols else F.lit(None).cast("date")
    upd = sentinel_date("FECHA_ACTUALIZACION") if "FECHA_ACTUALIZACION" in cols else F.lit(None).cast("date")
    typed = typed.withColumns({"FECHA_DIAGNOSTICO": diag, "FECHA_ACTUALIZACION": upd})
    typed = typed.withColumn("fecha_base", F.coalesce("FECHA_DIAGNOSTICO", "FECHA_ACTUALIZACION"))
    return typed.withColumns({"anio_mes_dt": month_start("fecha_base"),
                              "anio_mes": year_month_label(month_start("fecha_base"))})


def load_who_measles(spark: SparkSession, path: str) -> DataFrame:
    """';'-separated, BOM, quoted multi-line headers; numeric casts to NULL on failure."""
    df = read_csv_strings(spark, path, sep=";", multiline=True).withColumnsRenamed(WHO_RENAMES)
    num = ["Year", "Month", "measles_total", "measles_lab", "measles_epi", "measles_clinical", "measles_suspect"]
    out = df.withColumns({c: tcast(c, "double") for c in num if c in df.columns})
    return out.withColumns({"Year": F.col("Year").cast("int"), "Month": F.col("Month").cast("int")})


def load_vaccination(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv_strings(spark, path).withColumnsRenamed(VACCINATION_RENAMES)
    return df.select("Country", "ISO3", tcast("Year", "int").alias("Year"), tcast("mcv1", "double").alias("mcv1"))


def load_monthly_counts(spark: SparkSession, path: str, value_cols: list[str]) -> DataFrame:
    """Monthly series with a Spanish month name (passengers, flights) (CLN5)."""
    df = read_csv_strings(spark, path)
    return df.select(month_name_to_date(tcast("anio", "int"), "mes").alias("fecha"),
                     *[tcast(c, "long").alias(c) for c in value_cols])


def load_terminal(spark: SparkSession, path: str,
                  t1: str = "pasajeros_llegadas_internacionales_t1",
                  t2: str = "pasajeros_llegadas_internacionales_t2") -> DataFrame:
    """International arrivals T1 + T2, NULL counted as 0 (TS10)."""
    df = read_csv_strings(spark, path)
    return df.select(month_name_to_date(tcast("anio", "int"), "mes").alias("fecha"),
                     (F.coalesce(tcast(t1, "long"), F.lit(0)) + F.coalesce(tcast(t2, "long"), F.lit(0)))
                     .alias("pax_intl_total"))


def load_city_arrivals(spark: SparkSession, path: str, value_col: str = "ciudad_de_mexico",
                       out: str = "intl_cdmx", compat: bool = False) -> DataFrame:
    """Month-end dated arrivals. By default truncated to the month start so the
    panel join matches (Q1); ``compat=True`` keeps the raw date."""
    df = read_csv_strings(spark, path)
    d = F.try_to_date(F.col("fecha"))
    return df.select((d if compat else month_start(d)).alias("fecha"), tcast(value_col, "long").alias(out))


def load_annual_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """';' + BOM, positional header, '.' thousands separators (CLN4)."""
    df = read_csv_strings(spark, path, sep=";")
    df = df.toDF("anio", "pax_nacionales", "pax_internacionales", "pax_total", *df.columns[4:])
    return df.select(tcast("anio", "int").alias("anio"),
                     *[strip_thousands(c, ".", "long").alias(c)
                       for c in ["pax_nacionales", "pax_internacionales", "pax_total"]])


def load_attendance(spark: SparkSession, path: str) -> DataFrame:
    """Match attendance with ',' thousands separators."""
    df = read_csv_strings(spark, path)
    return df.withColumn("Attendance", strip_thousands("Attendance", ",", "double"))


def load_matches_history(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv_strings(spark, path)
    return df.withColumns({"year": tcast("year", "int"), "home_score": tcast("home_score", "int"),
                           "away_score": tcast("away_score", "int"), "date": F.try_to_date(F.col("date"))})


def national_series(measles: DataFrame, country: str, out: str = "casos_who") -> DataFrame:
    """One country's monthly series dated at the month start (TS9, CLN6)."""
    f = measles.where(F.col("Country") == country)
    return f.select(year_month_to_date("Year", "Month").alias("fecha"), F.col("measles_total").alias(out))


def file_inventory(spark: SparkSession, path_glob: str, year_pattern: str = r"(20\d{2})") -> tuple[DataFrame, DataFrame]:
    """File counts per year and duplicated base names (SRC9). Only file
    metadata is read (the binary content column is pruned)."""
    files = spark.read.format("binaryFile").load(path_glob).select("path", "length", "modificationTime")
    files = files.withColumns({"nombre": F.regexp_extract("path", r"([^/]+)$", 1),
                               "anio": tcast(F.regexp_extract("path", year_pattern, 1), "int")})
    per_year = files.groupBy("anio").agg(F.count(F.lit(1)).alias("n_archivos"), F.sum("length").alias("bytes"))
    dups = files.groupBy("nombre").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return per_year, dups


def read_bulletin_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Decoded bulletin pages ``(file, page, text, grid array<array<string>>)`` (SRC8)."""
    schema = "file string, page int, text string, grid array<array<string>>"
    reader = spark.read.schema(schema)
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)
