"""Weekly bulletin: page extraction (EXT1-8) and the fact-table transform (TRF1-6).

Extraction works on a ``bulletin_pages(file, page, text, grid)`` table (PDF
decoding is outside this library): every step is a column expression,
``posexplode`` or a join, so files are processed in parallel by Spark tasks
and a malformed grid yields NULLs (quarantined), never a crashed job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.functions.calendar import cyclic_week, iso_week_monday, week_label
from sentinela.functions.numeric import tcast, parse_count, safe_ratio
from sentinela.functions.text import first_capture, nonblank_lines, prefix_and_rest, py_split
from sentinela.operators.joins import dedupe_first, reindex_fill
from sentinela.sinks.writers import checkpoint_parquet
from sentinela.operators.windows import group_totals, new_from_cumulative

KEY = ["anio", "semana", "entidad_federativa", "enfermedad", "sexo"]
MEASURES = ["casos_semana", "casos_acumulado", "casos_acum_anterior"]

# Issue year / week patterns (first page text, then file name).
YEAR_TEXT = r"\b(20\d{2})\b"
WEEK_TEXT = r"[Ss]emana\s+(\d{1,2})\b"
YEAR_FILE = r"\b(20\d{2})\b"
WEEK_FILE = r"(?i)sem[_\-]?(\d{1,2})"

# Output schema of the raw bulletin table.
OUTPUT_COLUMNS = ["anio", "semana", "entidad_federativa", "enfermedad", "cie10", "sexo",
                  "casos_semana", "casos_acumulado", "casos_acum_anterior"]


# ------------------------------------------------------------------ transform

def recode_sex(df: DataFrame, cutoff_year: int = 2020, guard: bool = True) -> DataFrame:
    """Old bulletins label sexes M/F; newer ones H/M (TRF1).

    Up to ``cutoff_year`` M -> H and F -> M, evaluated simultaneously. With
    ``guard`` the recode applies only to files that actually contain an 'F'
    (otherwise an H/M file would lose its M rows, Q6); ``guard=False``
    reproduces the unguarded behaviour."""
    old = F.col("anio") <= cutoff_year
    if guard:
        has_f = F.max((F.col("sexo") == "F").cast("int")).over(Window.partitionBy("anio", "semana")) == 1
        old = old & has_f
    s = F.col("sexo")
    return df.withColumn("sexo", F.when(old & (s == "M"), "H").when(old & (s == "F"), "M").otherwise(s))


def densify(df: DataFrame, entities, diseases=None, sexes=None, min_year: int = 2000, order=None,
            only_observed_weeks: bool = True) -> DataFrame:
    """Year x week x entity x disease x sex grid with zeros (TRF2, JN5, JN7, SET4).

    Years (> ``min_year``) and weeks (1..53) are the observed ones (Q15);
    ``only_observed_weeks=False`` uses every week 1..53.
    ``entities`` / ``diseases`` / ``sexes`` are catalogues (a one-column
    DataFrame or a list); None takes the observed values. Duplicated keys
    keep the first row under ``order``.

    The input (an extracted or aggregated weekly table) is written once, so
    that what is upstream runs once. Its observed values are distinct rows of
    that table; they and the catalogues are DataFrames of any size, and the
    grid is their product, made on the executors: a grid is as large as its
    result. The fact is joined once on the full key."""
    order = order if order is not None else [F.col(c) for c in MEASURES]
    spark = df.sparkSession
    df = checkpoint_parquet(df, "dense-input")

    def dimension(values, col, observed):
        if values is None:
            return observed
        if isinstance(values, DataFrame):
            values = values.toDF(col).where(F.col(col).isNotNull()).distinct()
        else:
            values = spark.createDataFrame([(v,) for v in sorted(set(values))], f"`{col}` {dict(observed.dtypes)[col]}")
        return values

    seen = lambda c: df.select(c).where(F.col(c).isNotNull()).distinct()
    years = seen("anio").where(F.col("anio") > min_year).select(F.col("anio").cast("int"))
    weeks = (seen("semana").where(F.col("semana").between(1, 53)).select(F.col("semana").cast("int")) if only_observed_weeks
             else spark.range(1, 54).select(F.col("id").cast("int").alias("semana")))
    grid = years.crossJoin(weeks)
    for values, col in ((entities, "entidad_federativa"), (diseases, "enfermedad"), (sexes, "sexo")):
        grid = grid.crossJoin(dimension(values, col, seen(col)))
    fact = dedupe_first(df, KEY, order).select(*KEY, *MEASURES).withColumns(
        {"anio": F.col("anio").cast("int"), "semana": F.col("semana").cast("int")})
    return reindex_fill(grid, fact, KEY, {m: 0 for m in MEASURES})


def derive_columns(df: DataFrame, first_period: str = "half", halve_totals: bool = False) -> DataFrame:
    """Derived bulletin columns (TRF3-5, WIN1-3, SCL2, SCL8, SCL14).

    Both windows (per state-week totals, and the new-case difference per
    series) are clustered by keys that contain (enfermedad, entidad, anio), so
    one repartition on those keys serves both: a single shuffle.
    ``halve_totals`` corrects Q4 (weekly and prior-year totals repeated on
    both sex rows); the default reproduces the reference."""
    base = df.repartition("enfermedad", "entidad_federativa", "anio")
    sin_w, cos_w = cyclic_week("semana")
    out = base.withColumns({
        "fecha_inicio": iso_week_monday("anio", "semana"),
        "semana_año": week_label("anio", "semana"),
    })
    cell = ["anio", "semana", "entidad_federativa", "enfermedad"]
    out = group_totals(out, cell, {"casos_acumulado": "casos_ambos_sexos", "casos_semana": "casos_sem_total",
                                   "casos_acum_anterior": "casos_ant_total"})
    if halve_totals:
        out = out.withColumns({"casos_sem_total": F.col("casos_sem_total") / 2,
                               "casos_ant_total": F.col("casos_ant_total") / 2})
    out = out.withColumns({
        "tasa_crecimiento": F.when(F.col("casos_ant_total") > 0,
                                   safe_ratio("casos_ambos_sexos", "casos_ant_total")),
        "incr_semanal": F.col("casos_ambos_sexos") - F.col("casos_ant_total"),
        "semana_sin": sin_w,
        "semana_cos": cos_w,
        "es_brote": F.col("casos_acumulado") > 0,
    })
    out = new_from_cumulative(out, ["enfermedad", "entidad_federativa", "sexo", "anio"], "semana",
                              "casos_acumulado", "casos_semana", first_period)
    return group_totals(out, cell, {"casos_nuevos": "casos_nuevos_total"})


def finalize(df: DataFrame) -> DataFrame:
    """Type enforcement (CLN10): year and week int, counts bigint, doubles, boolean, date. Projection,
    renames, derived/constant and dropped columns (PRJ1-5) are plain
    ``select`` / ``withColumn(s)`` / ``withColumnsRenamed`` / ``drop`` calls;
    equality, compound and null filters (FLT1, FLT5, FLT6) plain ``where``."""
    counts = ["casos_semana", "casos_acumulado", "casos_acum_anterior", "casos_ambos_sexos",
            "casos_sem_total", "casos_ant_total", "incr_semanal", "casos_nuevos", "casos_nuevos_total"]
    dbl = ["tasa_crecimiento", "semana_sin", "semana_cos"]
    return df.withColumns({**{c: F.col(c).cast("int") for c in ("anio", "semana") if c in df.columns},
                           **{c: F.col(c).cast("bigint") for c in counts if c in df.columns},
                           **{c: F.col(c).cast("double") for c in dbl if c in df.columns}})


def transform(raw: DataFrame, entities: DataFrame, diseases: DataFrame, sexes: DataFrame,
              cutoff_year: int = 2020, min_year: int = 2000, first_period: str = "half") -> DataFrame:
    """recode -> densify -> derive -> finalise (TRF5, ETL entry B)."""
    dense = densify(recode_sex(raw, cutoff_year), entities, diseases, sexes, min_year)
    return finalize(derive_columns(dense, first_period))


# ----------------------------------------------------------------- extraction

def issue_year_week(pages: DataFrame, year_pattern: str = YEAR_TEXT, week_pattern: str = WEEK_TEXT,
                    file_year_pattern: str = YEAR_FILE, file_week_pattern: str = WEEK_FILE) -> DataFrame:
    """Per file: year and week from the first page's text, else from the file
    name, else 0 (EXT1)."""
    files = pages.groupBy("file").agg(F.max(F.when(F.col("page") == 1, F.col("text"))).alias("text"))

    def pick(text_pat, file_pat):
        return F.coalesce(tcast(first_capture(F.coalesce(F.col("text"), F.lit("")), text_pat), "int"),
                          tcast(first_capture("file", file_pat), "int"), F.lit(0))
    return files.select("file", pick(year_pattern, file_year_pattern).alias("anio"),
                        pick(week_pattern, file_week_pattern).alias("semana"))


def matching_pages(pages: DataFrame, config: DataFrame) -> DataFrame:
    """(page, disease) pairs whose text contains any ``page_kw`` and all
    ``require_kw`` (case-sensitive) (EXT2). The disease config is a handful of
    rows: broadcast nested-loop join."""
    cfg = F.broadcast(config)
    text = F.coalesce(F.col("text"), F.lit(""))

    # lambdas see only their own arguments: the page text is zipped into the
    # keyword arrays instead of being referenced from inside the lambda
    def with_text(arr):
        return F.arrays_zip(F.col(arr).alias("kw"), F.array_repeat(text, F.size(arr)).alias("t"))
    cond = (F.exists(with_text("page_kw"), lambda z: F.contains(z["t"], z["kw"]))
            & F.forall(with_text("require_kw"), lambda z: F.contains(z["t"], z["kw"])))
    return pages.crossJoin(cfg).where(cond)


def _norm_code(c):
    return F.upper(F.replace(F.coalesce(c, F.lit("")), F.lit("ª"), F.lit("A")))


def block_rows(matched: DataFrame, entity_names: list[str]) -> DataFrame:
    """Parse the disease's column block of each matched page (EXT3-5).

    * block start h = first header cell (row 0) containing the code, 'ª' read as 'A';
    * sexes = [M, F] when row 3 has a cell 'F', else [H, M];
    * data row 4; its cells are newline-separated columns: column 0 holds
      'State [weekly]' lines, h+1 the two cumulative values by sex, h+3 the
      prior-year cumulative, and h the weekly count unless h = 1 (then the
      weekly count follows the state name);
    * state = longest catalogue prefix of the line; lines pair up by index;
      missing numbers are 0; each state yields one row per sex.
    Grids that are too short or narrow produce no rows (``get`` is NULL-safe)."""
    g = F.col("grid")
    hdr = F.coalesce(F.get(g, 0), F.array().cast("array<string>"))
    zipped = F.arrays_zip(hdr.alias("c"), F.array_repeat(_norm_code(F.col("cie10")), F.size(hdr)).alias("k"))
    h = F.array_position(F.transform(zipped, lambda z: F.contains(_norm_code(z["c"]), z["k"])), True) - 1
    sexes = F.when(F.coalesce(F.array_contains(F.get(g, 3), "F"), F.lit(False)),
                   F.array(F.lit("M"), F.lit("F"))).otherwise(F.array(F.lit("H"), F.lit("M")))
    row = F.get(g, 4)
    m = matched.select("file", "page", "enfermedad", "cie10", h.cast("int").alias("h"), sexes.alias("sx"),
                       row.alias("row"))
    m = m.where((F.col("h") >= 0) & F.col("row").isNotNull() & (F.col("h") + 3 < F.size("row")))
    cell = lambda i: F.coalesce(F.get(F.col("row"), i), F.lit(""))
    lines = m.select(
        "file", "page", "enfermedad", "cie10", "h", "sx",
        nonblank_lines(cell(F.lit(0))).alias("l0"),
        nonblank_lines(cell(F.col("h") + 1)).alias("lhm"),
        nonblank_lines(cell(F.col("h") + 3)).alias("lant"),
        F.when(F.col("h") != 1, nonblank_lines(cell(F.col("h")))).alias("lsem"))
    ex = lines.select("*", F.posexplode("l0").alias("i", "line"))
    ent, rest = prefix_and_rest("line", entity_names)
    ex = ex.withColumns({"entidad_federativa": ent, "_rest": rest}).where(F.col("entidad_federativa").isNotNull())
    parts = py_split(F.get(F.col("lhm"), F.col("i")))
    rows = ex.select(
        "file", "page", "enfermedad", "cie10", "entidad_federativa",
        F.when(F.col("h") == 1, parse_count("_rest"))
         .otherwise(parse_count(F.get(F.col("lsem"), F.col("i")))).alias("casos_semana"),
        parse_count(F.get(F.col("lant"), F.col("i"))).alias("casos_acum_anterior"),
        F.explode(F.array(
            F.struct(F.col("sx")[0].alias("sexo"), parse_count(F.get(parts, 0)).alias("casos_acumulado")),
            F.struct(F.col("sx")[1].alias("sexo"), parse_count(F.get(parts, 1)).alias("casos_acumulado")),
        )).alias("s"))
    return rows.select("file", "page", "enfermedad", "cie10", "entidad_federativa", "s.sexo", "casos_semana",
                       "s.casos_acumulado", "casos_acum_anterior")


def first_good_page(rows: DataFrame) -> DataFrame:
    """Keep rows of the lowest page per (file, disease) that produced any row (EXT6)."""
    w = Window.partitionBy("file", "enfermedad")
    return rows.withColumn("_p", F.min("page").over(w)).where(F.col("page") == F.col("_p")).drop("_p")


def missing_diseases(files: DataFrame, config: DataFrame, extracted: DataFrame) -> DataFrame:
    """(file, disease, optional) pairs with no extracted row (EXT7)."""
    want = files.select("file").distinct().crossJoin(F.broadcast(config.select(F.col("name").alias("enfermedad"),
                                                                                 "optional")))
    got = extracted.select("file", "enfermedad").distinct()
    return want.join(got, ["file", "enfermedad"], "left_anti")


def quarantine(pages: DataFrame, config: DataFrame, entity_names: list[str]) -> DataFrame:
    """Matched (file, page, disease) whose grid produced no row: malformed or
    short grids end up here instead of failing the job (EXT8)."""
    cfg = config.select(F.col("name").alias("enfermedad"), "cie10", "page_kw", "require_kw")
    matched = matching_pages(pages, cfg)
    parsed = block_rows(matched, entity_names).select("file", "page", "enfermedad").distinct()
    keys = ["file", "page", "enfermedad"]
    return matched.select(*keys).join(parsed, keys, "left_anti")


def extract(pages: DataFrame, config: DataFrame, entity_names: list[str], year_pattern: str = YEAR_TEXT,
            week_pattern: str = WEEK_TEXT, file_year_pattern: str = YEAR_FILE,
            file_week_pattern: str = WEEK_FILE) -> DataFrame:
    """Pages -> raw long bulletin rows in ``OUTPUT_COLUMNS`` (EXT1-8)."""
    cfg = config.select(F.col("name").alias("enfermedad"), "cie10", "page_kw", "require_kw")
    matched = matching_pages(pages, cfg)
    rows = first_good_page(block_rows(matched, entity_names))
    issue = issue_year_week(pages, year_pattern, week_pattern, file_year_pattern, file_week_pattern)
    return rows.join(issue, "file", "left").select(*OUTPUT_COLUMNS, "file", "page")
