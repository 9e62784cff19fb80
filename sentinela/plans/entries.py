"""End-to-end flows over the surveillance inputs (entries A, B, C).

Each function takes DataFrames and returns a lazy DataFrame (model fits and
bounded summaries excepted), so the whole chain can be one Spark plan or be
cut at a sink (``checkpoint_parquet``) where lineage gets long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.functions.calendar import in_calendar_window
from sentinela.operators import bulletin as B
from sentinela.operators.anomaly import combine_labels, dbscan_1d
from sentinela.operators.cluster import kmeans_best, preprocess
from sentinela.operators.counts import case_counts
from sentinela.operators.forest import isolation_forest
from sentinela.operators.joins import exclude_values, join_via_alias, top_per_group, unpivot_sides
from sentinela.operators.lagcorr import best_lag
from sentinela.operators.pivot import pivot_metrics
from sentinela.operators.quality import assert_unique
from sentinela.operators.risk import country_risk
from sentinela.operators.scaling import median_impute, standardize
from sentinela.operators.stats import coverage_stats, distinct_coverage, incidence_stats, trend_slope
from sentinela.sinks.writers import checkpoint_parquet

# Column names of the processed tables, as in their dictionary.
IF_FEATURES = ["casos_confirmados", "casos_sospechosos", "tasa_confirmacion", "total_registros"]
TARGET_COLUMNS = ["anio_mes", "anio_mes_dt", "ENTIDAD_RES", "sede", "casos_confirmados", "casos_sospechosos",
                  "casos_descartados", "total_registros", "vacunados", "con_complicaciones", "tasa_confirmacion",
                  "anomalia_if", "if_score", "anomalia_db", "db_label", "brote", "brote_estricto"]


# Columns of the country table, those filled with medians, those clustered.
COUNTRY_COLUMNS = ["Country", "Country_who", "ciudad_sede", "partidos_en_mexico", "asistencia_promedio", "partidos_historicos", "clasificado_2026",
                   "total_cases", "avg_monthly_cases", "months_with_cases", "mcv1_mean", "mcv1_min", "mcv1_tendencia", "cluster", "score_riesgo_norm"]
IMPUTED = ["total_cases", "avg_monthly_cases", "months_with_cases", "peak_month", "mcv1_mean", "mcv1_min",
           "mcv1_std", "mcv1_tendencia", "asistencia_promedio", "partidos_historicos", "partidos_en_mexico"]
CLUSTER_FEATURES = ["total_cases", "months_with_cases", "mcv1_mean", "mcv1_min", "mcv1_tendencia"]


# --------------------------------------------------------------- entry A.1

def case_labels(linelist: DataFrame, hosts: DataFrame, eps: float = 1.2, min_samples: int = 2,
                contamination: float = 0.10, n_trees: int = 100, seed: int = 42) -> DataFrame:
    """Entity x month counts of the host entities with outbreak labels
    (AGG1-2, ANO0-3): isolation forest on four standardised features per
    entity, 1-D DBSCAN on confirmed cases per entity, lax / strict union."""
    # CLN7 code -> label through a broadcast literal table; FLT2 membership (inner join keeps hosts)
    ll = linelist.join(F.broadcast(hosts), "ENTIDAD_RES")  # hosts: a few literal rows
    counts = case_counts(ll.withColumnRenamed("sede", "_sede"), "ENTIDAD_RES", "anio_mes_dt", "DIAGNOSTICO",
                         "VACUNACION", "COMPLICACIONES", entity_label=F.col("_sede"))
    counts = counts.withColumn("_rid", F.xxhash64("ENTIDAD_RES", "anio_mes_dt"))
    counts = checkpoint_parquet(counts, "case-counts")  # scanned once
    z = standardize(counts, IF_FEATURES, ["ENTIDAD_RES"])
    forest = isolation_forest(z, ["ENTIDAD_RES"], [c + "_z" for c in IF_FEATURES], "_rid", n_trees=n_trees,
                              contamination=contamination, seed=seed)
    labelled = dbscan_1d(forest.withColumn("_cc", F.coalesce(F.col("casos_confirmados"), F.lit(0))),
                         ["ENTIDAD_RES"], "_cc", "anio_mes_dt", eps, min_samples)
    return combine_labels(labelled, "anomalia_if", "anomalia_db").select(*TARGET_COLUMNS)


# --------------------------------------------------------------- entry A.2

def team_matches(fixtures: DataFrame, placeholders: list[str]) -> tuple[DataFrame, DataFrame]:
    """Matches per (team, city) and per team with its main city (FTR1)."""
    long = unpivot_sides(fixtures.select("ciudad", "home", "away"), ["ciudad"], ["home", "away"], "lado", "Country")
    per_city = exclude_values(long, "Country", placeholders).groupBy("Country", "ciudad").agg(
        F.count(F.lit(1)).alias("partidos_en_mexico"))
    main = top_per_group(per_city, ["Country"], [F.desc("partidos_en_mexico"), F.asc("ciudad")])
    totals = per_city.groupBy("Country").agg(F.sum("partidos_en_mexico").alias("partidos_en_mexico"))  # AGG8
    return per_city, main.select("Country", F.col("ciudad").alias("ciudad_sede")).join(totals, "Country")


def country_features(measles: DataFrame, vax: DataFrame, attendance: DataFrame, history: DataFrame, fixtures: DataFrame, alias: DataFrame,
                     placeholders, case_years: tuple[int, int] = (2018, 2024), vaccine_years: tuple[int, int] = (2018, 2023),
                     compat: bool = False) -> DataFrame:
    """One row per team of ``alias`` (Country, Country_who): matches, attendance,
    history, cases, coverage, gaps filled with the column's median, and the
    0-10 risk score (FTR1-4, JN2, CLN9, RSK1-2).

    Attendance and history may use either name of a country: both are mapped through
    the alias table. ``compat=True`` filters them on team names and joins them
    on surveillance names, as the reference does (Q2). The alias table must
    hold a team once; every other side is grouped on the key it is joined by, so no join fans out."""
    teams = alias.select("Country", "Country_who")
    assert_unique(teams, ["Country"])  # S5
    _, city = team_matches(fixtures, placeholders)
    att_long = unpivot_sides(attendance.select("Home", "Away", "Attendance"), ["Attendance"], ["Home", "Away"], "lado", "Country")
    hist_long = unpivot_sides(history.select("home_team", "away_team"), [], ["home_team", "away_team"], "lado", "Country")

    def by_who(long: DataFrame) -> DataFrame:
        if compat:
            return long.join(teams.select("Country"), "Country", "left_semi").withColumnRenamed("Country", "Country_who")
        return join_via_alias(long, teams, "Country", "Country_who")

    # AGG7 mean per group; AGG6 count per group
    att = by_who(att_long).groupBy("Country_who").agg(F.avg("Attendance").alias("asistencia_promedio"))
    hist = by_who(hist_long).groupBy("Country_who").agg(F.count(F.lit(1)).cast("int").alias("partidos_historicos"))
    # FLT3 inclusive ranges on plain columns (pushed to the scan)
    meas = incidence_stats(measles.where(F.col("Year").between(*case_years)), ["Country"], "measles_total").withColumnRenamed("Country", "Country_who")
    v = vax.where(F.col("Year").between(*vaccine_years))
    vstats = coverage_stats(v, ["Country"], "mcv1", "mcv1").join(trend_slope(v, ["Country"], "mcv1", "Year", out="mcv1_tendencia"), "Country", "left")
    vstats = vstats.withColumnRenamed("Country", "Country_who")
    t = (teams.withColumn("clasificado_2026", F.lit(1)).join(city, "Country", "left").join(att, "Country_who", "left").join(hist, "Country_who", "left")
         .join(meas, "Country_who", "left").join(vstats, "Country_who", "left"))
    # written once: the medians and the result read it
    t = checkpoint_parquet(t.withColumns({c: F.col(c).cast("double") for c in IMPUTED}), "country-features")
    t = median_impute(t, IMPUTED).withColumns({c: F.col(c).cast("int") for c in ("partidos_historicos", "partidos_en_mexico")})
    return country_risk(t, "total_cases", "mcv1_mean").select(*[c for c in COUNTRY_COLUMNS if c != "cluster"])


def country_risk_table(measles: DataFrame, vax: DataFrame, attendance: DataFrame, history: DataFrame,
                       fixtures: DataFrame, alias: DataFrame, placeholders, k: int = 4,
                       n_init: int = 30, compat: bool = False) -> DataFrame:
    """``country_features`` with a K-Means cluster, numbered from the highest mean
    risk score down (FTR4, CLU1-2)."""
    t = checkpoint_parquet(country_features(measles, vax, attendance, history, fixtures, alias, placeholders, compat=compat), "country-table")
    x = preprocess(t.select("Country", "score_riesgo_norm", *[F.col(c).alias(f"_f_{c}") for c in CLUSTER_FEATURES]), [f"_f_{c}" for c in CLUSTER_FEATURES],
                   log_cols=["_f_total_cases", "_f_months_with_cases"])
    _, pred, _ = kmeans_best(x.select("Country", "score_riesgo_norm", "features"), k, n_init=n_init, seed=42, order_by="score_riesgo_norm")
    return t.join(pred.select("Country", "cluster"), "Country", "left").select(*COUNTRY_COLUMNS)


# --------------------------------------------------------------- entry A.3

# The metrics spread over the host columns.
PANEL_METRICS = ["casos_confirmados", "casos_sospechosos", "total_registros", "tasa_confirmacion", "brote",
                 "brote_estricto"]


def monthly_panel(target: DataFrame, risk: DataFrame, series: list[DataFrame], passengers: DataFrame,
                  flights: DataFrame, lags: list[int] = list(range(7)), event_year: int = 2026,
                  event_months: list[int] = (6, 7), crop: tuple[str, str] | None = None,
                  x_col: str = "pasajeros_internacionales",
                  flights_col: str = "operaciones_vuelos_internacionales") -> DataFrame:
    """Wide monthly panel with the best-lag features per entity (TS1, TS4-6).

    The case metrics are pivoted to ``{metric}_{sede}`` (values passed
    explicitly), every monthly series is left-joined on ``fecha``, the mean
    team score is attached from a one-row aggregate, and the lag search runs
    on the long (sede, fecha) form, partitioned by sede. Its result has one
    row per sede (bounded) and names the lag columns. The lag columns shift
    over the panel's month rows, one row per month (bounded by the calendar)."""
    for table in (passengers, flights, *series):
        assert_unique(table, ["fecha"])  # S5: a repeated month would fan out
    target = checkpoint_parquet(target, "panel-target")  # read by the sede list, the pivot and the lag search
    sedes = sorted(r["sede"] for r in target.select("sede").distinct().collect())
    wide = pivot_metrics(target.withColumnRenamed("anio_mes_dt", "fecha"), ["fecha"], "sede", PANEL_METRICS, sedes,
                         name=lambda m, v: f"{m}_{v}")
    panel = wide.join(passengers, "fecha", "left").join(flights, "fecha", "left")
    for s in series:
        panel = panel.join(s, "fecha", "left")
    # AGG13: a one-row global mean attached to every month
    panel = panel.crossJoin(F.broadcast(risk.agg(F.avg("score_riesgo_norm").alias("score_riesgo_equipos"))))
    panel = panel.withColumns({"mes_num": F.month("fecha"),
                               "es_ventana_mundial": in_calendar_window("fecha", event_year, list(event_months))})
    long = target.select("sede", F.col("anio_mes_dt").alias("fecha"), "casos_confirmados").join(
        passengers.select("fecha", x_col), "fecha", "left")
    best = {r["sede"]: r["mejor_lag"] for r in best_lag(long, "sede", "fecha", x_col, "casos_confirmados", lags)
            .collect()}
    w = Window.orderBy("fecha")  # one row per month: bounded by the calendar
    for s in sedes:
        k = int(best.get(s, 1))
        panel = panel.withColumns({f"pax_intl_lag{k}_{s}": F.lag(x_col, k).over(w),
                                   f"vuelos_intl_lag{k}_{s}": F.lag(flights_col, k).over(w)})
    if crop:  # FLT4 date-range crop
        panel = panel.where(F.col("fecha").between(F.to_date(F.lit(crop[0])), F.to_date(F.lit(crop[1]))))
    return panel


# --------------------------------------------------------------- entry B

def bulletin_etl(pages: DataFrame, config: DataFrame, entities: list[str], cutoff_year: int = 2020,
                 min_year: int = 2000, first_period: str = "half", checkpoint: bool = True) -> tuple[DataFrame, DataFrame]:
    """Pages -> raw rows (checkpointed) -> fact table (EXT1-8, SNK3, TRF1-5).
    Returns (raw, fact)."""
    raw = B.extract(pages, config, entities)
    if checkpoint:
        raw = checkpoint_parquet(raw, "bulletin_raw")
    diseases = [r["name"] for r in config.select("name").collect()]  # a handful of config rows
    fact = B.transform(raw.drop("file", "page", "cie10"), entities, diseases, ["H", "M"], cutoff_year, min_year,
                       first_period)
    codes = F.broadcast(config.select(F.col("name").alias("enfermedad"), "cie10"))
    return raw, fact.join(codes, "enfermedad", "left")


def correction_pass(fact: DataFrame, first_period: str = "half") -> DataFrame:
    """Recompute new cases on a stored fact table (TRF6)."""
    base = fact.drop("casos_nuevos", "casos_nuevos_total")
    from sentinela.operators.windows import group_totals, new_from_cumulative
    out = new_from_cumulative(base, ["enfermedad", "entidad_federativa", "sexo", "anio"], "semana",
                              "casos_acumulado", "casos_semana", first_period)
    return group_totals(out, ["anio", "semana", "entidad_federativa", "enfermedad"],
                        {"casos_nuevos": "casos_nuevos_total"})


def coverage_tables(fact: DataFrame, required: int) -> dict[str, DataFrame]:
    """Coverage report (DQ2, AGG9-10, AGG12, AGG22)."""
    cov = fact.groupBy("anio").agg(F.count_distinct("semana").alias("semanas"),
                                   F.count_distinct("enfermedad").alias("enfermedades"),
                                   F.count_distinct("entidad_federativa").alias("entidades"))
    weeks = distinct_coverage(fact.where(F.col("casos_acumulado") > 0), ["anio", "semana"], "enfermedad", required)
    diseases = sorted(r["enfermedad"] for r in fact.select("enfermedad").distinct().collect())
    peak = pivot_metrics(fact, ["anio"], "enfermedad", ["casos_acumulado"], diseases, agg="max").fillna(0)
    flag = fact.groupBy("anio", "semana").agg(F.sum("casos_acumulado").alias("total")).withColumn(
        "con_datos", F.col("total") > 0)
    return {"cobertura": cov, "semanas_incompletas": weeks.where("incompleto"), "pico": peak, "semanas": flag}


# --------------------------------------------------------------- entry C

def city_risk_projection(target: DataFrame, risk: DataFrame, passengers: DataFrame, sedes: DataFrame,
                         months: list[int] = (6, 7), years: tuple[int, int] = (2022, 2025),
                         growth: float = 1.35) -> tuple[DataFrame, DataFrame]:
    """Scenario projection and composite city index (TS8, RSK3-5, AGG16).

    Returns (projection, index): the historic mean of monthly international
    passengers over the calendar window times ``growth``; and per host
    entity the matches, the mean team score (overall mean where a city has
    no team, Q14), the window's mean confirmed cases (1 decimal), the
    weighted index normalised to 0-10 and share-of-max components."""
    from sentinela.operators.risk import composite_index, scenario_projection

    proj = scenario_projection(passengers, "fecha", "pasajeros_internacionales", list(months), years, growth)
    proj = proj.withColumn("pax_proyectado_M", F.bround(F.col("proyectado") / 1e6, 2))  # SCL16, SCL10
    scores = risk.select("ciudad_sede", "score_riesgo_norm")
    per_city = scores.where(F.col("ciudad_sede").isNotNull()).groupBy("ciudad_sede").agg(
        F.avg("score_riesgo_norm").alias("_m"))
    overall = scores.agg(F.avg("score_riesgo_norm").alias("_g"))
    d = F.col("anio_mes_dt")
    base = (target.where(F.month(d).isin(list(months)) & F.year(d).between(*years)).groupBy("sede")
            .agg(F.bround(F.avg("casos_confirmados"), 1).alias("baseline_casos_jun_jul")))
    t = (sedes.join(per_city, "ciudad_sede", "left").crossJoin(F.broadcast(overall))
         .withColumn("score_riesgo_equipos", F.coalesce("_m", "_g")).drop("_m", "_g")
         .join(base, "sede", "left").fillna(0.0, subset=["baseline_casos_jun_jul"]))  # CLN8
    return proj, composite_index(t, "partidos_en_sede", "score_riesgo_equipos", "baseline_casos_jun_jul")
