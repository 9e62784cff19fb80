"""Command-line runs of the two batch entries.

    python -m sentinela.plans.run make-data --raw RAW_DIR --out OUT_DIR
    python -m sentinela.plans.run bulletin --pages PAGES_PATH --out OUT_DIR
    python -m sentinela.plans.run bulletin-stream --pages LANDING_DIR --out OUT_DIR
    python -m sentinela.plans.run replace-year --pages PAGES_PATH --out OUT_DIR --year YEAR

``make-data`` reads the raw surveillance files and writes the three
processed tables (entity x month labels, country risk, monthly panel) as
Parquet and CSV. ``bulletin`` turns decoded bulletin pages into the weekly
fact table. ``bulletin-stream`` reads the pages that have landed since its last run
into raw rows, missing diseases and quarantined pages. ``replace-year`` extracts
one year anew, corrects its new cases and commits it to the versioned fact table. Paths may be on any Hadoop-compatible file system; on a cluster
``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.operators.risk import seasonal_split, seasonal_weights
from sentinela.plans import entries as P
from sentinela.sinks.snapshots import replace_version
from sentinela.sinks.writers import save_table
from sentinela.sources import literal as L
from sentinela.sources import surveillance as S
from sentinela.streaming.bulletins import run_available

# Raw file names of the surveillance inputs (spreadsheets are
# expected as CSV exports with the same stem).
LINELIST_FILES = {
    2020: "2020_efes_abierto_281220.csv", 2021: "2021_efes_abierto_271221.csv",
    2022: "2022_efes_abierto_261222.csv", 2023: "2023_efes_abierto_271223.csv",
    2024: "2024_efes_abierto_301024.csv", 2025: "2025_efes_abierto_171225.csv",
    2026: "2026_efes_abierto_090326.csv",
}
MEASLES_FILES = ["WHO_Provisional_measles_and_rubella_data.csv"]
VACCINATION_FILES = ["WHO_vaccination-coverage.csv"]
ATTENDANCE_FILES = ["Attendance Sheet.csv", "Qatar 2022 FIFA World Cup Attendance.csv"]
HISTORY_FILES = ["wcmatches.csv"]
PASSENGER_FILES = ["Movimiento_operacional_de_pasajeros_de_AICM.csv"]
TERMINAL_FILES = ["Movimiento_operacional_de_pasajeros_por_terminal.csv"]
FLIGHT_FILES = ["Movimiento_operacional_de_vuelos.csv"]
CITY_ARRIVAL_FILES = ["Llegadas_internacionales_cdmx_mensual.csv"]
ANNUAL_ARRIVAL_FILES = ["Llegadas_aeropuerto_Extranjeros(Hoja3).csv"]
HOST_COUNTRY = "Mexico"
PANEL_CROP = ("2020-01-01", "2025-12-01")


def city_proxy(annual: DataFrame, passengers: DataFrame) -> DataFrame:
    """Monthly international arrivals of a city from its annual total and the
    national monthly seasonality (TS7)."""
    w = seasonal_weights(passengers.select("fecha", "pasajeros_internacionales"), "fecha",
                         "pasajeros_internacionales")
    return seasonal_split(annual.select("anio", "pax_internacionales"), "anio", "pax_internacionales", w,
                          out="pax_intl_mty")


def make_data(spark: SparkSession, raw: str, out: str, n_init: int = 30) -> dict[str, dict[str, str]]:
    """Entry A: the three processed tables, written with ``save_table``."""
    find = lambda names: S.first_existing(spark, raw, names)
    linelist = S.load_case_linelist(spark, raw, LINELIST_FILES)
    measles = S.load_who_measles(spark, find(MEASLES_FILES))
    vax = S.load_vaccination(spark, find(VACCINATION_FILES))
    attendance = S.load_attendance(spark, find(ATTENDANCE_FILES))
    history = S.load_matches_history(spark, find(HISTORY_FILES))
    passengers = S.load_monthly_counts(spark, find(PASSENGER_FILES),
                                       ["pasajeros_nacionales", "pasajeros_internacionales"])
    terminal = S.load_terminal(spark, find(TERMINAL_FILES))
    flights = S.load_monthly_counts(spark, find(FLIGHT_FILES),
                                    ["operaciones_vuelos_nacionales", "operaciones_vuelos_internacionales"])
    national = S.national_series(measles, HOST_COUNTRY, "casos_who_mexico")
    city = S.load_city_arrivals(spark, find(CITY_ARRIVAL_FILES))
    proxy = city_proxy(S.load_annual_arrivals(spark, find(ANNUAL_ARRIVAL_FILES)), passengers)

    target = P.case_labels(linelist, L.host_entities(spark))
    risk = P.country_risk_table(measles, vax, attendance, history, L.fixtures(spark), L.country_alias(spark),
                                L.PLACEHOLDER_TEAMS, n_init=n_init)
    # SRT1: output order as published (sorted only at the sink: a range shuffle of small tables)
    target = target.orderBy("ENTIDAD_RES", "anio_mes_dt")
    risk = risk.orderBy(F.desc("score_riesgo_norm"), F.asc("Country"))
    written = {"efes_mensual_sedes_target": save_table(target, "efes_mensual_sedes_target", out)}
    written["paises_cluster_riesgo"] = save_table(risk, "paises_cluster_riesgo", out)
    # later stages read the written tables back: lineage is cut at the sink
    target_back = spark.read.parquet(written["efes_mensual_sedes_target"]["parquet"])
    risk_back = spark.read.parquet(written["paises_cluster_riesgo"]["parquet"])
    panel = P.monthly_panel(target_back, risk_back, [terminal, national, city, proxy], passengers, flights,
                            crop=PANEL_CROP)
    written["panel_mensual_completo"] = save_table(panel.orderBy("fecha"), "panel_mensual_completo", out)
    return written


def bulletin(spark: SparkSession, pages_path: str, out: str, fmt: str = "parquet") -> dict[str, dict[str, str]]:
    """Entry B: decoded pages -> raw rows -> weekly fact table, partitioned by year."""
    pages = S.read_bulletin_pages(spark, pages_path, fmt)
    raw, fact = P.bulletin_etl(pages, L.disease_config(spark), L.ENTITIES)
    return {"boletin_raw": save_table(raw, "boletin_raw", out),
            "boletin_fact": save_table(fact, "boletin_fact", out, partition_by=["anio"])}


#: What a year must fulfil to be committed.
FACT_RULES = {"semana_fuera_rango": "NOT semana BETWEEN 1 AND 53", "acumulado_negativo": "casos_acumulado < 0", "sexo_invalido": "sexo NOT IN ('H', 'M')"}


def replace_year(spark: SparkSession, pages_path: str, out: str, year: int, fmt: str = "parquet") -> tuple[int, dict[str, int]]:
    """Extract a year's pages again, correct its new cases and replace it in the
    versioned fact table by one commit (SNK4, TRF6, DQ1): (version, rule counts).
    A year that breaks a rule is not committed."""
    pages = S.read_bulletin_pages(spark, pages_path, fmt)
    _, fact = P.bulletin_etl(pages, L.disease_config(spark), L.ENTITIES)
    corrected = P.correction_pass(fact.where(F.col("anio") == year))
    return replace_version(corrected, f"{out.rstrip('/')}/boletin_fact_versions", ["anio"],
                           {name: F.expr(rule) for name, rule in FACT_RULES.items()}, strict=True)


def main(argv: list[str] | None = None) -> None:
    from sentinela.session import get_session

    ap = argparse.ArgumentParser(prog="sentinela")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("make-data")
    a.add_argument("--raw", required=True)
    a.add_argument("--out", required=True)
    b = sub.add_parser("bulletin")
    b.add_argument("--pages", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--format", default="parquet", choices=["parquet", "json"])
    for name in ("bulletin-stream", "replace-year"):
        c = sub.add_parser(name)
        c.add_argument("--pages", required=True)
        c.add_argument("--out", required=True)
        if name == "replace-year":
            c.add_argument("--year", required=True, type=int)
            c.add_argument("--format", default="parquet", choices=["parquet", "json"])
    args = ap.parse_args(argv)
    spark = get_session()
    if args.cmd == "bulletin-stream":
        run_available(spark, args.pages, args.out, L.disease_config(spark), L.ENTITIES)
        return
    if args.cmd == "replace-year":
        print(*replace_year(spark, args.pages, args.out, args.year, args.format))
        return
    res = make_data(spark, args.raw, args.out) if args.cmd == "make-data" else bulletin(
        spark, args.pages, args.out, args.format)
    for name, paths in res.items():
        print(name, paths["parquet"], paths["csv"])


if __name__ == "__main__":
    main()
