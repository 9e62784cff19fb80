"""Entries A-C, readers, streaming and sinks on small CSV fixtures."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from sentinela.plans import entries as P
from sentinela.sinks.writers import replace_partitions, round_trip_ok
from sentinela.sources import literal as L
from sentinela.sources import surveillance as S
from sentinela.streaming.incremental import start_counts


def _write(path, text, bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def _linelist(tmp):
    rnd = random.Random(0)
    files = {}
    for year in (2020, 2021):
        cols = ["FECHA_ACTUALIZACION", "ENTIDAD_RES", "DIAGNOSTICO", "VACUNACION", "FECHA_DIAGNOSTICO"]
        if year == 2020:
            cols.append("COMPLICACIONES")
        lines = [",".join(cols)]
        for _ in range(900):
            ent = rnd.choice([9, 14, 19, 5])
            m = rnd.randint(1, 12)
            diag = rnd.choice([f"{year}-{m:02d}-{rnd.randint(1, 28):02d}"] * 8 + ["9999-99-99", "9999/99/99"])
            row = [f"{year}-12-20", str(ent), rnd.choice(["1", "3", "0", ""]), rnd.choice(["1", "2"]), diag]
            if year == 2020:
                row.append(rnd.choice(["1", "2"]))
            lines.append(",".join(row))
        name = f"linelist_{year}.csv"
        _write(f"{tmp}/{name}", "\n".join(lines) + "\n")
        files[year] = name
    return files


def test_case_labels(spark, tmp_dir):
    files = _linelist(tmp_dir)
    ll = S.load_case_linelist(spark, tmp_dir, files)
    assert "COMPLICACIONES" in ll.columns and ll.where("anio_fuente = 2021 AND COMPLICACIONES IS NOT NULL").count() == 0
    pending = ll.where("FECHA_DIAGNOSTICO IS NULL").select("anio_mes_dt").distinct().collect()
    assert {r.anio_mes_dt for r in pending} <= {dt.date(2020, 12, 1), dt.date(2021, 12, 1)}
    out = P.case_labels(ll, L.host_entities(spark), n_trees=30).toPandas()
    assert list(out.columns) == P.TARGET_COLUMNS
    assert set(out["ENTIDAD_RES"]) == {9, 14, 19}
    assert len(out) == len(out[["ENTIDAD_RES", "anio_mes_dt"]].drop_duplicates())
    assert (out["brote_estricto"] <= out["brote"]).all()
    assert ((out["db_label"] == -1) == out["anomalia_db"]).all()


def test_country_risk_and_panel(spark, tmp_dir):
    teams = [w for _, w in L.COUNTRY_ALIAS] + ["Germany"]
    meas = ['"Region";"Country";"ISO3";"Year";"Month";"Measles\ntotal"']
    rnd = random.Random(1)
    for c in teams:
        for y in range(2017, 2025):
            for m in range(1, 13):
                meas.append(f'"R";"{c}";"XXX";"{y}";"{m}";"{rnd.choice(["0", "3", "12", "x"])}"')
    _write(f"{tmp_dir}/who.csv", "\n".join(meas) + "\n", bom=True)
    vax = ['Entity,Code,Year,"Measles, first dose (MCV1)"'] + [
        f"{c},XXX,{y},{rnd.uniform(70, 99):.1f}" for c in teams for y in range(2017, 2024)]
    _write(f"{tmp_dir}/vax.csv", "\n".join(vax) + "\n")
    att = ["Date,Time,Home,Away,Attendance,Venue"] + [
        f'2022-11-2{i},18:00,{a},{b},"{rnd.randint(40, 88)},{rnd.randint(100, 999)}",X'
        for i, (a, b) in enumerate([("Mexico", "Japan"), ("Spain", "South Korea"), ("Tunisia", "Uruguay")])]
    _write(f"{tmp_dir}/att.csv", "\n".join(att) + "\n")
    hist = ["year,home_team,away_team,home_score,away_score,date"] + [
        f"1998,{a},{b},1,0,1998-06-1{i}" for i, (a, b) in enumerate([("Mexico", "Spain"), ("Japan", "Mexico")])]
    _write(f"{tmp_dir}/hist.csv", "\n".join(hist) + "\n")
    measles = S.load_who_measles(spark, f"{tmp_dir}/who.csv")
    assert "measles_total" in measles.columns and "Region" in measles.columns
    risk = P.country_risk_table(measles, S.load_vaccination(spark, f"{tmp_dir}/vax.csv"),
                                S.load_attendance(spark, f"{tmp_dir}/att.csv"),
                                S.load_matches_history(spark, f"{tmp_dir}/hist.csv"), L.fixtures(spark),
                                L.country_alias(spark), L.PLACEHOLDER_TEAMS, n_init=3).toPandas()
    assert len(risk) == 9
    assert risk["score_riesgo_norm"].min() == 0.0 and risk["score_riesgo_norm"].max() == 10.0
    main = dict(zip(risk["Country"], risk["ciudad_sede"]))
    assert main["Mexico"] == "CDMX" and main["Tunisia"] == "Monterrey" and main["Colombia"] == "CDMX"
    assert dict(zip(risk["Country"], risk["partidos_en_mexico"]))["Mexico"] == 3
    # monthly panel from the label table of the previous pipeline on fresh fixtures
    files = _linelist(tmp_dir)
    target = P.case_labels(S.load_case_linelist(spark, tmp_dir, files), L.host_entities(spark), n_trees=20)
    pax = ["anio,mes,pasajeros_nacionales,pasajeros_internacionales"]
    fl = ["anio,mes,operaciones_vuelos_nacionales,operaciones_vuelos_internacionales"]
    from sentinela.functions.calendar import SPANISH_MONTHS
    for y in (2020, 2021):
        for i, m in enumerate(SPANISH_MONTHS):
            pax.append(f"{y}, {m.upper()} ,{rnd.randint(10, 99)},{rnd.randint(10, 99)}")
            fl.append(f"{y},{m},{rnd.randint(1, 9)},{rnd.randint(1, 9)}")
    _write(f"{tmp_dir}/pax.csv", "\n".join(pax) + "\n")
    _write(f"{tmp_dir}/fl.csv", "\n".join(fl) + "\n")
    passengers = S.load_monthly_counts(spark, f"{tmp_dir}/pax.csv", ["pasajeros_nacionales", "pasajeros_internacionales"])
    flights = S.load_monthly_counts(spark, f"{tmp_dir}/fl.csv",
                                    ["operaciones_vuelos_nacionales", "operaciones_vuelos_internacionales"])
    panel = P.monthly_panel(target, spark.createDataFrame(risk[["score_riesgo_norm"]]), [], passengers, flights,
                            crop=("2020-01-01", "2021-12-01"))
    cols = panel.columns
    assert "casos_confirmados_CDMX" in cols and "brote_estricto_Nuevo León (Mty)" in cols
    assert sum(c.startswith("pax_intl_lag") for c in cols) == 3
    assert panel.count() == 24


def test_streaming_counts_incremental(spark, tmp_dir):
    land, out, ck = f"{tmp_dir}/landing", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    hdr = "ENTIDAD_RES,DIAGNOSTICO,VACUNACION,COMPLICACIONES,FECHA_DIAGNOSTICO,FECHA_ACTUALIZACION\n"
    _write(f"{land}/a.csv", hdr + "9,1,1,2,2021-01-05,2021-02-01\n9,3,2,2,9999-99-99,2021-02-01\n")
    q = start_counts(spark, land, out, ck)
    q.awaitTermination()
    first = {(r.ENTIDAD_RES, str(r.anio_mes_dt)): r.total_registros for r in spark.read.parquet(out).collect()}
    assert first == {(9, "2021-01-01"): 1, (9, "2021-02-01"): 1}
    _write(f"{land}/b.csv", hdr + "9,1,1,1,2021-01-20,2021-02-01\n14,0,2,2,2021-03-03,2021-04-01\n")
    q = start_counts(spark, land, out, ck)
    q.awaitTermination()
    second = {(r.ENTIDAD_RES, str(r.anio_mes_dt)): (r.total_registros, r.casos_confirmados, r.tasa_confirmacion)
              for r in spark.read.parquet(out).collect()}
    assert second[(9, "2021-01-01")] == (2, 2, 1.0)  # a.csv was not read twice
    assert second[(14, "2021-03-01")] == (1, 0, 0.0)


def test_replace_partition_and_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(y, i, float(i)) for y in (2019, 2020, 2021) for i in range(5)],
                               "anio int, i int, v double")
    path = f"{tmp_dir}/t"
    df.write.partitionBy("anio").parquet(path)
    replace_partitions(df.where("anio = 2020").withColumn("v", F.col("v") + 100), path, ["anio"])
    back = spark.read.parquet(path)
    assert back.count() == 15 and back.where("anio = 2020 AND v >= 100").count() == 5
    assert back.where("anio = 2019 AND v < 100").count() == 5
    df.write.mode("overwrite").parquet(f"{tmp_dir}/rt")
    assert round_trip_ok(spark, df, f"{tmp_dir}/rt")


def test_city_risk_projection(spark):
    rows = [(dt.date(y, m, 1), 1_430_000) for y in range(2022, 2026) for m in (6, 7)]
    pax = spark.createDataFrame(rows, "fecha date, pasajeros_internacionales long")
    risk = spark.createDataFrame([("CDMX", 10.0), ("Guadalajara", 4.0), ("Guadalajara", 6.0), (None, 1.0)],
                                 "ciudad_sede string, score_riesgo_norm double")
    target = spark.createDataFrame([("CDMX", dt.date(2023, 6, 1), 4), ("CDMX", dt.date(2023, 7, 1), 6),
                                    ("Jalisco (Gdl)", dt.date(2024, 6, 1), 1), ("CDMX", dt.date(2021, 6, 1), 99)],
                                   "sede string, anio_mes_dt date, casos_confirmados int")
    proj, idx = P.city_risk_projection(target, risk, pax, L.sede_table(spark))
    assert proj.first().pax_proyectado_M == 1.93
    got = {r.sede: r for r in idx.collect()}
    assert got["CDMX"].score_riesgo_equipos == 10.0 and got["Jalisco (Gdl)"].score_riesgo_equipos == 5.0
    assert got["Nuevo León (Mty)"].score_riesgo_equipos == pytest.approx(21.0 / 4)  # overall mean fallback
    assert got["CDMX"].baseline_casos_jun_jul == 5.0
    assert {r.indice_riesgo_norm for r in got.values()} >= {0.0, 10.0}


def test_best_k(spark):
    from pyspark.ml.linalg import Vectors
    from sentinela.operators.cluster import best_k
    pts = [(Vectors.dense([c * 10.0 + i * 0.01, 0.0]),) for c in range(3) for i in range(10)]
    out = {r.k: r for r in best_k(spark.createDataFrame(pts, ["features"]), [2, 3, 4], n_init=2).collect()}
    assert out[3].mejor and out[3].silhouette > out[2].silhouette
