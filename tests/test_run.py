"""`make-data` and `bulletin` runs on a raw folder of small fixture files."""

import os
import random

from sentinela.functions.calendar import SPANISH_MONTHS
from sentinela.plans import run as R
from sentinela.sources import literal as L


def _w(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def _raw(d):
    rnd = random.Random(4)
    for year, name in R.LINELIST_FILES.items():
        lines = ["FECHA_ACTUALIZACION,ENTIDAD_RES,DIAGNOSTICO,VACUNACION,COMPLICACIONES,FECHA_DIAGNOSTICO"]
        for _ in range(120):
            m = rnd.randint(1, 12)
            lines.append(f"{year}-12-01,{rnd.choice([9, 14, 19])},{rnd.choice([1, 3, 0])},1,2,"
                         f"{year}-{m:02d}-{rnd.randint(1, 28):02d}")
        _w(f"{d}/{name}", "\n".join(lines) + "\n")
    teams = [w for _, w in L.COUNTRY_ALIAS]
    meas = ['"Country";"Year";"Month";"Measles\ntotal"'] + [
        f'"{c}";"{y}";"{m}";"{rnd.randint(0, 20)}"' for c in teams for y in range(2018, 2026) for m in range(1, 13)]
    _w(f"{d}/{R.MEASLES_FILES[0]}", "\n".join(meas) + "\n", bom=True)
    _w(f"{d}/{R.VACCINATION_FILES[0]}", "\n".join(['Entity,Code,Year,"Measles, first dose (MCV1)"'] + [
        f"{c},X,{y},{rnd.uniform(80, 99):.1f}" for c in teams for y in range(2018, 2024)]) + "\n")
    _w(f"{d}/{R.ATTENDANCE_FILES[0]}", 'Date,Time,Home,Away,Attendance,Venue\n1,1,Mexico,Japan,"80,100",X\n')
    _w(f"{d}/{R.HISTORY_FILES[0]}", "year,home_team,away_team,home_score,away_score,date\n1998,Mexico,Spain,1,0,1998-06-13\n")
    pax, fl, term = (["anio,mes,pasajeros_nacionales,pasajeros_internacionales"],
                     ["anio,mes,operaciones_vuelos_nacionales,operaciones_vuelos_internacionales"],
                     ["anio,mes,pasajeros_llegadas_internacionales_t1,pasajeros_llegadas_internacionales_t2"])
    city = ["fecha,ciudad_de_mexico"]
    for y in range(2019, 2027):
        for i, m in enumerate(SPANISH_MONTHS, 1):
            pax.append(f"{y},{m},{rnd.randint(100, 999)},{rnd.randint(100, 999)}")
            fl.append(f"{y},{m},{rnd.randint(1, 9)},{rnd.randint(1, 9)}")
            term.append(f"{y},{m},{rnd.randint(1, 9)},{'' if i == 3 else rnd.randint(1, 9)}")
            city.append(f"{y}-{i:02d}-28,{rnd.randint(10, 99)}")
    _w(f"{d}/{R.PASSENGER_FILES[0]}", "\n".join(pax) + "\n")
    _w(f"{d}/{R.FLIGHT_FILES[0]}", "\n".join(fl) + "\n")
    _w(f"{d}/{R.TERMINAL_FILES[0]}", "\n".join(term) + "\n")
    _w(f"{d}/{R.CITY_ARRIVAL_FILES[0]}", "\n".join(city) + "\n")
    _w(f"{d}/{R.ANNUAL_ARRIVAL_FILES[0]}", "a;b;c;d\n2019;1.000.000;2.400.000;3.400.000\n"
                                           "2020;900.000;1.200.000;2.100.000\n", bom=True)


def test_make_data(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    os.makedirs(raw)
    _raw(raw)
    res = R.make_data(spark, raw, out, n_init=2)
    target = spark.read.parquet(res["efes_mensual_sedes_target"]["parquet"])
    assert target.count() > 0 and set(target.columns) >= {"brote", "brote_estricto", "if_score", "db_label"}
    assert spark.read.parquet(res["paises_cluster_riesgo"]["parquet"]).count() == 9
    panel = spark.read.parquet(res["panel_mensual_completo"]["parquet"])
    cols = set(panel.columns)
    assert {"pax_intl_total", "casos_who_mexico", "intl_cdmx", "pax_intl_mty", "score_riesgo_equipos"} <= cols
    assert panel.where("intl_cdmx IS NOT NULL").count() > 0  # month-end dates truncated (Q1)
    mty = {str(r.fecha): r.pax_intl_mty for r in panel.select("fecha", "pax_intl_mty").collect()}
    assert sum(v for k, v in mty.items() if k.startswith("2020")) in range(1_199_990, 1_200_011)
    csv = spark.read.option("header", True).csv(res["panel_mensual_completo"]["csv"])
    assert csv.count() == panel.count()


def test_bulletin_run(spark, tmp_dir):
    e = ""
    header = ["ENTIDAD", "Varicela B01", e, e, e, "Escarlatina ª38", e, e, e]
    data = ["Sonora 3\nSinaloa 1", e, "10 12\n4 5", e, "20\n9", "2\n1", "1 1\n0 0", e, "3\n3"]
    rows = [(f"bol-2025-sem{w:02d}.pdf", 1, f"Semana {w} del 2025 ENTIDAD FEDERATIVA Varicela B01 Escarlatina A38",
             [header, [e] * 9, [e] * 9, [e, "H", "M", e, e, e, "H", "M", e], data]) for w in (1, 2)]
    pages = spark.createDataFrame(rows, "file string, page int, text string, grid array<array<string>>")
    pages.write.parquet(f"{tmp_dir}/pages")
    res = R.bulletin(spark, f"{tmp_dir}/pages", f"{tmp_dir}/out")
    fact = spark.read.parquet(res["boletin_fact"]["parquet"])
    # 1 year x 2 weeks x 32 entities x 5 diseases x 2 sexes
    assert fact.count() == 2 * 32 * 5 * 2
    son = fact.where("entidad_federativa = 'Sonora' AND enfermedad = 'Varicela' AND sexo = 'M' AND semana = 1").first()
    assert son.casos_acumulado == 12 and son.cie10 == "B01"
    assert os.path.isdir(f"{tmp_dir}/out/boletin_fact.parquet/anio=2025")
