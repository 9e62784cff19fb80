"""Published values that need no raw data (FIXTURES.md 'Golden values')."""

import datetime as dt


from sentinela.operators import bulletin as B
from sentinela.operators.risk import scenario_projection
from sentinela.plans.entries import team_matches
from sentinela.sources import literal as L


def test_densified_grid_golden_size(spark):
    # 11 years (2016-2026) x 53 weeks observed, 32 entities x 5 diseases x 2 sexes
    rows = [(y, w, "Sonora", "Varicela", "H", 1, 1, 0) for y in range(2016, 2027) for w in range(1, 54)]
    raw = spark.createDataFrame(rows, "anio int, semana int, entidad_federativa string, enfermedad string, "
                                      "sexo string, casos_semana int, casos_acumulado int, casos_acum_anterior int")
    dense = B.densify(raw, L.ENTITIES, [d[0] for d in L.DISEASES], ["H", "M"], min_year=2000)
    assert dense.count() == 186_560


def test_projection_golden(spark):
    rows = [(dt.date(y, m, 1), 1.43e6) for y in range(2022, 2026) for m in (6, 7)]
    out = scenario_projection(spark.createDataFrame(rows, "fecha date, pax double"), "fecha", "pax", [6, 7],
                              (2022, 2025), 1.35).first()
    assert round(out.proyectado / 1e6, 2) == 1.93


def test_matches_by_team_and_city(spark):
    per_city, main = team_matches(L.fixtures(spark), L.PLACEHOLDER_TEAMS)
    pc = {(r.Country, r.ciudad): r.partidos_en_mexico for r in per_city.collect()}
    assert pc[("Mexico", "CDMX")] == 2 and pc[("Mexico", "Guadalajara")] == 1
    assert pc[("Tunisia", "Monterrey")] == 2
    assert not any(t in {c for c, _ in pc} for t in L.PLACEHOLDER_TEAMS)
    m = {r.Country: r.ciudad_sede for r in main.collect()}
    # ties have no rule in the source: (matches desc, city asc) picks CDMX for both
    assert m["Colombia"] == "CDMX" and m["South Africa"] == "CDMX"
    assert m["Mexico"] == "CDMX" and m["Tunisia"] == "Monterrey"
