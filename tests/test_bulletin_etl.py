"""Entry B end to end on hand-made pages: extract -> checkpoint -> transform,
then the coverage report and the correction pass."""

from pyspark.sql import functions as F

from sentinela.plans import entries as P
from sentinela.sources.literal import disease_config

KW = " ENTIDAD FEDERATIVA Varicela B01"
STATES = ["Aguascalientes", "Baja California", "Baja California Sur"]


def _page(spark, weeks):
    e = ""
    header = ["ENTIDAD", "Varicela B01", e, e, e]
    rows = []
    for y, w, cum in weeks:
        data = ["\n".join(f"{s} {w}" for s in STATES), e, "\n".join(f"{cum + i} {cum}" for i in range(3)), e,
                "\n".join("5" for _ in STATES)]
        sex = [e, "M", "F", e, e] if y <= 2020 else [e, "H", "M", e, e]
        rows.append((f"bol-{y}-sem{w:02d}.pdf", 1, f"Semana {w} del {y}" + KW, [header, [e] * 5, [e] * 5, sex, data]))
    return spark.createDataFrame(rows, "file string, page int, text string, grid array<array<string>>")


def test_bulletin_etl_end_to_end(spark):
    pages = _page(spark, [(2020, 1, 4), (2020, 2, 9), (2020, 3, 7), (2021, 1, 2), (2021, 3, 6)])
    cfg = disease_config(spark).where(F.col("name") == "Varicela")
    raw, fact = P.bulletin_etl(pages, cfg, STATES)
    assert raw.count() == 5 * 3 * 2
    # 2020 files used M/F: recoded to H/M, so only H and M remain
    assert {r.sexo for r in fact.select("sexo").distinct().collect()} == {"H", "M"}
    f = fact.toPandas()
    # grid = years {2020, 2021} x weeks {1, 2, 3} x 3 states x 1 disease x 2 sexes
    assert len(f) == 2 * 3 * 3 * 1 * 2
    assert (f["casos_nuevos"] >= 0).all() and f["cie10"].eq("B01").all()
    ags_h = f[(f.entidad_federativa == "Aguascalientes") & (f.sexo == "H") & (f.anio == 2020)].sort_values("semana")
    # first week: half of the weekly figure (1 -> 0 by half-even), then differences clipped at 0
    assert list(ags_h["casos_acumulado"]) == [4, 9, 7]
    assert list(ags_h["casos_nuevos"]) == [0, 5, 0]
    # the unpublished week 2 of 2021 is a zero row of the grid
    w2 = f[(f.anio == 2021) & (f.semana == 2)]
    assert (w2["casos_acumulado"] == 0).all()
    both = f[(f.anio == 2020) & (f.semana == 1) & (f.entidad_federativa == "Aguascalientes")]
    assert set(both["casos_ambos_sexos"]) == {4 + 4}
    corrected = P.correction_pass(fact, "full").toPandas()
    c = corrected[(corrected.entidad_federativa == "Aguascalientes") & (corrected.sexo == "H")
                  & (corrected.anio == 2020)].sort_values("semana")
    assert list(c["casos_nuevos"]) == [1, 5, 0]
    tables = P.coverage_tables(fact, required=1)
    cov = {r.anio: (r.semanas, r.entidades) for r in tables["cobertura"].collect()}
    assert cov == {2020: (3, 3), 2021: (3, 3)}
    flags = {(r.anio, r.semana): r.con_datos for r in tables["semanas"].collect()}
    assert flags[(2021, 2)] is False and flags[(2020, 1)] is True
    assert tables["pico"].columns == ["anio", "casos_acumulado_Varicela"]
