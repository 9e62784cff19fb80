"""Bulletin page extraction (EXT1-8) on hand-made pages with the format's traps."""

from pyspark.sql import functions as F

from sentinela.operators.bulletin import extract, issue_year_week, missing_diseases
from sentinela.sources.literal import ENTITIES, disease_config

KW = " ENTIDAD FEDERATIVA "


def _pages(spark):
    e = ""
    header = ["ENTIDAD", "Varicela B01", e, e, e, "Escarlatina ª38", e, e, e]
    data_hf = [
        "Aguascalientes 1 234\nBaja California Sur 7\nBaja California n.d.\nTOTAL 99",
        e, "10 20\n3 4\n5 6\n0 0", e, "30\n40\n50\n0",
        "2\n-\n1\n0", "1 1\n2 2\n\n0 0", e, "9\n8\n7\n0"]
    grid_mf = [header, [e] * 9, [e] * 9, [e, "M", "F", e, e, e, "M", "F", e], data_hf]
    grid_hm = [header, [e] * 9, [e] * 9, [e, "H", "M", e, e, e, "H", "M", e], data_hf]
    rows = [
        # file 1: year/week from page-1 text, table on page 1, [M, F] labels
        ("boletin_sem23_2020.pdf", 1, "Número 23 | Semana 23 | del 2020" + KW + "Varicela B01 Escarlatina A38", grid_mf),
        # file 2: page 1 matches but its grid is too short; the table is on page 2; year/week from file name
        ("bol-2025-sem07.pdf", 1, "Portada" + KW + "Varicela B01", [header, [e] * 9]),
        ("bol-2025-sem07.pdf", 2, "Cuadro" + KW + "Varicela B01 Escarlatina A38", grid_hm),
        ("bol-2025-sem07.pdf", 3, "Cuadro" + KW + "Varicela B01", grid_hm),  # later page: ignored
        # file 3: text lacks the required keywords: nothing extracted
        ("bol-2026-sem01.pdf", 1, "Varicela B01 sin tabla", grid_hm),
    ]
    return spark.createDataFrame(rows, "file string, page int, text string, grid array<array<string>>")


def test_extract_blocks(spark):
    cfg = disease_config(spark).where(F.col("name").isin("Varicela", "Escarlatina"))
    out = extract(_pages(spark), cfg, ENTITIES)
    got = {(r.file, r.enfermedad, r.entidad_federativa, r.sexo):
           (r.anio, r.semana, r.casos_semana, r.casos_acumulado, r.casos_acum_anterior, r.cie10) for r in out.collect()}
    f1 = "boletin_sem23_2020.pdf"
    # primary block (header at column 1): weekly count follows the state name; NBSP thousands
    assert got[(f1, "Varicela", "Aguascalientes", "M")] == (2020, 23, 1234, 10, 30, "B01")
    assert got[(f1, "Varicela", "Aguascalientes", "F")] == (2020, 23, 1234, 20, 30, "B01")
    # longest prefix: 'Baja California Sur' is not read as 'Baja California'
    assert got[(f1, "Varicela", "Baja California Sur", "M")][2:4] == (7, 3)
    assert got[(f1, "Varicela", "Baja California", "F")][2:4] == (0, 6)  # 'n.d.' -> 0
    # second block (header 'ª38' at column 5): weekly count from its own column; '-' -> 0; blank line skipped
    assert got[(f1, "Escarlatina", "Aguascalientes", "M")] == (2020, 23, 2, 1, 9, "A38")
    assert got[(f1, "Escarlatina", "Baja California Sur", "F")] == (2020, 23, 0, 2, 8, "A38")
    # line 3 has no hm line after the blank was dropped: zeros
    assert got[(f1, "Escarlatina", "Baja California", "M")][3] == 0
    # file 2: first good page is page 2, year and week from the file name, [H, M] labels
    f2 = "bol-2025-sem07.pdf"
    assert got[(f2, "Varicela", "Aguascalientes", "H")][:2] == (2025, 7)
    assert {k[3] for k in got if k[0] == f2} == {"H", "M"}
    assert not any(k[0] == "bol-2026-sem01.pdf" for k in got)
    assert len(got) == 2 * 2 * 3 * 2  # two files x two diseases x three states x two sexes


def test_issue_and_missing(spark):
    pages = _pages(spark)
    iw = {r.file: (r.anio, r.semana) for r in issue_year_week(pages).collect()}
    assert iw["bol-2026-sem01.pdf"] == (2026, 1)
    cfg = disease_config(spark)
    out = extract(pages, cfg.where(F.col("name").isin("Varicela", "Escarlatina")), ENTITIES)
    miss = missing_diseases(pages, cfg, out).collect()
    f2 = {(r.enfermedad, r.optional) for r in miss if r.file == "bol-2025-sem07.pdf"}
    assert f2 == {("Sarampion", True), ("Rubeola", False), ("Erisipela", False)}


def test_quarantine_lists_unparsable_pages(spark):
    from sentinela.operators.bulletin import quarantine
    pages = _pages(spark)
    cfg = disease_config(spark).where(F.col("name").isin("Varicela", "Escarlatina"))
    q = {(r.file, r.page, r.enfermedad) for r in quarantine(pages, cfg, ENTITIES).collect()}
    # the cover page matched the keywords but its grid had no data row
    assert ("bol-2025-sem07.pdf", 1, "Varicela") in q
    assert not any(f == "boletin_sem23_2020.pdf" for f, _, _ in q)
