"""Incremental bulletins and the replaced year."""

from sentinela.operators.bulletin import extract
from sentinela.plans import run as R
from sentinela.sinks.snapshots import read_version, versions
from sentinela.sources.literal import ENTITIES, disease_config
from sentinela.streaming.bulletins import PAGES, process_batch, read_table, run_available

E = ""
HEADER = ["ENTIDAD", "Varicela B01", E, E, E, "Escarlatina ª38", E, E, E]


def pages(spark, weeks, cum="10 12\n4 5", year=2025):
    data = ["Sonora 3\nSinaloa 1", E, cum, E, "20\n9", "2\n1", "1 1\n0 0", E, "3\n3"]
    rows = [(f"bol-{year}-sem{w:02d}.pdf", p, f"Semana {w} del {year} ENTIDAD FEDERATIVA Varicela B01 Escarlatina A38",
             [HEADER, [E] * 9, [E] * 9] + ([[E, "H", "M", E, E, E, "H", "M", E], data] if p == 2 else [])) for w in weeks for p in (1, 2)]
    return spark.createDataFrame(rows, PAGES)


def content(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


def test_runs_read_each_bulletin_once(spark, tmp_dir):
    config = disease_config(spark)
    landing, out = f"{tmp_dir}/landing", f"{tmp_dir}/out"
    assert read_table(spark, out, "ledger") is None
    pages(spark, [1, 2]).coalesce(1).write.mode("append").parquet(landing)
    run_available(spark, landing, out, config, ENTITIES)
    run_available(spark, landing, out, config, ENTITIES)  # nothing new
    first = {name: content(read_table(spark, out, name)) for name in ("rows", "missing", "quarantine", "ledger")}
    assert len(first["ledger"]) == 2 and len(first["rows"]) == 2 * 2 * 2 * 2
    assert len(first["missing"]) == 2 * 3 and len(first["quarantine"]) == 2 * 2  # three other diseases; page 1 matches both
    pages(spark, [2, 3]).coalesce(1).write.mode("append").parquet(landing)  # the second bulletin again
    run_available(spark, landing, out, config, ENTITIES)
    ledger = read_table(spark, out, "ledger")
    assert sorted((r.file, r.batch) for r in ledger.collect()) == [("bol-2025-sem01.pdf", 0), ("bol-2025-sem02.pdf", 0), ("bol-2025-sem03.pdf", 1)]
    want = extract(pages(spark, [1, 2, 3]), config, ENTITIES)
    assert content(read_table(spark, out, "rows").select(*want.columns)) == content(want)
    # a batch that is run again writes the same
    before = {name: content(read_table(spark, out, name)) for name in first}
    process_batch(pages(spark, [2, 3]), 1, out, config, ENTITIES)
    assert before == {name: content(read_table(spark, out, name)) for name in first}


def test_replace_year(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    pages(spark, [1, 2]).unionByName(pages(spark, [1], year=2024)).write.parquet(f"{tmp_dir}/pages")
    for year in (2024, 2025):
        _, counts = R.replace_year(spark, f"{tmp_dir}/pages", out, year)
        assert counts["n_filas"] == 2 * 32 * 5 * 2 and sum(counts.values()) == counts["n_filas"]
    path = f"{out}/boletin_fact_versions"
    fact = read_version(spark, path)
    pages(spark, [1, 2], cum="30 40\n4 5").write.parquet(f"{tmp_dir}/again")
    R.replace_year(spark, f"{tmp_dir}/again", out, 2025)
    now = read_version(spark, path)
    sonora = lambda df, year: df.where(f"anio = {year} AND entidad_federativa = 'Sonora' AND enfermedad = 'Varicela' AND sexo = 'M' AND semana = 1").first().casos_acumulado
    assert (sonora(fact, 2025), sonora(now, 2025), sonora(now, 2024)) == (12, 40, 12) and versions(spark, path) == [0, 1, 2]
