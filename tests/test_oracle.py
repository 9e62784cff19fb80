"""Every registered query with oracle SQL agrees with DuckDB on the sf0.001
tables; queries without SQL run and return a stable schema."""

import duckdb
import pytest

import __spark_entry__ as entry
from sentinela.sources.testdata import TABLES
from tools.compare import compare

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
ROWS_ONLY = sorted(set(entry.queries()) - set(ORACLE))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sp = entry.queries()[name](spark, SF).toPandas()
    dd = duck.sql(ORACLE[name]).df()
    ok, exact, msg = compare(sp, dd)
    assert ok and exact, msg or "floats differ beyond printing"


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    assert len(df.columns) > 0
    # materialise every column: count() could prune UDF columns and hide failures
    assert len(df.toPandas().columns) == len(df.columns)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["anio_mes", "entidad"] and df.count() > 0


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_types_match(spark, duck, name):
    st = {f.name: f.dataType.simpleString() for f in entry.queries()[name](spark, SF).schema.fields}
    rel = duck.sql(ORACLE[name])
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    bad = [(c, t, dt.get(c)) for c, t in st.items() if SPARK_TO_DUCK.get(t, t) != dt.get(c)]
    assert not bad, bad


def test_udf_query_from_another_directory(tmp_path):
    """A driver that imports the entry from elsewhere: the Python workers
    must still import the package (shipped with addPyFile)."""
    import subprocess
    import sys
    import textwrap
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(__import__('os').path.dirname(entry.__file__))!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        import __spark_entry__ as e
        pdf = e.queries()["lag_pvalue"](spark, {SF!r}).toPandas()
        print("ROWS", len(pdf), pdf["p_valor"].notna().sum())
    """)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
