"""Tables in versions (SNK4): a partition is replaced by one commit.

A table is a folder with ``data/<version>`` folders and a ``manifest``. A change
first writes the new partitions to a data folder of its own, then commits one
small manifest file that names, for every partition, the folder that holds it. A
reader takes the newest committed manifest: it sees all of a change or nothing,
and a write that fails leaves only a folder that nobody names. Nothing is
overwritten, so readers of the version before are not disturbed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ENTRIES = "part string, folder string"


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/manifest"


def _entries(spark: SparkSession, path: str) -> DataFrame | None:
    """(version, part, folder) of all committed manifests; None before the first."""
    try:
        return spark.read.schema(f"{ENTRIES}, version bigint").parquet(_manifests(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions, oldest first; one row a commit."""
    entries = _entries(spark, path)
    return [] if entries is None else sorted(r["version"] for r in entries.select("version").distinct().collect())


def _commit(path: str, version: int, entries: DataFrame) -> None:
    """The manifest as one file, which appears when its job commits. A version that is there already is an error."""
    entries.coalesce(1).write.mode("error").parquet(f"{_manifests(path)}/version={version}")


class RuleViolation(ValueError):
    """Rows broke rules that must hold; nothing was committed."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(f"rows that break rules: {counts}")
        self.counts = counts


def replace_version(df: DataFrame, path: str, partition_by: list[str], rules: dict[str, Column] | None = None,
                    strict: bool = False) -> tuple[int, dict[str, int]]:
    """Replace the partitions present in ``df``, keep the others; returns the new
    version, and for each rule (an expression, true where violated) the rows that
    break it, with ``n_filas`` for all rows.

    Rules are counted by the job that writes (DQ1-3): ``df`` is read once. With
    ``strict`` a broken rule raises RuleViolation before the commit, so that the
    table stays as it was. The first version makes the table; an empty ``df``
    changes nothing but the version. One writer at a time: of two that begin from
    the same version, the second to commit fails. Partition values are numbers,
    dates or words that need no escape in a folder name."""
    spark, root = df.sparkSession, path.rstrip("/")
    before = versions(spark, root)
    version = before[-1] + 1 if before else 0
    folder = f"data/{version}-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    counts = [F.count_if(F.coalesce(broken, F.lit(False))).alias(name) for name, broken in (rules or {}).items()]
    df.observe(seen, F.count(F.lit(1)).alias("n_filas"), *counts).write.mode("error").partitionBy(*partition_by).parquet(f"{root}/{folder}")
    found = dict(seen.get)
    if strict and any(n for name, n in found.items() if name != "n_filas"):
        raise RuleViolation({name: n for name, n in found.items() if name != "n_filas" and n})
    part = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in partition_by])
    written = spark.read.schema(df.schema).parquet(f"{root}/{folder}")
    new = written.select(part.alias("part"), F.lit(folder).alias("folder")).distinct()  # folder names: no row is read
    if before:
        old = _entries(spark, root).where(F.col("version") == before[-1]).drop("version")
        new = old.join(new.select("part"), "part", "left_anti").unionByName(new)
    _commit(root, version, new)
    return version, found


def read_version(spark: SparkSession, path: str, schema=None, version: int | None = None) -> DataFrame:
    """The table as of a version, by default the newest; partition columns are read
    from their folders' names. Without a ``schema`` it is that of the files."""
    root, known = path.rstrip("/"), versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no version of a table at {path}")
    version = known[-1] if version is None else version
    entries = [(r["part"], r["folder"]) for r in _entries(spark, root).where(F.col("version") == version).collect()]  # one row a partition
    if schema is None:
        schema = spark.read.parquet(f"{root}/{max(f for _, f in entries)}").schema
    out = spark.createDataFrame([], schema)
    for folder in sorted({f for _, f in entries}):
        own = spark.read.schema(schema).option("basePath", f"{root}/{folder}").parquet(*[f"{root}/{folder}/{p}" for p, f in entries if f == folder])
        out = out.unionByName(own.select(*out.columns))
    return out
