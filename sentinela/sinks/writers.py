"""Sinks (SNK1-5): CSV / Parquet writes, checkpoints, partition replace, round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.session import scratch_path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header (SNK1)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def save_table(df: DataFrame, name: str, out_dir: str, partition_by: list[str] | None = None) -> dict[str, str]:
    """Parquet (snappy) and CSV copies; returns both paths (SNK2)."""
    pq, csv = f"{out_dir.rstrip('/')}/{name}.parquet", f"{out_dir.rstrip('/')}/{name}.csv"
    w = df.write.mode("overwrite").option("compression", "snappy")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(pq)
    write_csv(df, csv)
    return {"parquet": pq, "csv": csv}


def checkpoint_parquet(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back (SNK3): cuts lineage
    so an executor loss later re-reads the files instead of recomputing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions present in ``df`` (SNK4): dynamic
    partition overwrite, the other years stay as they are."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-independent content hash (SNK5)."""
    cols = sorted(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_filas"),
                  F.sum(F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")).alias("hash"))


def round_trip_ok(spark: SparkSession, df: DataFrame, path: str) -> bool:
    """Reload a written table and compare count, schema names and content hash (SNK5)."""
    back = spark.read.parquet(path).select(*df.columns)
    a, b = fingerprint(df).first(), fingerprint(back).first()
    return a == b and [f.name for f in back.schema] == df.columns
