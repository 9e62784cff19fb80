"""Incremental bulletins (SRC8, EXT7, EXT8): decoded pages that land in a folder
become raw rows, missing diseases and quarantined pages, each file once.

A file-source stream remembers the page files it has read; every micro-batch
writes to folders of its own, ``<table>/batch=<id>``, so a batch that is run again
overwrites only what it wrote. The ledger has one row for each bulletin of a batch;
a bulletin that lands again later is passed over. All pages of a bulletin
must land in one file of pages.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.operators import bulletin as B
from sentinela.sinks.writers import checkpoint_parquet

PAGES = "file string, page int, text string, grid array<array<string>>"
TABLES = {"rows": "raw rows", "missing": "diseases without rows", "quarantine": "pages that gave no row", "ledger": "bulletins"}


def read_table(spark: SparkSession, out: str, name: str) -> DataFrame | None:
    """One of TABLES, of all batches; None before the first."""
    try:
        return spark.read.parquet(f"{out}/{name}")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def process_batch(pages: DataFrame, batch_id: int, out: str, config: DataFrame, entities: list[str]) -> None:
    """The four tables of one batch. The ledger is written last: a bulletin is done once its rows are there."""
    spark = pages.sparkSession
    known = read_table(spark, out, "ledger")
    if known is not None:  # of other batches: this one may be run again
        pages = pages.join(known.where(F.col("batch") != batch_id).select("file").distinct(), "file", "left_anti")
    pages = checkpoint_parquet(pages, "bulletin-pages")  # read by each of the tables
    rows = checkpoint_parquet(B.extract(pages, config, entities), "bulletin-rows")
    write = lambda df, name: df.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")
    write(rows, "rows")
    write(B.missing_diseases(pages, config, rows), "missing")
    write(B.quarantine(pages, config, entities), "quarantine")
    write(pages.groupBy("file").agg(F.count(F.lit(1)).alias("n_paginas")), "ledger")


def run_available(spark: SparkSession, landing: str, out: str, config: DataFrame, entities: list[str], files_per_batch: int | None = None) -> None:
    """Process the pages files that have landed since the last run, then stop."""
    reader = spark.readStream.schema(PAGES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.parquet(landing).writeStream.option("checkpointLocation", f"{out}/_stream").trigger(availableNow=True)
             .foreachBatch(lambda batch, i: process_batch(batch, i, out, config, entities)).start())
    query.awaitTermination()
