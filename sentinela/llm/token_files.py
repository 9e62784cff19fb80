"""Token ids in Parquet list columns (operator 6).

Documents are range-partitioned and sorted by id, encoded, and written one row
per document: id, count, the number of ids before it in its file, and the ids.
The ids are dictionary-encoded (16 bits or fewer each), ids of documents and
counts delta-encoded; row groups and pages are small and carry page indexes, so
a reader of some documents, or of the counts alone, touches little of a file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.llm import tokens
from sentinela.session import scratch_path

END_ID = 0
#: Of the files: bytes of a row group and of a page, rows of a page at most.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 128 << 10, 2000

FILE_SCHEMA = "doc_id bigint, n_tokens bigint, start_in_file bigint, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the token files of ``docs`` to ``path``, in ascending id order.

    Null and empty texts have the end id only; null ids come first; a repeated
    id has a row for each of its rows, in any order. An empty table gives files
    without rows. Extra columns are ignored.
    """
    vocabulary = tokenizer or tokens.default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary)
        before = 0
        for batch in batches:
            for i, j, ids, of in encode.column(batch.column(1)):
                ends = of[1:] + np.arange(1, j - i + 1)  # with the end ids
                all_ids = np.insert(ids, of[1:], end_id).astype(np.int32)
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(ends - starts), pa.array(before + starts),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([starts, ends[-1:]]).astype(np.int32)), pa.array(all_ids))],
                    names=["doc_id", "n_tokens", "start_in_file", "ids"])
                before += int(ends[-1])

    (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(run, FILE_SCHEMA)
     .write.mode("overwrite")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#start_in_file", "false")
     .option("compression", "zstd").parquet(path))
    return path


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(4)
        flat, of = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
        of = of - of[0]
        crc = pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(of[:-1], of[1:])], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], crc], names=["file", "doc_id", "n_tokens", "start_in_file", "ids_crc32"])


def file_starts(files: DataFrame) -> DataFrame:
    """(file, base): the ids in all files before it, from the counts alone. One
    row per file goes through the window."""
    per_file = files.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("doc_id").alias("first_id"), F.sum("n_tokens").alias("n"))
    before = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return per_file.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def digest(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    rows = (files.select(F.col("_metadata.file_path").alias("file"), "doc_id", "n_tokens", "start_in_file", "ids")
            .mapInArrow(_crc, "file string, doc_id bigint, n_tokens bigint, start_in_file bigint, ids_crc32 bigint"))
    return rows.join(file_starts(files), "file").select(
        "doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    """Write the files of ``docs`` and return what they hold, read back."""
    spark = docs.sparkSession
    return digest(spark, write_tokens(docs, path or scratch_path(spark, "token-files"), tokenizer))
