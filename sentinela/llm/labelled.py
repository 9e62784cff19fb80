"""Labelled rows for the classifiers: one fold is held out, the rest may be learnt from."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text is a multiple of FOLDS; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, y) of at most ``most`` rows of each class, the ones of the lowest
    id hashes, none of them held out. Labels other than 0 and 1 and null ids
    are passed over; a null text is empty; an id labelled twice counts once,
    with its smallest label. The bound is a parameter of the model: it limits
    what is learnt from, never what is scored."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
             .withColumn("draw", F.xxhash64(F.lit("draw"), "doc_id")))
    # about 2 * most rows of a class by the size of their hash, then exactly the lowest ones: no class gathers in one task
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    unit = F.shiftrightunsigned("draw", 11).cast("double") / F.lit(2.0**53)
    rate = F.when(F.col("y") == 1, 2 * most / max(counts.get(1, 0), 1)).otherwise(2 * most / max(counts.get(0, 0), 1))
    known = known.where(unit <= rate)
    known = known.withColumn("n", F.row_number().over(Window.partitionBy("y").orderBy(F.shiftrightunsigned("draw", 11), "doc_id"))).where(F.col("n") <= most)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most 2 * most rows are sent to every task, so that no text is shuffled to find them
    return texts.join(F.broadcast(known), "doc_id").select("draw", "text", "y").dropDuplicates(["draw"])


def fit_in_one_task(rows: DataFrame, fit) -> dict:
    """``fit(texts, y)`` over the bounded ``training_rows`` in one task, in the
    order of their draws; a model of rows that don't exist is fitted here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = list(zip(*([batch.column(i) for i in range(3)] for batch in batches)))
        if columns:
            draw, text, y = (pa.chunked_array(list(c)) for c in columns)
            order = pa.array(np.argsort(draw.to_numpy(), kind="stable"))
            model = fit(text.combine_chunks().take(order), y.to_numpy()[order].astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found["model"]) if found else fit(pa.array([], pa.string()), np.zeros(0, np.float32))
