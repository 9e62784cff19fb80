"""Sorted sequences cut into blocks, and dual descents over trees of blocks.

A table is sorted by a bucket and by an order inside it, and cut into blocks of
bounded size (a bucket of any size spreads over many tasks). Sixteen blocks
form a node, sixteen nodes a node of the next level. The descent starts with
every bucket's root against itself and follows, level by level, the pairs of
children that may hold a match; each level is one join on the bucket and the
parents, and pairs that cannot match are never made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.sinks.writers import checkpoint_parquet

FAN_BITS = 4


def runs(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[tuple[int, pa.Table]]:
    """(key, rows) of each run of equal values in a stream sorted by the bigint
    column ``key``; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1 if len(keys) else []
        bounds = [0, *map(int, cuts), len(keys)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                continue
            if held and last != int(keys[a]):
                yield last, pa.Table.from_batches(held)
                held = []
            last = int(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds of its runs) of pieces of such a stream that hold whole runs,
    for work that treats many short runs at once; a batch and a run are held."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        keys = rows[key].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        if len(cuts) > 1:
            yield rows.slice(0, cuts[-1]).combine_chunks(), cuts
        held = rows.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def cut(rows: DataFrame, order: list, size: int) -> DataFrame:
    """``rows`` with a bigint ``block``: sorted by the bigint ``bucket`` and
    ``order``, at most ``size`` rows of one bucket each. Rows of a bucket that
    lie in two partitions are in different blocks; block numbers ascend in the
    sorted order. Nothing but one batch is held in a task."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", block bigint"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = (TaskContext.get().partitionId() << 36) - 1
        bucket, filled = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index("bucket")).to_numpy()
            out = np.empty(len(keys), np.int64)
            cuts = [0, *map(int, np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if bucket != int(keys[a]):
                    bucket, filled, block = int(keys[a]), 0, block + 1
                at = filled + np.arange(b - a)
                out[a:b] = block + at // size
                block, filled = block + (filled + b - a - 1) // size, (filled + b - a - 1) % size + 1
                if filled == size:
                    block, filled = block + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "block"])

    return rows.repartitionByRange("bucket", *order).sortWithinPartitions("bucket", *order).mapInArrow(number, schema)


def block_pairs(blocks: DataFrame, merged: dict[str, Callable], may_match: Callable[[str, str], Column], name: str) -> DataFrame:
    """(bucket, left, right) of the pairs of blocks, left <= right, that the
    descent could not rule out.

    ``blocks`` has bucket, block and summary columns; ``merged`` gives the
    aggregate that combines each summary in a parent; ``may_match(a, b)`` is
    the condition on the nodes aliased a and b (it holds for a parent whenever
    it holds for some pair of its children)."""
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("block")) - 1
    leaves = checkpoint_parquet(blocks.withColumn("node", rank.cast("bigint")), name)
    most = leaves.agg(F.max("node")).first()[0] or 0
    levels = 0
    while most >> (FAN_BITS * levels):
        levels += 1
    pairs = leaves.select("bucket").distinct().select("bucket", F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    for level in range(levels - 1, -1, -1):
        nodes = leaves.drop("block").withColumn("node", F.shiftright("node", FAN_BITS * level))
        if level:
            nodes = nodes.groupBy("bucket", "node").agg(*[f(c).alias(c) for c, f in merged.items()])
        nodes = nodes.withColumn("parent", F.shiftright("node", FAN_BITS))
        x, y = nodes.alias("x"), nodes.alias("y")
        pairs = (pairs.alias("p")
                 .join(x, (F.col("p.bucket") == F.col("x.bucket")) & (F.col("p.a") == F.col("x.parent")))
                 .join(y, (F.col("p.bucket") == F.col("y.bucket")) & (F.col("p.b") == F.col("y.parent")))
                 .where((F.col("x.node") <= F.col("y.node")) & may_match("x", "y"))
                 .select("p.bucket", F.col("x.node").alias("a"), F.col("y.node").alias("b")))
        if level:
            pairs = checkpoint_parquet(pairs, name)
    x, y = leaves.select("bucket", "node", "block").alias("x"), leaves.select("bucket", "node", "block").alias("y")
    return (pairs.alias("p").join(x, (F.col("p.bucket") == F.col("x.bucket")) & (F.col("p.a") == F.col("x.node")))
            .join(y, (F.col("p.bucket") == F.col("y.bucket")) & (F.col("p.b") == F.col("y.node")))
            .select("p.bucket", F.col("x.block").alias("left"), F.col("y.block").alias("right")))


def pair_rows(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The members of both blocks of each pair, for ``runs``: ``key`` numbers the
    pair, ``side`` is 0 for the left block and 1 for the right one (a block
    against itself comes once, as side 0); sorted by both in its partition."""
    keyed = pairs.withColumn("key", F.xxhash64("left", "right"))
    sides = (keyed.select("key", F.lit(0).alias("side"), F.col("left").alias("block"))
             .union(keyed.where("left <> right").select("key", F.lit(1).alias("side"), F.col("right").alias("block"))))
    return sides.join(members, "block").repartition("key").sortWithinPartitions("key", "side", "block")
