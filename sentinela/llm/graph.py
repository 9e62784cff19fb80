"""Connected components of an edge table, as a loop of DataFrame jobs.

Each round lets every node point at the smallest node it has seen (large star,
then small star), until nothing changes. A node's neighbours are reduced to
their minimum with a map-side combine, so a hub of any degree is one row per
task in the shuffle. Every round is written to the shared checkpoint folder:
the lineage stays one round long and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.sinks.writers import checkpoint_parquet


def _large_star(edges: DataFrame) -> DataFrame:
    """For every node, its larger neighbours move to its smallest one."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """For every node, its smaller neighbours and itself move to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (two bigint columns, any
    order); component is the smallest node reachable, the node itself included.
    Nulls and loops are ignored; no edges give no rows."""
    u, v = edges.columns[:2]
    now = checkpoint_parquet(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                             .where("u <> v").distinct(), name)
    before = None
    while (mark := _mark(now)) != before and mark[0]:
        before = mark
        now = checkpoint_parquet(_small_star(_large_star(now)), name)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
