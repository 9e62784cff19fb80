"""Ordered scans over groups of any size, in two levels.

The rows are written once in ranges of (group, order). Inside a range a window
does the work; one summary row per (group, range) carries what comes before the
range. No window holds more than a range's rows of a group, and the windows over
summaries hold at most as many rows as there are ranges: a range edge splits one
group at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sentinela.sinks.writers import checkpoint_parquet

SEGMENT = "_segment"


def in_ranges(df: DataFrame, group: list[str], order: list[str], name: str = "ranges") -> DataFrame:
    """``df`` written in ranges of (group, order), each row with its range's number.
    Null keys are a group of their own."""
    return checkpoint_parquet(df.repartitionByRange(*group, *order).withColumn(SEGMENT, F.spark_partition_id()), name)


def _inside(group: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*group, SEGMENT).orderBy(*order)


def _over_ranges(group: list[str]) -> WindowSpec:
    return Window.partitionBy(*(group or [F.lit(0)])).orderBy(SEGMENT)


def _with_summary(placed: DataFrame, group: list[str], summary: DataFrame) -> DataFrame:
    """``placed`` with the columns of its (group, range)."""
    keys = {c: f"_key_{c}" for c in [*group, SEGMENT]}
    known = summary.withColumnsRenamed(keys)
    return placed.join(known, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]).drop(*keys.values())


def running_total(placed: DataFrame, group: list[str], order: list[str], value: str | Column | None = None, before: str = "_before",
                  total: str | None = None) -> DataFrame:
    """The sum of ``value`` over the rows of the group that come earlier (0 for the
    first), and over the whole group; without ``value`` rows are counted. ``order``
    must be unique in a group."""
    value = F.lit(1) if value is None else F.col(value) if isinstance(value, str) else value
    over = _over_ranges(group)
    sums = placed.groupBy(*group, SEGMENT).agg(F.sum(value).alias("_own"))
    sums = sums.withColumn("_earlier", F.coalesce(F.sum("_own").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if total:
        sums = sums.withColumn(total, F.sum("_own").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    inside = _inside(group, order).rowsBetween(Window.unboundedPreceding, -1)
    out = _with_summary(placed, group, sums.drop("_own"))
    return out.withColumn(before, F.col("_earlier") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_earlier")


def previous(placed: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``value`` (never null) of the row before in the group; null for the first."""
    last = placed.groupBy(*group, SEGMENT).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    last = last.withColumn("_last", F.lag("_last").over(_over_ranges(group)))
    return _with_summary(placed, group, last).withColumn(out, F.coalesce(F.lag(value).over(_inside(group, order)), "_last")).drop("_last")
