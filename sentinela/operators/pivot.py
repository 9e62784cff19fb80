"""Long -> wide pivots (AGG11, AGG12) with explicit pivot values."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.operators.joins import bounded_distinct


def slug(value) -> str:
    """Column-name-safe form of a pivot value: runs of non-alphanumerics -> '_'."""
    return re.sub(r"[^0-9A-Za-z]+", "_", str(value)).strip("_")


def pivot_metrics(df: DataFrame, index: list[str], pivot_col: str, metrics: list[str],
                  values: list | None = None, agg: str = "first", name=None) -> DataFrame:
    """One row per ``index``, columns ``{metric}_{value}`` (pandas pivot_table naming).

    ``name(metric, value)`` spells the output column (default: metric and
    a column-safe slug of the value).
    ``values`` should be passed (it saves a job and fixes the column set);
    when omitted they are read with a bound check. ``agg='first'`` skips
    NULLs (S10); ``'max'`` is the AGG12 variant.
    """
    if values is None:
        values = bounded_distinct(df, pivot_col)
    fn = {"first": lambda c: F.first(c, ignorenulls=True), "max": F.max, "sum": F.sum}[agg]
    wide = df.groupBy(*index).pivot(pivot_col, values).agg(*[fn(m).alias(m) for m in metrics])
    renames = {}
    for v in values:
        for m in metrics:
            spark_name = f"{v}_{m}" if len(metrics) > 1 else str(v)
            renames[spark_name] = name(m, v) if name else f"{m}_{slug(v)}"
    return wide.withColumnsRenamed(renames)


def pivot_fill(df: DataFrame, index: list[str], pivot_col: str, metric: str, values: list,
               agg: str = "max", fill: float = 0) -> DataFrame:
    """Pivot one metric, NULL cells -> ``fill`` (AGG12)."""
    wide = pivot_metrics(df, index, pivot_col, [metric], values, agg)
    cols = [f"{metric}_{slug(v)}" for v in values]
    return wide.fillna(fill, subset=cols)
