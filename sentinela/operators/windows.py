"""Window operators: new-from-cumulative, group totals, lags (WIN1-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def new_from_cumulative(df: DataFrame, partition: list[str], order: str, cumulative: str,
                        weekly: str, first_period: str = "half", out: str = "casos_nuevos") -> DataFrame:
    """New cases = cumulative - previous cumulative within ``partition`` (WIN1).

    The difference is positional (previous row, not previous calendar week),
    clipped at 0. The first row of each partition has no previous value and
    takes ``weekly`` ('full') or round-half-even(weekly / 2) ('half', the
    later correction where the weekly figure is a both-sex total).
    """
    w = Window.partitionBy(*partition).orderBy(order)
    prev = F.lag(cumulative).over(w)
    if first_period == "half":
        first = F.bround(F.col(weekly).cast("double") / 2, 0)
    elif first_period == "full":
        first = F.col(weekly)
    else:
        raise ValueError("first_period must be 'half' or 'full'")
    diff = F.when(prev.isNull(), first).otherwise(F.col(cumulative) - prev)
    return df.withColumn(out, F.greatest(diff, F.lit(0)).cast("bigint"))


def group_totals(df: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Attach per-group sums to every row (JN3, WIN2, WIN3) with a window
    instead of aggregate + self-join: one shuffle on ``keys``."""
    w = Window.partitionBy(*keys)
    return df.withColumns({out: F.sum(src).over(w) for src, out in sums.items()})


def lag_features(df: DataFrame, entity: list[str], order: str, cols: list[str], lags: list[int],
                 name: str = "{col}_lag{k}", mode: str = "row") -> DataFrame:
    """Lags per entity (WIN4/5).

    ``mode='row'`` shifts by position (the previous k rows, gaps ignored,
    the reference's behaviour, Q3/S15): a window partitioned by entity.
    ``mode='calendar'`` takes the value of exactly k months earlier (NULL
    when that month is missing): every row is re-dated k months later for
    each k and joined back once on (entity, month)."""
    if mode == "row":
        w = Window.partitionBy(*entity).orderBy(order)
        return df.withColumns({name.format(col=c, k=k): F.lag(c, k).over(w) for c in cols for k in lags})
    if mode != "calendar":
        raise ValueError("mode must be 'row' or 'calendar'")
    shifted = df.select(*entity, F.col(order).alias("_o"), *cols).withColumn(
        "_k", F.explode(F.array(*[F.lit(int(k)) for k in lags])))
    shifted = shifted.withColumn("_o", F.add_months("_o", F.col("_k")))
    wide = shifted.groupBy(*entity, "_o").pivot("_k", [int(k) for k in lags]).agg(
        *[F.first(c).alias(c) for c in cols])
    ren = {(f"{k}_{c}" if len(cols) > 1 else str(k)): name.format(col=c, k=k) for c in cols for k in lags}
    wide = wide.withColumnsRenamed(ren).withColumnRenamed("_o", order)
    return df.join(wide, [*entity, order], "left")
