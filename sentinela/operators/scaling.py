"""Imputation, exact quantiles and scaling (CLN9, ANO0, RSK2). Global statistics
are one-row aggregates attached with a broadcast cross join (1 row: a proven
size bound). Per-group statistics are partial aggregates written as a table: its
file size lets the planner broadcast them (or not, beyond its threshold), so
the fact itself is not shuffled on the group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.operators.ranges import in_ranges, running_total
from sentinela.sinks.writers import checkpoint_parquet


def attach(df: DataFrame, stats: DataFrame, group: list[str]) -> DataFrame:
    """``df`` with the statistics of its group; null keys are a group."""
    known = checkpoint_parquet(stats, "group-statistics")
    keys = {c: f"_key_{c}" for c in group}
    known = known.withColumnsRenamed(keys)
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
    return df.join(known, same, "left").drop(*keys.values())


def quantiles(df: DataFrame, cols: list[str], qs: list[float], group: list[str] | None = None) -> DataFrame:
    """(group, ``column``, ``q``, ``value``): exact interpolated quantiles (S8) of the
    values that are not null, of many columns at once, per group or of all rows.

    Columns are melted to (column, value) and counted by distinct value; one
    table in ranges of (group, column, value) gives every value its ranks and
    only the values at the wanted ranks are kept. No task holds more than its
    range, so one group may have all rows. A column (of a group) without values
    has no rows."""
    g = list(group or [])
    keys = [*g, "_column"]
    melted = df.select(*g, F.explode(F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("_m"))
    counts = melted.select(*g, "_m.*").where(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_m"))
    placed = in_ranges(checkpoint_parquet(counts, "quantile-counts"), keys, ["_v"], "quantile-ranges")
    ranked = running_total(placed, keys, ["_v"], "_m", "_first", "_n")
    holds = lambda k: (F.col("_first") <= k) & (k < F.col("_first") + F.col("_m"))
    places = F.array(*[F.struct(F.lit(float(q)).alias("q"), (F.lit(float(q)) * (F.col("_n") - 1)).alias("at")) for q in qs])
    found = ranked.select(*keys, "_v", "_first", "_m", F.explode(F.filter(places, lambda p: holds(F.floor(p["at"])) | holds(F.ceil(p["at"])))).alias("_p"))
    low, high = F.floor("_p.at"), F.ceil("_p.at")
    ends = found.groupBy(*keys, F.col("_p.q").alias("q")).agg(
        F.max(F.when(holds(low), F.col("_v"))).alias("_lo"), F.max(F.when(holds(high), F.col("_v"))).alias("_hi"), F.max("_p.at").alias("_at"))
    value = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise((F.ceil("_at") - F.col("_at")) * F.col("_lo") + (F.col("_at") - F.floor("_at")) * F.col("_hi"))
    return ends.select(*g, F.col("_column").alias("column"), "q", value.alias("value"))


def quantile(df: DataFrame, col: str, q: float, group: list[str] | None = None, out: str = "_q") -> DataFrame:
    """One quantile of one column (see ``quantiles``)."""
    return quantiles(df, [col], [q], group).select(*(group or []), F.col("value").alias(out))


def median_impute(df: DataFrame, cols: list[str], group: list[str] | None = None) -> DataFrame:
    """Fill NULLs with the exact interpolated median (S8) of each column,
    globally or per group; all columns share one rank table."""
    g = list(group or [])
    medians = quantiles(df, cols, [0.5], g).groupBy(*g).agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_med_{c}") for c in cols])
    out = attach(df, medians, g) if g else df.crossJoin(F.broadcast(medians))  # one row
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}")) for c in cols}).drop(*[f"_med_{c}" for c in cols])


def standardize(df: DataFrame, cols: list[str], group: list[str] | None = None, suffix: str = "_z",
                fill_null: float = 0.0) -> DataFrame:
    """(x - mean) / population std (S7: sklearn StandardScaler), zero-variance
    scale = 1 so the column becomes 0. NULL inputs -> ``fill_null`` first."""
    xs = {c: F.coalesce(F.col(c).cast("double"), F.lit(fill_null)) for c in cols}
    aggs = [a for c, x in xs.items() for a in (F.avg(x).alias(f"_mu_{c}"), F.stddev_pop(x).alias(f"_sd_{c}"))]
    out = attach(df, df.groupBy(*group).agg(*aggs), list(group)) if group else df.crossJoin(F.broadcast(df.agg(*aggs)))
    for c, x in xs.items():
        sd = F.col(f"_sd_{c}")
        out = out.withColumn(c + suffix, (x - F.col(f"_mu_{c}")) / F.when(sd > 0, sd).otherwise(F.lit(1.0)))
    return out.drop(*[f"_{k}_{c}" for c in cols for k in ("mu", "sd")])


def minmax_scale(df: DataFrame, col: str, out: str, top: float = 10.0, digits: int | None = 2,
                 group: list[str] | None = None) -> DataFrame:
    """(x - min) / (max - min) * top, half-even rounded; zero range -> 0.0 (RSK2, Q13)."""
    x = F.col(col).cast("double")
    stats = [F.min(x).alias("_lo"), F.max(x).alias("_hi")]
    base = attach(df, df.groupBy(*group).agg(*stats), list(group)) if group else df.crossJoin(F.broadcast(df.agg(*stats)))
    lo, hi = F.col("_lo"), F.col("_hi")
    val = F.when(hi > lo, (x - lo) / (hi - lo) * F.lit(top)).otherwise(F.when(x.isNotNull(), F.lit(0.0)))
    if digits is not None:
        val = F.bround(val, digits)
    return base.withColumn(out, val).drop("_lo", "_hi")


def share_of_max(df: DataFrame, cols: list[str], top: float = 10.0, suffix: str = "_rel") -> DataFrame:
    """x / max(x) * top per column (RSK5); NULL when max is 0."""
    mx = df.agg(*[F.max(c).alias(f"_mx_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(mx))
    return out.withColumns({c + suffix: F.try_divide(F.col(c).cast("double"), F.col(f"_mx_{c}")) * F.lit(top)
                            for c in cols}).drop(*[f"_mx_{c}" for c in cols])
