"""Grouped statistics (AGG3-5, AGG9-10, AGG16-21): one aggregate pass each."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.operators.scaling import quantiles


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_corr(x: str | Column, y: str | Column, min_n: int = 3) -> Column:
    """Pearson r as an aggregate; NULL when fewer than ``min_n`` complete
    pairs or when either side is constant (S12: SciPy gives NaN there, and
    plain ``corr`` raises under ANSI division rules)."""
    xc, yc = _col(x).cast("double"), _col(y).cast("double")
    both = xc.isNotNull() & yc.isNotNull()
    xs, ys = F.when(both, xc), F.when(both, yc)
    sx, sy = F.stddev_pop(xs), F.stddev_pop(ys)
    return F.when((F.count(xs) >= min_n) & (sx > 0) & (sy > 0), F.covar_pop(xs, ys) / (sx * sy))


def incidence_stats(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """sum (0 for all-NULL, S3), mean, months with value > 0, peak (AGG3)."""
    v = F.col(value)
    return df.groupBy(*group).agg(
        F.coalesce(F.sum(v), F.lit(0)).alias("total_cases"),
        F.avg(v).alias("avg_monthly_cases"),
        F.count_if(v > 0).alias("months_with_cases"),
        F.max(v).alias("peak_month"),
    )


def coverage_stats(df: DataFrame, group: list[str], value: str, prefix: str = "cov") -> DataFrame:
    """mean, min and sample std (ddof 1, NULL at n = 1) (AGG4, S6)."""
    v = F.col(value)
    return df.groupBy(*group).agg(
        F.avg(v).alias(f"{prefix}_mean"), F.min(v).alias(f"{prefix}_min"), F.stddev_samp(v).alias(f"{prefix}_std"))


def trend_slope(df: DataFrame, group: list[str], y: str, x: str, min_points: int = 3,
                out: str = "tendencia") -> DataFrame:
    """OLS slope of y on x per group, NULL-dropping, NULL under ``min_points`` (AGG5, S13)."""
    return df.groupBy(*group).agg(
        F.when(F.regr_count(F.col(y), F.col(x)) >= min_points, F.regr_slope(F.col(y), F.col(x))).alias(out))


def percentiles(df: DataFrame, group: list[str], value: str, qs: list[float], exact: bool = True) -> DataFrame:
    """Exact interpolated percentiles (AGG19, S8); columns p75, p90, ... The exact
    form ranks distinct values over ranges (``scaling.quantiles``), so that a
    group may hold all rows; ``exact=False`` is the bounded sketch in one aggregate."""
    names = [f"p{round(q * 100):d}" for q in qs]
    if not exact:
        out = df.groupBy(*group).agg(F.percentile_approx(F.col(value), [float(q) for q in qs], 100_000).alias("_p"))
        return out.select(*group, *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])
    found = quantiles(df, [value], qs, group)
    of = {n: F.max(F.when(F.col("q") == float(q), F.col("value"))).alias(n) for q, n in zip(qs, names)}
    groups = df.select(*group).distinct()  # a group without values has nulls
    pick = found.groupBy(*group).agg(*of.values())
    return groups.unionByName(pick, allowMissingColumns=True).groupBy(*group).agg(*[F.max(n).alias(n) for n in names])


def correlation_pairs(df: DataFrame, cols: list[str], threshold: float = 0.7) -> DataFrame:
    """Lower-triangle pairwise Pearson r in a single aggregate, stacked to rows
    (AGG18): (var_1, var_2, r, abs_r, strong)."""
    pairs = list(combinations(cols, 2))
    one = df.agg(*[guarded_corr(a, b, 2).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', r{i}" for i, (a, b) in enumerate(pairs))
    rows = one.selectExpr(f"stack({len(pairs)}, {stack}) AS (var_1, var_2, r)")
    return rows.withColumns({"abs_r": F.abs("r"), "strong": F.abs("r") > threshold})


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """NULL count per column in one pass, unpivoted to (tabla, columna, n_nulos) (AGG20)."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "columna", "n_nulos").select(F.lit(table).alias("tabla"), "columna", "n_nulos")


def range_summary(df: DataFrame, col: str) -> DataFrame:
    """min / max / count / distinct count (AGG21)."""
    c = F.col(col)
    return df.agg(F.min(c).alias("minimo"), F.max(c).alias("maximo"), F.count(c).alias("n"),
                  F.count_distinct(c).alias("n_distintos"))


def distinct_coverage(df: DataFrame, group: list[str], item: str, required: int | None = None) -> DataFrame:
    """Distinct items per group (AGG9) and, with ``required``, the incomplete
    flag of a HAVING-style filter (AGG10)."""
    out = df.groupBy(*group).agg(F.count_distinct(item).alias("n_distintos"), F.count(F.lit(1)).alias("n_filas"))
    if required is not None:
        out = out.withColumn("incompleto", F.col("n_distintos") < required)
    return out


# Twelve bits: a sketch of at most 4 KB, relative standard error about 0.83 / sqrt(2^12) = 1.3 %.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, group: list[str], item: str, bits: int = SKETCH_BITS) -> DataFrame:
    """A mergeable sketch of the distinct items of each group (AGG9), to be stored:
    (group, ``sketch``, ``n_filas``). Null items are not counted."""
    return df.groupBy(*group).agg(F.hll_sketch_agg(F.col(item), F.lit(bits)).alias("sketch"), F.count(F.lit(1)).alias("n_filas"))


def merged_distinct(sketches: DataFrame, group: list[str] | None = None, out: str = "n_estimado") -> DataFrame:
    """Distinct items of coarser groups (or of all) from stored sketches; the rows
    behind them are not read again. Per-group counts can't be added, sketches can."""
    return sketches.groupBy(*(group or [])).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out), F.sum("n_filas").alias("n_filas"))
