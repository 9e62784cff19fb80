"""Lag-correlation search between a driver series and per-entity case series (TS1-3).

Plan: one window pass computes leads 0..K of the case series per entity; a
``stack`` turns them into (entity, lag, x, y) pairs; one aggregate gives the
guarded Pearson r per (entity, lag); ``max_by`` picks the best lag. Every step
is partitioned by entity, and the pair table never leaves the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.operators.stats import guarded_corr


def lag_pairs(df: DataFrame, entity: str, order: str, x: str, y: str, lags: list[int]) -> DataFrame:
    """Positional pairs (x[i], y[i+k]) after dropping rows where x or y is NULL (WIN6, S15)."""
    clean = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    w = Window.partitionBy(entity).orderBy(order)
    leads = {f"_y{k}": F.lead(y, k).over(w) for k in lags}
    wide = clean.select(entity, order, F.col(x).cast("double").alias("x"), *[c.alias(n) for n, c in leads.items()],
                        F.count(F.lit(1)).over(Window.partitionBy(entity)).alias("n_puntos"))
    stack = ", ".join(f"{k}, _y{k}" for k in lags)
    pairs = wide.selectExpr(entity, order, "x", "n_puntos", f"stack({len(lags)}, {stack}) AS (lag, y)")
    return pairs.where("y IS NOT NULL").withColumn("y", F.col("y").cast("double"))


def lag_correlations(df: DataFrame, entity: str, order: str, x: str, y: str, lags: list[int],
                     min_pairs: int = 3) -> DataFrame:
    """r per (entity, lag), NULL below ``min_pairs`` pairs or on a constant side."""
    pairs = lag_pairs(df, entity, order, x, y, lags)
    return pairs.groupBy(entity, "lag").agg(
        guarded_corr("x", "y", min_pairs).alias("r"), F.count(F.lit(1)).alias("n_pares"),
        F.max("n_puntos").alias("n_puntos"))


def best_lag(df: DataFrame, entity: str, order: str, x: str, y: str, lags: list[int],
             min_points: int = 8, default_lag: int = 1, min_pairs: int = 3) -> DataFrame:
    """Best lag per entity = argmax |r| with the lowest lag on ties (SRT3).

    Entities with fewer than ``min_points`` complete rows, or with no defined
    r, get ``default_lag`` and a NULL r (the reference's fallback)."""
    corr = lag_correlations(df, entity, order, x, y, lags, min_pairs)
    ok = corr.where("r IS NOT NULL")
    best = ok.groupBy(entity).agg(
        F.max_by(F.struct("lag", "r"), F.struct(F.abs("r"), -F.col("lag"))).alias("b"))
    points = corr.groupBy(entity).agg(F.max("n_puntos").alias("n_puntos"))
    out = points.join(best, entity, "left")
    enough = F.col("n_puntos") >= min_points
    return out.select(
        entity,
        F.when(enough & F.col("b").isNotNull(), F.col("b.lag")).otherwise(F.lit(default_lag)).alias("mejor_lag"),
        F.when(enough, F.col("b.r")).alias("mejor_r"),
        F.col("n_puntos"),
    )


# ---- p-value of r (TS2) ----

def pearson_pvalue(r: Column, n: Column) -> Column:
    """Two-sided p of a Pearson r over n pairs: the Student t tail with n - 2
    degrees of freedom, which for whole degrees is a finite series in
    cos^2 = 1 - r^2. NULL without r or degrees of freedom."""
    df = (n - 2).cast("int")
    sine = F.abs(r)
    cos2 = F.lit(1.0) - r * r
    even = df % 2 == 0
    last = F.greatest(F.when(even, (df - 2) / 2).otherwise((df - 3) / 2).cast("int"), F.lit(0))

    def step(acc, j):
        ratio = F.when(even, (2 * j - 1) / (2 * j)).otherwise((2 * j) / (2 * j + 1))
        term = F.when(j == 0, F.lit(1.0)).otherwise(acc["term"] * ratio * cos2)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    series = F.aggregate(F.sequence(F.lit(0), last), F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("sum")), step, lambda acc: acc["sum"])
    odd = F.lit(2 / math.pi) * (F.asin(sine) + F.when(df > 1, sine * F.sqrt(cos2) * series).otherwise(0.0))
    inside = F.when(cos2 <= 0, 1.0).otherwise(F.when(even, sine * series).otherwise(odd))
    return F.when(df >= 1, F.lit(1.0) - inside)


def lag_pvalues(corr: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Add t statistic, p-value and significance flag to a lag_correlations result (TS2)."""
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n_pares") - 2, 1 - F.col("r") * F.col("r")))
    p = pearson_pvalue(F.col("r"), F.col("n_pares"))
    return corr.withColumns({"t": t, "p_valor": p}).withColumn("significativo", F.col("p_valor") < alpha)


def ols_at_lag(df: DataFrame, entity: str, order: str, x: str, y: str, lag_table: DataFrame,
               lags: list[int] | None = None) -> DataFrame:
    """slope, intercept, r at each entity's chosen lag (TS3). ``lag_table``
    has (entity, mejor_lag); it is one row per entity, joined (not collected)."""
    lags = lags if lags is not None else list(range(0, 7))
    pairs = lag_pairs(df, entity, order, x, y, lags)
    chosen = pairs.join(lag_table.select(entity, F.col("mejor_lag").alias("lag")), [entity, "lag"], "inner")
    return chosen.groupBy(entity, "lag").agg(
        F.regr_slope("y", "x").alias("pendiente"), F.regr_intercept("y", "x").alias("intercepto"),
        guarded_corr("x", "y").alias("r"), F.count(F.lit(1)).alias("n_pares"))
