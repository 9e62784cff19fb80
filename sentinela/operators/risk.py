"""Risk scores (RSK1-6), seasonal disaggregation and projection (TS7, TS8, AGG17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.operators.scaling import minmax_scale, share_of_max

# Composite city index weights (matches, team score, baseline cases).
COMPOSITE_WEIGHTS = {"partidos": 0.30, "score": 0.40, "baseline": 0.30}


def risk_score(cases: str | Column, coverage: str | Column) -> Column:
    """log1p(cases) * (100 - coverage) / 100 (RSK1, SCL7)."""
    c = F.col(cases) if isinstance(cases, str) else cases
    v = F.col(coverage) if isinstance(coverage, str) else coverage
    return F.log1p(c.cast("double")) * (F.lit(100.0) - v) / F.lit(100.0)


def country_risk(df: DataFrame, cases: str, coverage: str) -> DataFrame:
    """score_riesgo and its 0-10 normalisation (RSK1 + RSK2)."""
    scored = df.withColumn("score_riesgo", risk_score(cases, coverage))
    return minmax_scale(scored, "score_riesgo", "score_riesgo_norm", 10.0, 2)


def city_mean_score(scores: DataFrame, cities: DataFrame, city: str, score: str, out: str = "score_equipos") -> DataFrame:
    """Per-city mean score, the overall mean where a city has none (RSK3)."""
    per_city = scores.where(F.col(city).isNotNull()).groupBy(city).agg(F.avg(score).alias("_m"))
    overall = scores.agg(F.avg(score).alias("_g"))
    out_df = cities.join(per_city, city, "left").crossJoin(F.broadcast(overall))
    return out_df.withColumn(out, F.coalesce("_m", "_g")).drop("_m", "_g")


def composite_index(df: DataFrame, matches: str, score: str, baseline: str,
                    weights: dict[str, float] = COMPOSITE_WEIGHTS) -> DataFrame:
    """Weighted index, 0-10 normalised, plus share-of-max components (RSK4, RSK5)."""
    idx = (F.col(matches) * weights["partidos"] + F.col(score) * weights["score"]
           + F.col(baseline) * weights["baseline"])
    out = minmax_scale(df.withColumn("indice_riesgo", idx), "indice_riesgo", "indice_riesgo_norm", 10.0, 2)
    return share_of_max(out, [matches, score, baseline])


def seasonal_weights(monthly: DataFrame, date: str, value: str) -> DataFrame:
    """Month-of-year mean / sum of the 12 means (AGG17). The window runs over
    at most 12 aggregated rows."""
    m = monthly.groupBy(F.month(date).alias("mes_num")).agg(F.avg(value).alias("_avg"))
    return m.select("mes_num", (F.col("_avg") / F.sum("_avg").over(Window.partitionBy())).alias("peso"))


def seasonal_split(annual: DataFrame, year: str, value: str, weights: DataFrame, out: str = "valor_mensual") -> DataFrame:
    """annual x weight, rounded half-even (TS7). Weights have <= 12 rows, so
    the cross join is a broadcast nested loop with a proven bound (JN6)."""
    w = F.broadcast(weights.select("mes_num", "peso"))
    x = annual.crossJoin(w)
    return x.select(F.make_date(F.col(year).cast("int"), F.col("mes_num"), F.lit(1)).alias("fecha"),
                    F.bround(F.col(value).cast("double") * F.col("peso"), 0).cast("long").alias(out))


def scenario_projection(series: DataFrame, date: str, value: str, months: list[int], years: tuple[int, int],
                        factor: float) -> DataFrame:
    """Historic mean over a calendar window x growth factor (TS8)."""
    d = F.col(date)
    base = series.filter(F.month(d).isin(months) & F.year(d).between(*years)).agg(F.avg(value).alias("base_mensual"))
    return base.select("base_mensual", F.lit(factor).alias("factor"),
                       (F.col("base_mensual") * F.lit(factor)).alias("proyectado"))


def ranked(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """Top-k by score (RSK6/SRT2): orderBy + limit plans as TakeOrderedAndProject."""
    return df.orderBy(F.col(score).desc(), F.col(tie).asc()).limit(k)


def city_team_features(team_features: DataFrame, team_city: DataFrame, city: str, cols: list[str]) -> DataFrame:
    """Mean team features per host city (TS11), e.g. mean vaccination of the
    teams that play there."""
    j = team_features.join(team_city, "Country")
    return j.groupBy(city).agg(*[F.avg(c).alias(f"{c}_media_equipos") for c in cols])
