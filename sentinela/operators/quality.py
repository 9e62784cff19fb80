"""Data-quality checks (DQ1-5): each is one aggregate pass, returned as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: dict[str, Column], table: str) -> DataFrame:
    """Count rows that break each rule (rule expression = True when violated),
    in one pass; long form (tabla, regla, n_violaciones) (DQ1)."""
    one = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules.items()])
    return (one.unpivot([], list(rules), "regla", "n_violaciones")
            .select(F.lit(table).alias("tabla"), "regla", "n_violaciones"))


def assert_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Raise mode of DQ1: the returned DataFrame fails at execution on the first
    violating row (``assert_true``), otherwise passes rows through."""
    checks = [F.assert_true(~F.coalesce(cond, F.lit(False)), F.lit(f"rule violated: {name}")).isNull()
              for name, cond in rules.items()]
    # a filter (not a dropped column) so column pruning cannot remove the checks
    return df.where(reduce(lambda a, b: a & b, checks))


def basic_checks(df: DataFrame, numeric: list[str], expected_rows: int | None = None) -> DataFrame:
    """Row count, negatives and NULLs per numeric column, expected-count flag (DQ3)."""
    aggs = [F.count(F.lit(1)).alias("n_filas")]
    for c in numeric:
        aggs += [F.count_if(F.col(c) < 0).alias(f"neg_{c}"), F.count_if(F.col(c).isNull()).alias(f"null_{c}")]
    out = df.agg(*aggs)
    if expected_rows is not None:
        out = out.withColumn("filas_ok", F.col("n_filas") == F.lit(expected_rows))
    return out


def spot_check(expected: DataFrame, actual: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Expected values left-joined to the actual table; rows that differ or are missing (DQ4)."""
    a = actual.select(*keys, F.col(value).alias("_actual"))
    j = expected.join(a, keys, "left")
    return j.where(~F.col("_actual").eqNullSafe(F.col(value))).withColumnRenamed("_actual", f"{value}_actual")


def standardization_check(df: DataFrame, cols: list[str], tol: float = 1e-6) -> DataFrame:
    """mean ~ 0, population std ~ 1, no NULLs per column (DQ5)."""
    one = df.agg(*[F.struct(F.avg(c).alias("media"), F.stddev_pop(c).alias("std"),
                            F.count_if(F.col(c).isNull()).alias("nulos")).alias(c) for c in cols])
    long = one.unpivot([], cols, "columna", "s").select("columna", "s.*")
    return long.withColumn("ok", (F.abs("media") <= tol) & (F.abs(F.col("std") - 1) <= tol) & (F.col("nulos") == 0))


def grouped_flag(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: sum and has-data flag (AGG22), e.g. weeks with any case."""
    return df.groupBy(group).agg(F.sum(value).alias("total")).withColumn("con_datos", F.col("total") > 0)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Fail when ``keys`` repeat (S5): a left join against such a table would
    fan out rows. One aggregate; raises ValueError with the duplicate count."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*[F.col(k) for k in keys]).alias("d")).first()
    if r["n"] != r["d"]:
        raise ValueError(f"{r['n'] - r['d']} duplicated key rows on {keys}")
