"""Registry of the queries run over the driver's test tables.

Each query is ``f(spark, sf_dir) -> DataFrame``; ``oracle`` holds the DuckDB
SQL that must return the same rows (same column names) on the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _wrap_calls(sql: str, fname: str, before: str, after: str) -> str:
    """Wrap every ``fname(...)`` call (balanced parentheses) in before/after."""
    out, i, low = [], 0, sql.lower()
    key = fname.lower() + "("
    while True:
        j = low.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(fname)
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j] + before + sql[j:k + 1] + after)
        i = k + 1


def oracle_types(sql: str) -> str:
    """Make DuckDB return what Spark returns: ``count_if`` as BIGINT (DuckDB
    gives HUGEINT) and rounded doubles without a negative zero (``bround``
    never yields -0.0; ``round_even`` of a tiny negative does)."""
    sql = _wrap_calls(sql, "count_if", "CAST(", " AS BIGINT)")
    return _wrap_calls(sql, "round_even", "(", " + 0.0)")


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with its oracle SQL (None = rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = oracle_types(sql.strip())
        return fn

    return deco
