"""Joins and set operations (JN1-8, SET1-6) with size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A side is broadcast only if it has at most this many rows (checked, not assumed).
DEFAULT_BROADCAST_ROWS = 1_000_000


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has <= max_rows rows: one count with a partial sum per
    task, so no rows gather in one task."""
    return df.count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a row-count check; otherwise the plain side
    (Catalyst/AQE then pick a shuffle join)."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def bounded_distinct(df: DataFrame, col: str, max_values: int = 10_000) -> list:
    """Sorted distinct values of a catalogue-like column, refusing unbounded ones."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{col} has more than {max_values} distinct values; pass them explicitly")
    return sorted(r[0] for r in rows)


def join_via_alias(left: DataFrame, alias: DataFrame, key: str, alias_key: str) -> DataFrame:
    """Add ``alias_key`` to ``left`` through a (small, bounded) alias table (JN2);
    unmatched keys keep their own name."""
    a = checked_broadcast(alias.select(F.col(key), F.col(alias_key)), 100_000)
    return left.join(a, key, "left").withColumn(alias_key, F.coalesce(F.col(alias_key), F.col(key)))


def unpivot_sides(df: DataFrame, ids: list[str], sides: list[str], side_col: str = "side",
                  value_col: str = "team") -> DataFrame:
    """home/away -> one team column (SET2)."""
    return df.unpivot(ids, sides, side_col, value_col)


def exclude_values(df: DataFrame, col: str, values) -> DataFrame:
    """Drop rows whose ``col`` is in ``values`` (SET3). A DataFrame of values
    becomes a left-anti join; a literal list a NOT IN filter."""
    if isinstance(values, DataFrame):
        vcol = values.columns[0]
        return df.join(values.select(F.col(vcol).alias(col)), col, "left_anti")
    return df.filter(~F.col(col).isin(list(values)) | F.col(col).isNull())


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """keep='first' under an explicit order (SET4, S11). One shuffle on ``keys``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that repeat an earlier key (SET5): count(*) - count(distinct key)."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])).alias("n_duplicados"))


def grid_from_values(spark, dims: list[tuple[str, list, str]], rows_per_partition: int = 1_000_000) -> DataFrame:
    """Cartesian product of small value lists, generated without joins (JN5).

    Row i of ``spark.range(total)`` is decoded in mixed radix into one value
    per dimension (``element_at`` on a literal array), so the grid is spread
    over ``ceil(total / rows_per_partition)`` (at least the default
    parallelism) partitions and no task builds the whole product."""
    sizes = [len(v) for _, v, _ in dims]
    total = 1
    for n in sizes:
        total *= n
    if total == 0:
        return spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, _, t in dims))
    parts = max(spark.sparkContext.defaultParallelism, -(-total // rows_per_partition))
    parts = min(parts, total)
    rng = spark.range(0, total, 1, parts)
    cols, stride = [], total
    for (name, values, typ), n in zip(dims, sizes):
        stride //= n
        arr = F.array(*[F.lit(v) for v in values]).cast(f"array<{typ}>")
        idx = (F.floor(F.col("id") / F.lit(stride)) % F.lit(n) + 1).cast("int")
        cols.append(F.element_at(arr, idx).alias(name))
    return rng.select(*cols)


def reindex_fill(grid: DataFrame, fact: DataFrame, keys: list[str], fill: dict[str, object]) -> DataFrame:
    """grid LEFT JOIN fact on keys, NULL measures -> fill (JN7). Fact rows
    outside the grid are dropped, as a reindex does."""
    out = grid.join(fact, keys, "left")
    return out.select(*keys, *[F.coalesce(F.col(c), F.lit(fill[c])).alias(c) if c in fill else F.col(c)
                               for c in fact.columns if c not in keys])


def longest_prefix(df: DataFrame, line: str, catalogue: DataFrame, name: str, keys: list[str],
                   match: str = "entidad", rest: str = "resto") -> DataFrame:
    """``keys``, the longest catalogue name that ``line`` starts with (NULL if
    none) and the trimmed remainder (JN8). A line is tried once per name length
    that occurs: an equi join on its prefix, for a catalogue of any size."""
    names = catalogue.select(F.col(name).alias("_name")).where("length(_name) > 0").distinct()
    lengths = names.agg(F.collect_set(F.length("_name")).alias("_lengths"))  # one row, as many values as lengths
    tried = df.crossJoin(F.broadcast(lengths)).select(*keys, F.col(line).alias("_line"), F.explode_outer("_lengths").alias("_n"))
    tried = tried.withColumn("_name", F.when(F.length("_line") >= F.col("_n"), F.col("_line").substr(F.lit(1), F.col("_n"))))
    found = tried.join(names.withColumn("_hit", F.lit(True)), "_name", "left").groupBy(*keys).agg(
        F.max(F.struct(F.coalesce("_hit", F.lit(False)).alias("hit"), F.when(F.col("_hit"), F.col("_n")).alias("n"), F.col("_line").alias("line"))).alias("b"))
    ent = F.when(F.col("b.hit"), F.col("b.line").substr(F.lit(1), F.col("b.n")))
    return found.select(*keys, ent.alias(match), F.when(F.col("b.hit"), F.trim(F.substr(F.col("b.line"), F.col("b.n") + 1))).alias(rest))


def top_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """First row per group under ``order`` (WIN7): row_number() = 1."""
    return dedupe_first(df, group, order)
