"""Anomaly labels per group: 1-D DBSCAN (ANO2), label union / intersection
(ANO3), Cohen's kappa (ANO4), label summary (ANO5); ``forest`` has ANO1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.operators.ranges import in_ranges, previous, running_total
from sentinela.sinks.writers import checkpoint_parquet


# ----------------------------------------------------------------- DBSCAN 1-D


def dbscan_1d(df: DataFrame, group: list[str], x: str, order: str, eps: float = 1.2, min_samples: int = 2,
              label: str = "db_label") -> DataFrame:
    """Exact DBSCAN on one numeric feature per group (ANO2), no UDF, one recipe
    at any size; its windows over points are partitioned by (group, bucket).

    Buckets have width eps (b = floor(x / eps)), so two values in one bucket
    are closer than eps, and all neighbours of x lie in buckets b-1..b+1.
    * Each distinct point is copied to its two neighbour buckets (a bounded
      3x halo); a RANGE frame per (group, bucket) gives neighbour counts and,
      in a second halo pass, the nearest core point below and above within eps.
    * Core points of one bucket always share an island, so islands are runs
      over the per-group table of core buckets (one row per occupied bucket,
      not per point); islands are numbered by their earliest input position.
      Both scans are two-level (``ranges``): a group's buckets may lie in
      any number of ranges and no window is over a whole group.
    * Border points take the lower-numbered of the (at most two) adjacent
      islands, the rest is noise (-1)."""
    g = list(group)
    part = ", ".join(f"`{c}`" for c in g)
    e = float(eps)
    pts = df.groupBy(*g, F.col(x).cast("double").alias("_x")).agg(
        F.count(F.lit(1)).alias("_m"), F.min(order).alias("_first"))
    pts = pts.withColumn("_b", F.floor(F.col("_x") / F.lit(e)).cast("long"))

    def halo(frame: DataFrame) -> DataFrame:
        return frame.withColumn("_tb", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)))

    nb = F.expr(f"sum(_m) OVER (PARTITION BY {part}, _tb ORDER BY _x "
                f"RANGE BETWEEN {e!r}D PRECEDING AND {e!r}D FOLLOWING)")
    counted = halo(pts).withColumn("_n", nb).where(F.col("_tb") == F.col("_b"))
    pts = checkpoint_parquet(counted.select(*g, "_x", "_m", "_first", "_b", (F.col("_n") >= min_samples).alias("_core")), "dbscan-points")

    core = pts.where("_core")
    cb = core.groupBy(*g, "_b").agg(F.min("_x").alias("_cmin"), F.max("_x").alias("_cmax"))
    cb = previous(in_ranges(cb, g, ["_b"], "core-buckets"), g, ["_b"], "_cmax", "_before")
    cb = cb.withColumn("_new", F.coalesce((F.col("_cmin") - F.col("_before")) > e, F.lit(True)).cast("int")).drop("_before")
    cb = running_total(cb, g, ["_b"], "_new", "_started").withColumn("_isl", F.col("_started") + F.col("_new"))
    core_isl = checkpoint_parquet(core.join(cb.select(*g, "_b", "_isl"), [*g, "_b"]), "core-islands")
    isl = in_ranges(core_isl.groupBy(*g, "_isl").agg(F.min("_first").alias("_f")), g, ["_f", "_isl"], "islands")
    isl = running_total(isl, g, ["_f", "_isl"], before="_lab")
    core_lab = core_isl.join(isl.select(*g, "_isl", "_lab"), [*g, "_isl"]).select(*g, "_x", "_lab")

    below = F.expr(f"max(CASE WHEN _core THEN _x END) OVER (PARTITION BY {part}, _tb ORDER BY _x "
                   f"RANGE BETWEEN {e!r}D PRECEDING AND CURRENT ROW)")
    above = F.expr(f"min(CASE WHEN _core THEN _x END) OVER (PARTITION BY {part}, _tb ORDER BY _x "
                   f"RANGE BETWEEN CURRENT ROW AND {e!r}D FOLLOWING)")
    near = halo(pts).withColumns({"_lo": below, "_hi": above}).where(
        (F.col("_tb") == F.col("_b")) & ~F.col("_core")).select(*g, "_x", "_lo", "_hi")
    lo_lab = core_lab.select(*g, F.col("_x").alias("_lo"), F.col("_lab").alias("_llo"))
    hi_lab = core_lab.select(*g, F.col("_x").alias("_hi"), F.col("_lab").alias("_lhi"))
    border = (near.join(lo_lab, [*g, "_lo"], "left").join(hi_lab, [*g, "_hi"], "left")
              .select(*g, "_x", F.coalesce(F.least("_llo", "_lhi"), F.lit(-1)).alias("_lab")))
    labels = core_lab.unionByName(border).select(*g, "_x", F.col("_lab").cast("int").alias(label))
    return (df.withColumn("_x", F.col(x).cast("double")).join(labels, [*g, "_x"], "left").drop("_x")
            .withColumn("anomalia_db", F.col(label) == -1))


# ------------------------------------------------------- label combination


def combine_labels(df: DataFrame, a: str, b: str) -> DataFrame:
    """lax = a OR b, strict = a AND b, as 0/1 ints (ANO3, SCL12; SCL11 ``when`` chains are used throughout)."""
    return df.withColumns({"brote": (F.col(a) | F.col(b)).cast("int"),
                           "brote_estricto": (F.col(a) & F.col(b)).cast("int")})


def cohen_kappa(df: DataFrame, group: list[str], a: str, b: str) -> DataFrame:
    """Agreement of two boolean labels per group (ANO4): (po - pe) / (1 - pe),
    NULL when pe = 1. One aggregate of contingency counts."""
    ai, bi = F.col(a).cast("int"), F.col(b).cast("int")
    agg = df.groupBy(*group).agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        F.sum(F.when(ai == bi, 1).otherwise(0)).alias("_agree"),
        F.sum(ai).cast("double").alias("_a1"), F.sum(bi).cast("double").alias("_b1"))
    n = F.col("_n")
    po = F.col("_agree") / n
    pe = (F.col("_a1") * F.col("_b1") + (n - F.col("_a1")) * (n - F.col("_b1"))) / (n * n)
    return agg.select(*group, F.col("_n").cast("long").alias("n"), po.alias("po"), pe.alias("pe"),
                      F.when(pe < 1, (po - pe) / (1 - pe)).alias("kappa"))


def label_summary(df: DataFrame, group: list[str], labels: list[str]) -> DataFrame:
    """Count of positive labels per group (ANO5)."""
    return df.groupBy(*group).agg(*[F.sum(F.col(c).cast("int")).alias(f"n_{c}") for c in labels],
                                  F.count(F.lit(1)).alias("n"))


def outbreak_months(df: DataFrame, group: list[str], order: str, flag: str = "brote",
                    keep: list[str] = ()) -> DataFrame:
    """The flagged rows listed per group in time order (ANO5)."""
    return df.where(F.col(flag) == 1).select(*group, order, *keep).orderBy(*group, order)
