"""Supervised target helpers (SUP1-3): class weights, confusion metrics, exact
AUC, and a weighted logistic-regression baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n per class and the 'balanced' weight n_total / (n_classes * n_class) (SUP1)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # over <= a handful of class rows
    return c.withColumn("peso", F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n")))


def with_weights(df: DataFrame, label: str, weight: str = "peso") -> DataFrame:
    """Attach the class weight to each row (broadcast of the per-class table)."""
    return df.join(F.broadcast(class_weights(df, label).select(label, weight)), label, "left")


def binary_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Confusion counts, precision, recall, F1, accuracy in one aggregate (SUP2)."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    one = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    prec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    return one.withColumns({"precision": prec, "recall": rec}).withColumns({
        "f1": F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        "accuracy": (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")),
    })


def cumulative_sum(df: DataFrame, order: str, value: str, out: str, n_buckets: int = 1024,
                   inclusive: bool = True) -> DataFrame:
    """Running sum of ``value`` over the global order of a column with
    distinct values, without a single-partition window.

    Range buckets come from approximate quantiles (a bounded list); per-bucket
    totals (<= n_buckets rows) give each bucket's offset; the running sum
    inside a bucket is a window partitioned by bucket."""
    from pyspark.ml.feature import Bucketizer

    qs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = df.agg(F.percentile_approx(order, qs, 10_000).alias("b")).first()["b"] or []
    splits = [float("-inf")] + sorted({float(b) for b in bounds}) + [float("inf")]
    bz = Bucketizer(splits=splits, inputCol="_ord", outputCol="_bk", handleInvalid="keep")
    b = bz.transform(df.withColumn("_ord", F.col(order).cast("double")))
    totals = b.groupBy("_bk").agg(F.sum(value).alias("_t"))
    offsets = totals.select("_bk", F.coalesce(F.sum("_t").over(
        Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    frame = (Window.partitionBy("_bk").orderBy(order)
             .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = F.coalesce(F.sum(value).over(frame), F.lit(0))
    return (b.join(F.broadcast(offsets), "_bk").withColumn(out, F.col("_off") + local)
            .drop("_bk", "_ord", "_off"))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC with ties counted half (Mann-Whitney), distributed:
    scores are collapsed to distinct values with positive / negative counts,
    negatives below each score come from ``cumulative_sum``."""
    y = F.col(label).cast("int")
    d = df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))
    c = cumulative_sum(d, "_s", "_neg", "_neg_below", inclusive=False)
    return c.agg(F.try_divide(F.sum(F.col("_pos") * (F.col("_neg_below") + 0.5 * F.col("_neg"))),
                              F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"))


def logistic_baseline(df: DataFrame, features: list[str], label: str, weight: str | None = None,
                      max_iter: int = 100):
    """Weighted logistic regression on assembled features (SUP3). Returns the
    fitted model; ``model.transform`` scores any DataFrame."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    asm = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="_features", labelCol=label, maxIter=max_iter,
                            **({"weightCol": weight} if weight else {}))
    return Pipeline(stages=[asm, lr]).fit(df.withColumn(label, F.col(label).cast("double")))


FOLDS = 5


def held_out(key: str, folds: int = FOLDS) -> Column:
    """True for the rows of one fold, by the crc32 of their key: the same rows on every run and engine."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds == 0


def baseline_scores(df: DataFrame, features: list[str], label: str, key: str, folds: int = FOLDS, max_iter: int = 100) -> DataFrame:
    """``df`` with ``held_out``, ``score`` and ``predicted`` (score >= 0.5) of a logistic
    regression fitted on the other folds with balanced class weights (SUP1,
    SUP3). Null features count as 0, rows without a label are scored only."""
    rows = df.withColumn("held_out", held_out(key, folds)).fillna(0.0, subset=features)
    train = with_weights(rows.where(~F.col("held_out") & F.col(label).isNotNull()), label)
    fit = logistic_baseline(train, features, label, "peso", max_iter).stages[-1]
    logit = F.lit(float(fit.intercept))
    for c, w in zip(features, fit.coefficients):
        logit = logit + F.lit(float(w)) * F.col(c)
    out = rows.withColumn("score", 1 / (1 + F.exp(-logit)))
    return out.select(*df.columns, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
