"""A training corpus from ``documents``: each stage applies one operator of
``sentinela.llm`` to all that the one before kept, is written as Parquet and
reread. All stages but the last return the columns of the documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.llm import jaccard_join, line_dedup, mixing, packing, quality
from sentinela.session import ship_package, small_batches
from sentinela.sinks.writers import checkpoint_parquet
from sentinela.sources.testdata import table

#: Words of a shingle and least percentage of the similarity join; op1 has its own.
SHINGLE_WORDS, SHINGLE_PERCENT = 5, 80


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    small_batches(spark)


def _own_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = f"_{name}"
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, takes for good ones."""
    _prepare(spark)
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = _own_name(docs, "quality_score")
    return docs.withColumn(score, quality.quality_score(docs, model)).where(F.col(score) >= quality.THRESHOLD).drop(score)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occur elsewhere, or nearly; a document all of
    whose words stay elsewhere goes. ``n_chars`` is counted anew."""
    _prepare(spark)
    lines, dropped = _own_name(docs, "n_lines"), _own_name(docs, "n_dropped")
    found = line_dedup.drop_duplicate_lines(docs, lines_col=lines, dropped_col=dropped)
    found = found.where((F.col(dropped) == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    kind = dict(docs.dtypes).get("n_chars")
    if kind:
        found = found.withColumn("n_chars", F.when(F.col(dropped) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal sets of five-word shingles."""
    _prepare(spark)
    return jaccard_join.keep_one(docs, width=SHINGLE_WORDS, percent=SHINGLE_PERCENT)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of their sources."""
    _prepare(spark)
    return mixing.mixture(docs)


def in_written_order(docs: DataFrame) -> DataFrame:
    """``docs``, if they are Parquet files as Spark wrote them, in the order in
    which they were written; Spark reads files by their size. Other tables as
    they are, those computed from files too: their order is their own."""
    if docs._jdf.queryExecution().analyzed().children().nonEmpty():
        return docs
    try:
        file = docs.metadataColumn("_metadata")
        name = file["file_name"]
        part = F.regexp_extract(name, r"part-(\d+)", 1)
        keys = [F.when(part != "", part.cast("bigint")), name, file["row_index"]]
        keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[k.alias(f"key{i}") for i, k in enumerate(keys)])
    except AnalysisException:  # not files, or not Parquet
        return docs
    order = ["key0", "key1", "key2"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 token ids, which ascend with the mixture
    by groups of packing.GROUP documents."""
    _prepare(spark)
    _prepare(spark)
    columns = [F.col(f"`{c}`") for c in docs.columns if c in ("doc_id", "text")]
    return packing.pack(in_written_order(docs).select(*columns))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", source_mixing),
    ("packing", sequence_packing),
]
#: Classifier, similarity join and tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages make of the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checkpoint_parquet(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
