"""Sharding by sampled splitters (operator 2, DataFrame functions only).

Records are ordered by the hash of their text, so equal texts are neighbours.
A size-weighted sample of these keys gives quantile boundaries; they cut the key
space into ``shards * pieces`` ranges of about equal bytes. A range that holds
far more than its share is subdivided along its keys, so equal texts stay
together; a text whose copies alone overfill a range is a piece of its own, and
only one that no shard could take is spread by the hash of the record id. The
pieces, a number bounded by the parameters, are then laid on the shards, largest
first on the lightest shard: the law is ``bytes``.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.sinks.writers import checkpoint_parquet

#: Ranges per shard, key samples per range, and the cells of the lookup table.
PIECES, SAMPLES, CELLS = 32, 16, 4096
#: A range above so many times its share is subdivided.
OVERFULL = 1.5
ROW_BYTES = 8
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1


def _cell(key):
    """The key space is the signed 64-bit range; a cell is one part of CELLS."""
    return F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(_LOWEST)), 64 - (CELLS.bit_length() - 1))


def splitters(records: DataFrame, ranges: int, total_bytes: int) -> DataFrame:
    """(range, low, high): ``ranges`` or fewer intervals (low, high] of the key
    space with about equal bytes, from a sample in which each record counts
    with a probability in proportion to its size."""
    wanted = ranges * SAMPLES
    rate = wanted / max(total_bytes, 1)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("draw"), "id_hash", "key"), 11).cast("double") / F.lit(2.0**53)
    hits = F.floor(F.col("size") * F.lit(rate) + draw).cast("int")
    sample = records.select("key", hits.alias("hits")).where("hits > 0")
    # the sample is bounded by the parameters: about ranges * SAMPLES keys, at whatever input
    by_key = sample.groupBy("key").agg(F.sum("hits").alias("hits"))
    run = F.sum("hits").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    cuts = (by_key.select("key", run.alias("run"), "hits")
            .where(F.floor(F.col("run") / SAMPLES) > F.floor((F.col("run") - F.col("hits")) / SAMPLES))
            .select(F.col("key").alias("high")))
    cuts = cuts.union(records.sparkSession.range(1).select(F.lit(_HIGHEST).cast("bigint").alias("high"))).distinct()
    w = Window.orderBy("high")
    return cuts.select((F.row_number().over(w) - 1).alias("range"),
                       F.coalesce(F.lag("high").over(w), F.lit(_LOWEST).cast("bigint")).alias("low"), "high")


def _lookup(cuts: DataFrame) -> DataFrame:
    """The intervals, repeated for each cell they meet: ranges + CELLS rows at most."""
    return cuts.select("range", "low", "high", F.explode(F.sequence(_cell("low"), _cell("high"))).alias("cell"))


def _lightest_first(pieces, shards: int) -> list[tuple]:
    """(range, big, part, sub, shard, first slot): largest first, on the shard with
    the fewest bytes; the subs of a text that one shard can take stay together.
    Bounded by the parameters, whatever the input."""
    whole: dict[tuple, list] = {}
    for p in pieces:
        whole.setdefault((p["range"], p["big"], p["part"], p["sub"] if p["spread"] else None), []).append(p)
    load = [(0, s) for s in range(shards)]
    rows = [0] * shards
    out = []
    for _, own in sorted(whole.items(), key=lambda w: (-sum(p["bytes"] for p in w[1]), [(p["range"], p["part"], p["sub"]) for p in w[1]])):
        held, shard = heapq.heappop(load)
        heapq.heappush(load, (held + sum(p["bytes"] for p in own), shard))
        for p in sorted(own, key=lambda p: p["sub"]):
            out.append((p["range"], p["big"], p["part"], p["sub"], shard, rows[shard]))
            rows[shard] += p["n"]
    return out


def shard(docs: DataFrame, shards: int = 24, pieces: int = PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 length of the text plus 8; a null text counts as empty
    (size 8, checksum 0). A null id is a key like any other. Equal texts share a
    shard unless they have more bytes than a shard's share of all; repeated rows
    get a slot each. Extra columns of ``docs`` are ignored; an empty table gives no
    rows. ``slot`` numbers the rows of a shard from 0 without gaps.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    records = checkpoint_parquet(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text).cast("bigint").alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.xxhash64(F.lit("id"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("id_hash")), "shard-records")
    total = records.agg(F.sum("size")).first()[0] or 0
    ranges = shards * pieces
    cuts = checkpoint_parquet(splitters(records, ranges, total), "shard-splitters")
    placed = (records.withColumn("cell", _cell("key")).join(F.broadcast(_lookup(cuts)), "cell")
              .where((F.col("key") > F.col("low")) & (F.col("key") <= F.col("high")) | (F.col("key") == F.lit(_LOWEST)) & (F.col("range") == 0))
              .select("doc_id", "size", "text_crc32", "key", "id_hash", "range", "low", "high"))
    share = max(total / ranges, 1.0)
    # texts that would overfill a range by their copies: ranges / OVERFULL keys at most
    big = records.groupBy("key").agg(F.sum("size").alias("own")).where(F.col("own") > OVERFULL * share).select(
        "key", F.ceil(F.col("own") / F.lit(share)).cast("int").alias("subs"), (F.col("own") > F.lit(total / shards)).alias("spread"))
    placed = placed.join(F.broadcast(big), "key", "left").withColumns({"big": F.col("subs").isNotNull(), "spread": F.coalesce("spread", F.lit(False))})
    parts = placed.where("NOT big").groupBy("range").agg(F.sum("size").alias("range_bytes")).select(
        "range", F.when(F.col("range_bytes") > OVERFULL * share, F.ceil(F.col("range_bytes") / F.lit(share))).otherwise(1).cast("int").alias("parts"))
    unit = F.shiftrightunsigned(F.col("id_hash"), 33).cast("double") / F.lit(2.0**31)
    along = (F.col("key").cast("double") - F.col("low").cast("double")) / (F.col("high").cast("double") - F.col("low").cast("double"))
    at_key = F.greatest(F.lit(0), F.least(F.col("parts") - 1, F.floor(along * F.col("parts")).cast("int")))
    placed = placed.join(F.broadcast(parts), "range", "left").select(
        "doc_id", "size", "text_crc32", "key", "id_hash", "range", "big", "spread", F.when(F.col("big"), F.col("key")).otherwise(at_key).alias("part"),
        F.when(F.col("big"), F.floor(unit * F.col("subs"))).otherwise(0).cast("int").alias("sub"))
    placed = checkpoint_parquet(placed, "shard-pieces")
    piece = ["range", "big", "part", "sub"]
    pieces_ = placed.groupBy(*piece).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("spread").alias("spread")).collect()
    plan = spark.createDataFrame(_lightest_first(pieces_, shards), "range int, big boolean, part bigint, sub int, shard int, first_slot bigint")
    in_piece = F.row_number().over(Window.partitionBy(*piece).orderBy("key", "id_hash", "doc_id"))
    return (placed.withColumn("row", in_piece).join(F.broadcast(plan), piece)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first_slot") + F.col("row") - 1).cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
