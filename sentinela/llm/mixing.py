"""Mixing sources to target weights by Pfair scheduling (operator 3).

The documents of a source, in an order of their hashes, form blocks of equal
bytes. Weights become whole counts c of P slots: block i of a source is released
at slot floor(i P / c) and due by slot ceil((i + 1) P / c), and every slot goes
to the released block that is due first. The schedule repeats after P slots, so
one period of it is made, whatever the input, and a block finds its slot by
arithmetic. At every slot each source has had its share of the slots so far,
give or take less than one block. When a source has no blocks left, a new phase
starts and shares are those of the remaining sources. Every row keeps its place
in the mixture exactly once; nothing is dropped or repeated.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.sinks.writers import checkpoint_parquet

#: Bytes of a block, least slots of a period, parts of a source whose sizes are added up at once.
BLOCK_BYTES, PERIOD, PARTS = 1 << 16, 1024, 1024
#: Without given weights, a source weighs its bytes to this power.
TEMPERATURE = 0.7


def counts(weights: list[float], period: int) -> list[int]:
    """Whole slots of a period in proportion to the weights, one at least."""
    total = sum(weights)
    exact = [max(1.0, w / total * period) for w in weights]
    scale = period / sum(exact)
    found = [max(1, int(e * scale)) for e in exact]
    order = sorted(range(len(found)), key=lambda s: (found[s] - exact[s] * scale, s))
    i = 0
    while sum(found) < period:
        found[order[i % len(order)]] += 1
        i += 1
    while sum(found) > period:
        found[max(range(len(found)), key=lambda s: found[s])] -= 1
    return found


def earliest_deadline_first(shares: list[int]) -> list[int]:
    """The source of each slot of one period of sum(shares) slots."""
    period = sum(shares)
    released = [(-(-period // c), s, 0) for s, c in enumerate(shares)]  # (deadline, source, block)
    heapq.heapify(released)
    later: list[tuple[int, int, int, int]] = []
    out = []
    for slot in range(period):
        while later and later[0][0] <= slot:
            _, deadline, s, i = heapq.heappop(later)
            heapq.heappush(released, (deadline, s, i))
        _, s, i = heapq.heappop(released)
        out.append(s)
        if i + 1 < shares[s]:
            heapq.heappush(later, ((i + 1) * period // shares[s], -(-(i + 2) * period // shares[s]), s, i + 1))
    return out


def phases(sources: list[tuple[object, int, float]], period: int = PERIOD) -> list[tuple]:
    """(source, phase, first block, blocks, first slot, period, positions) for
    (source, blocks, weight) triples: block ``first + i`` of a phase has slot
    ``first slot + i // c * period + positions[i % c]``, c being their number.
    Sources of weight 0 share the slots after all others."""
    left = {k: n for k, (_, n, _) in enumerate(sources)}
    done = dict.fromkeys(left, 0)
    rows, slot, phase = [], 0, 0
    while live := [k for k in left if left[k] > 0]:
        weighted = [k for k in live if sources[k][2] > 0]
        live = weighted or live
        p = max(period, 4 * len(live))
        shares = counts([sources[k][2] if weighted else 1.0 for k in live], p)
        order = earliest_deadline_first(shares)
        positions: list[list[int]] = [[] for _ in live]
        for at, s in enumerate(order):
            positions[s].append(at)
        rounds = min(left[k] // c for k, c in zip(live, shares))
        # then part of a period, up to the first slot for which a source has no block
        ends = [positions[s][left[k] - rounds * c] for s, (k, c) in enumerate(zip(live, shares)) if left[k] - rounds * c < c]
        end = min(ends)
        for s, (k, c) in enumerate(zip(live, shares)):
            n = rounds * c + sum(at < end for at in positions[s])
            if n:
                rows.append((sources[k][0], phase, done[k], n, slot, p, positions[s]))
            done[k] += n
            left[k] -= n
        slot += rounds * p + end
        phase += 1
    return rows


def mix(docs: DataFrame, weights: dict | None = None, block_bytes: int = BLOCK_BYTES, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
        prefix: str = "mix_") -> DataFrame:
    """``docs`` with ``{prefix}bytes``, ``block``, ``phase``, ``slot`` and ``start``
    (bytes of the source before the row); sorted by slot and start the rows are
    the mixture. Columns of these names are replaced, all others stay.

    A null source is a source of its own. Null and empty texts count one byte.
    A long text lies in the block where it starts and takes the room of the
    next ones. Equal rows have places of their own. Sources without a given
    weight come after all others. An empty table gives no rows. One row per
    source comes to the driver.
    """
    spark = docs.sparkSession
    names = {c: prefix + c for c in ("bytes", "block", "phase", "slot", "start")}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names.values()])
    size = F.greatest(F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)), F.lit(1)).cast("bigint")
    order = F.xxhash64(F.lit("mix"), F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(source_col).alias("_source"), size.alias(names["bytes"]), order.alias("_order"), F.pmod(order, F.lit(PARTS)).alias("_part"), F.struct("*").alias("_row"))
    parts = checkpoint_parquet(rows.groupBy("_source", "_part").agg(F.sum(names["bytes"]).alias("part_bytes")), "mix-parts")
    before = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("_source").alias("s"), F.col("_part").alias("p"), F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("part_start"))
    totals = parts.groupBy("_source").agg(F.sum("part_bytes").alias("n")).collect()
    weigh = (lambda s, n: float(weights.get(s, 0.0))) if weights is not None else (lambda s, n: float(n) ** TEMPERATURE)
    sources = sorted(((r["_source"], -(-r["n"] // block_bytes), weigh(r["_source"], r["n"])) for r in totals), key=lambda x: (x[0] is not None, str(x[0])))
    kind = dict(rows.dtypes)["_source"]
    plan = spark.createDataFrame(phases(sources), f"s {kind}, phase int, first bigint, blocks bigint, first_slot bigint, period bigint, positions array<int>")
    part = Window.partitionBy("_source", "_part").orderBy("_order", names["bytes"]).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum(names["bytes"]).over(part), F.lit(0)))
    placed = placed.join(starts, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_part") == F.col("p"))).drop("s", "p")
    placed = placed.withColumn(names["start"], F.col("_before") + F.col("part_start")).withColumn(names["block"], F.floor(F.col(names["start"]) / F.lit(block_bytes)).cast("bigint"))
    block = F.col(names["block"])
    placed = placed.join(F.broadcast(plan), F.col("_source").eqNullSafe(F.col("s")) & (block >= F.col("first")) & (block < F.col("first") + F.col("blocks")))
    i = block - F.col("first")
    share = F.size("positions").cast("bigint")
    slot = F.col("first_slot") + F.floor(i / share).cast("bigint") * F.col("period") + F.get("positions", F.pmod(i, share).cast("int"))
    return placed.select("_row.*", names["bytes"], names["block"], F.col("phase").alias(names["phase"]), slot.cast("bigint").alias(names["slot"]), names["start"])


def mixture(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """The rows of ``docs`` in the order of the mixture."""
    placed = mix(docs, weights, prefix="_mix_")
    return placed.repartitionByRange("_mix_slot", "_mix_start").sortWithinPartitions("_mix_slot", "_mix_start").select(*[F.col(f"`{c}`") for c in docs.columns])
