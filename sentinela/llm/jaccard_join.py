"""N-gram Jaccard self-join over signature trees (operator 1).

A document is the set of its shingles (64-bit hashes) of ``width`` words, 4
unless given. Two documents link when 100 * intersection >= percent * union,
percent being 85 unless given. The join is exact, here for 85:

1. Equal texts become one node.
2. Shingles have a global order, frequent ones last (their counts are kept in a
   fixed array of counters over all documents). Linked sets share one of their
   first n - ceil(0.85 n) + 1 shingles in that order, so the shingles of these
   prefixes are the children of the forest's root: only nodes under one child
   can have the overlap that is needed. Sets of like sizes must share many of
   these first shingles, as the rest is too short to make up for them.
3. Families first: documents that agree in a minimum hash are compared in blocks
   of bounded size, and connected. Where all of a child's documents are in one
   component there is nothing left to find under it.
4. Under every other child the documents are sorted by component and size and
   form a tree: a node holds the OR of its documents' token bitmaps, its size
   range and its largest bit surplus. Both sides descend together; a pair of
   nodes is dropped when its size ranges, or the most tokens that the common
   bits can hold, rule out a link, or when both are in one component. A pair of
   documents is taken under its first common child: it is passed over where the
   shingles before are equal too, or where too few come after. Of each pair that
   remains the prefixes are compared, then the documents shingle by shingle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.graph import components
from sentinela.llm.line_dedup import small
from sentinela.llm.textops import batches_of, mix, shingle_hashes, word_hashes
from sentinela.llm.trees import block_pairs, cut, pair_rows, runs, whole_runs
from sentinela.sinks.writers import checkpoint_parquet

#: Words of a shingle and least percentage, unless given.
WIDTH, PERCENT = 4, 85
#: Counters of shingles (a power of two) and parts they are summed in; words of 64 bits in a bitmap.
COUNTERS, SLICES, WORDS = 1 << 21, 16, 16
#: Documents of a block, of families and of trees; minimum hashes.
BLOCK, HASHES = 256, 2

_SIGNATURE = [f"s{i}" for i in range(WORDS)]
_NODE = "n bigint, bits bigint, " + ", ".join(f"{s} bigint" for s in _SIGNATURE)


def _sort_within(values: np.ndarray, of: np.ndarray) -> None:
    for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()


def sets_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, and n + 1 offsets."""
    flat, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in batches_of(column):
        shingles, of = shingle_hashes(*word_hashes(column.slice(i, j - i)), width)
        _sort_within(shingles, of)
        first = np.ones(len(shingles), dtype=bool)
        first[1:] = shingles[1:] != shingles[:-1]
        first[of[:-1][np.diff(of) > 0]] = True
        flat.append(shingles[first])
        sizes.append(np.diff(np.concatenate([[0], np.cumsum(first)])[of]))
    return np.concatenate(flat), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles, 21) & np.uint64(COUNTERS - 1)).astype(np.int64)


def shingle_counts(docs: DataFrame, words: int) -> np.ndarray:
    """How many shingles of ``words`` words of all ``docs`` (text) fall on each counter: a fixed
    array per task, summed part by part."""
    width = COUNTERS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for i, j in batches_of(batch.column(0)):
                total += np.bincount(_counter(shingle_hashes(*word_hashes(batch.column(0).slice(i, j - i)), words)[0]), minlength=COUNTERS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES)), pa.array([zlib.compress(total[i * width:(i + 1) * width].tobytes(), 1) for i in range(SLICES)], pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(zlib.decompress(counts), np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())], names=["part", "counts"])

    schema = "part bigint, counts binary"
    total = np.zeros(COUNTERS, np.int64)
    for r in docs.select("text").mapInArrow(count, schema).repartition(SLICES, "part").mapInArrow(add, schema).collect():
        total[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return total


def ranks(counts: np.ndarray) -> np.ndarray:
    """The class of each counter: 0 up to four deviations above the mean load, then
    one more for each doubling of what is above it."""
    mean = max(counts.mean(), 1.0)
    above = np.maximum(counts - mean, 0) / (4 * np.sqrt(mean))
    return np.where(above < 1, 0, 1 + np.floor(np.log2(np.maximum(above, 1)))).astype(np.uint8)


def _describe(classes, width: int, percent: int):
    """Per text: size, bitmap, bits, minimum hashes and the prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = classes.value
        for batch in batches:
            for i, j in batches_of(batch.column(3)):
                tokens, of = sets_of(batch.column(3).slice(i, j - i), width)
                n = np.diff(of)
                text = np.repeat(np.arange(j - i), n)
                bit = (mix(tokens, 22) & np.uint64(64 * WORDS - 1)).astype(np.int64)
                flags = np.zeros((j - i, 64 * WORDS), dtype=np.uint8)
                flags[text, bit] = 1
                bitmaps = np.packbits(flags, axis=1, bitorder="little").view("<i8")
                low = rank[_counter(tokens)].astype(np.uint64) << np.uint64(56)
                full = np.flatnonzero(n)
                least = []
                for k in range(HASHES):
                    first = np.zeros(j - i, np.uint64)
                    if len(full):
                        first[full] = np.minimum.reduceat(mix(tokens, 31 + k), of[:-1][full])
                    least.append(first.view(np.int64))
                place = low | (mix(tokens, 30) >> np.uint64(8))  # in the global order: the class, then a hash
                _sort_within(place, of)
                length = np.where(n > 0, n - -(-n * percent // 100) + 1, 0)
                prefix_of = np.concatenate([[0], np.cumsum(length)])
                take = np.repeat(of[:-1] - prefix_of[:-1], length) + np.arange(prefix_of[-1])
                prefix = pa.ListArray.from_arrays(pa.array(prefix_of.astype(np.int32)), pa.array(place[take].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in range(3)), pa.array(n), pa.array(flags.sum(axis=1).astype(np.int64)),
                     *(pa.array(np.ascontiguousarray(bitmaps[:, k])) for k in range(WORDS)), *(pa.array(x) for x in least), prefix],
                    names=["doc_id", "h1", "h2", "n", "bits", *_SIGNATURE, *(f"m{k}" for k in range(HASHES)), "prefix"])

    return run


def _overlaps(tokens: np.ndarray, of: np.ndarray):
    """A function that gives the intersection of set i with every set."""
    _, dense = np.unique(tokens, return_inverse=True)
    marked = np.zeros(dense.max() + 1 if len(dense) else 1, dtype=np.int32)
    full = np.flatnonzero(np.diff(of))

    def of_one(i: int) -> np.ndarray:
        own = dense[of[i]:of[i + 1]]
        marked[own] = 1
        out = np.zeros(len(of) - 1, np.int64)
        out[full] = np.add.reduceat(marked[dense], of[:-1][full])
        marked[own] = 0
        return out

    return of_one


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect the documents of each block, as many as need be; the
    rows bring the width and percent."""
    for _, rows in runs(batches):
        width, percent = (rows[c][0].as_py() for c in ("width", "percent"))
        ids, first = np.unique(rows["node"].to_numpy(), return_index=True)
        tokens, of = sets_of(rows["text"].combine_chunks().take(pa.array(first)), width)
        n, root = np.diff(of), np.arange(len(ids))
        overlap = _overlaps(tokens, of)
        a, b = [], []
        for i in range(len(ids)):
            if (root == root[0]).all():
                break
            common = overlap(i)
            linked = np.flatnonzero((100 * common >= percent * (n[i] + n - common)) & (n > 0) & (root != root[i]))
            for j in linked:
                if root[j] != root[i]:
                    a.append(ids[i])
                    b.append(ids[j])
                    root[root == root[j]] = root[i]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a)), pa.array(np.array(b))], names=["a", "b"])


def _pairs_of_runs(bounds: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, rows) of the pairs within each run, in pieces: across the sides
    where a run has two, else all; runs of one size are treated together."""
    sizes = np.diff(bounds)
    for m in np.unique(sizes[sizes > 1]):
        starts = bounds[:-1][sizes == m]
        a, b = np.triu_indices(int(m), 1)
        for k in range(0, len(starts), max(1, 200_000 // len(a))):
            own = starts[k:k + max(1, 200_000 // len(a)), None]
            i, j = (own + a[None, :]).ravel(), (own + b[None, :]).ravel()
            two = np.repeat(side[own[:, 0] + m - 1] == 1, len(a))
            ok = ~two | (side[i] != side[j])
            yield i[ok], j[ok]


def _candidates(percent: int):
    """Pairs of documents of two leaves, with their sizes, that their bitmaps and the places of
    the child in their prefixes do not rule out. A pair under many children comes once for each
    stretch of its common shingles at most: where the shingles before the child are equal, it
    is found under those."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_runs(batches):
            ids, n, comp, side, pos, before = (rows[c].to_numpy() for c in ("node", "n", "component", "side", "pos", "before"))
            bits = np.stack([rows[s].to_numpy().view(np.uint64) for s in _SIGNATURE], axis=1)
            surplus = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
            for x, y in _pairs_of_runs(bounds, side):
                apart = (comp[x] != comp[y]) & (100 * n[x] >= percent * n[y]) & (100 * n[y] >= percent * n[x])
                apart &= (before[x] != before[y]) | (pos[x] == 0) | (pos[y] == 0)
                x, y = x[apart], y[apart]
                most = np.bitwise_count(bits[x] & bits[y]).sum(axis=1).astype(np.int64) + np.minimum(surplus[x], surplus[y])
                # under the first common child, nothing before it is common
                most = np.minimum(most, np.minimum(n[x] - pos[x], n[y] - pos[y]))
                good = 100 * most >= percent * (n[x] + n[y] - most)
                if good.any():
                    a, b, m, k = ids[x[good]], ids[y[good]], n[x[good]], n[y[good]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(np.maximum(m, k)), pa.array(m + k)], names=["a", "b", "larger", "both"])

    return run


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, x_of), (y, y_of) = sets_of(batch.column(2), width), sets_of(batch.column(3), width)
            keep = []
            for i in range(batch.num_rows):
                s, t = x[x_of[i]:x_of[i + 1]], y[y_of[i]:y_of[i + 1]]
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(bool(len(s)) and 100 * common >= percent * (len(s) + len(t) - common))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], names=["a", "b"])

    return run


def _texts(nodes: DataFrame, wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes; the texts of all others are not moved."""
    places = checkpoint_parquet(wanted.distinct().join(nodes, "node").select("node", "doc_id", "h1", "h2"), "jaccard-places")
    return checkpoint_parquet(docs.join(small(places), ["doc_id", "h1", "h2"]).select("node", "text").dropDuplicates(["node"]), "jaccard-texts")


def links(nodes: DataFrame, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(a, b) pairs of nodes that link, enough of them to connect all that do."""
    nodes = nodes.where("n > 0")
    # families: blocks of documents that agree in a minimum hash
    agreed = [nodes.select("node", F.lit(k).alias("k"), F.col(f"m{k}").alias("hash")) for k in range(HASHES)]
    agreed = reduce(DataFrame.union, agreed)
    sizes = agreed.groupBy("k", "hash").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    agreed = agreed.join(sizes, ["k", "hash"])
    block = F.xxhash64("k", "hash", F.pmod(F.xxhash64("node", "k"), F.ceil(F.col("size") / F.lit(BLOCK))))
    agreed = checkpoint_parquet(agreed.select("node", block.alias("key")), "jaccard-families")
    texts = _texts(nodes, agreed.select("node"), docs)
    found = checkpoint_parquet(agreed.join(texts, "node").repartition("key").sortWithinPartitions("key", "node")
                               .select("key", "node", "text", F.lit(width).alias("width"), F.lit(percent).alias("percent")).mapInArrow(_families, "a bigint, b bigint").distinct(), "jaccard-families")
    # the rest: children of the root that hold more than one component
    member = components(found, "jaccard-components")
    placed = nodes.join(member, "node", "left").withColumn("component", F.coalesce("component", "node")).select(
        "node", "component", "n", "bits", *_SIGNATURE, "prefix")
    placed = checkpoint_parquet(placed, "jaccard-placed")
    under = placed.select(F.posexplode("prefix").alias("pos", "bucket"), "component", "node", "prefix")
    under = under.select("bucket", "pos", F.coalesce(F.get("prefix", F.col("pos") - 1), F.lit(0)).alias("before"), "component", "node")
    mixed = under.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
    mixed = small(checkpoint_parquet(mixed, "jaccard-mixed"))
    rows = under.drop("component").join(mixed, "bucket").join(placed.drop("prefix"), "node")
    rows = checkpoint_parquet(cut(rows.select("bucket", "component", "n", "node", "pos", "before", "bits", *_SIGNATURE), ["component", "n", "node"], BLOCK), "jaccard-leaves")
    merged = {"least": F.min, "most": F.max, "surplus": F.max, "from_c": F.min, "to_c": F.max} | {s: F.bit_or for s in _SIGNATURE}
    leaves = rows.groupBy("bucket", "block").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("bits")).alias("surplus"),
        F.min("component").alias("from_c"), F.max("component").alias("to_c"), *[F.bit_or(s).alias(s) for s in _SIGNATURE])

    def may_link(a: str, b: str):
        x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
        shared = sum((F.bit_count(x(s).bitwiseAND(y(s))) for s in _SIGNATURE[1:]), F.bit_count(x(_SIGNATURE[0]).bitwiseAND(y(_SIGNATURE[0]))))
        sizes = (x("most") * 100 >= y("least") * percent) & (y("most") * 100 >= x("least") * percent)
        overlap = (shared + F.least(x("surplus"), y("surplus"))) * 100 >= F.greatest(x("least"), y("least")) * percent
        one = (x("from_c") == x("to_c")) & (y("from_c") == y("to_c")) & (x("from_c") == y("from_c"))
        return sizes & overlap & ~one

    pairs = block_pairs(leaves, merged, may_link, "jaccard-tree").where("left <= right")
    open_ = pair_rows(pairs.select("left", "right"), rows.select("block", "node", "component", "n", "pos", "before", *_SIGNATURE))
    met = (open_.select("key", "side", "node", "component", "n", "pos", "before", *_SIGNATURE)
           .mapInArrow(_candidates(percent), "a bigint, b bigint, larger bigint, both bigint").distinct())
    met = checkpoint_parquet(met, "jaccard-met")
    wanted = small(checkpoint_parquet(met.select(F.col("a").alias("node")).union(met.select("b")).distinct(), "jaccard-wanted"))
    prefixes = checkpoint_parquet(placed.select("node", "prefix").join(wanted, "node"), "jaccard-prefixes")
    met = (met.join(prefixes.select(F.col("node").alias("a"), F.col("prefix").alias("x")), "a")
           .join(prefixes.select(F.col("node").alias("b"), F.col("prefix").alias("y")), "b"))
    # of the overlap that is needed, at most ceil(n percent / 100) - 1 shingles lie behind a prefix
    behind = F.ceil(F.col("larger") * percent / F.lit(100)) - 1
    needed = F.ceil(F.col("both") * percent / F.lit(100 + percent)) - behind
    maybe = checkpoint_parquet(met.where(F.size(F.array_intersect("x", "y")) >= needed).select("a", "b"), "jaccard-candidates")
    texts = _texts(nodes, maybe.select(F.col("a").alias("node")).union(maybe.select("b")), docs)
    both = (maybe.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y"))
    return found.union(checkpoint_parquet(both.mapInArrow(_verify(width, percent), "a bigint, b bigint"), "jaccard-links"))


def _identity(id_col: str, text_col: str) -> list:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.col(id_col).cast("bigint"), F.xxhash64(text), F.xxhash64(F.lit("text"), text), text]


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*[c.alias(n) for n, c in zip(("doc_id", "h1", "h2", "text"), _identity(id_col, text_col))])


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(h1, h2, n, doc_id, component): the distinct texts of rows with an id, the
    smallest id of each, and the node that stands for its group."""
    known = docs.where("doc_id IS NOT NULL")
    classes = docs.sparkSession.sparkContext.broadcast(ranks(shingle_counts(known, width)))  # COUNTERS bytes
    schema = f"doc_id bigint, h1 bigint, h2 bigint, {_NODE}, " + ", ".join(f"m{k} bigint" for k in range(HASHES)) + ", prefix array<bigint>"
    described = known.select("doc_id", "h1", "h2", "text").mapInArrow(_describe(classes, width, percent), schema)
    payload = ["n", "bits", *_SIGNATURE, *(f"m{k}" for k in range(HASHES)), "prefix"]
    nodes = described.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.first(F.struct(*payload)).alias("p"))
    nodes = checkpoint_parquet(nodes.select(F.monotonically_increasing_id().alias("node"), "doc_id", "h1", "h2", "p.*"), "jaccard-nodes")
    member = components(links(nodes, known, width, percent), "jaccard-components")
    return nodes.select("node", "h1", "h2", "n", "doc_id").join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    The component of a document without words (null, empty or blank text) is
    its own id. Rows with a null id take no part: their n_shingles and
    component_id are null. Repeated rows are equal texts and share a component;
    texts of any length are compared whole. Other columns are ignored; an empty
    table gives no rows.
    """
    docs = _identified(docs, id_col, text_col)
    named = _grouped(docs, width, percent)
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.drop("doc_id").join(least, "component").select("h1", "h2", "n", "component_id")
    found = docs.select("doc_id", "h1", "h2").join(named, ["h1", "h2"], "left")
    return found.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("n")).alias("n_shingles"),
                        F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the smallest id, of its texts
    the one of the smallest hash. Documents without words, and rows with a null
    id, all stay; of rows that repeat an id and a text one stays."""
    rows = _identified(docs, id_col, text_col)
    named = _grouped(rows, width, percent)
    first = F.min(F.struct("doc_id", "h1", "h2"))
    kept = named.where("n > 0").groupBy("component").agg(first.alias("k")).select("k.*").union(
        rows.where("doc_id IS NOT NULL").join(named.where("n = 0").select("h1", "h2"), ["h1", "h2"], "left_semi").select("doc_id", "h1", "h2").distinct())
    often = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "h1", "h2").agg(F.count(F.lit(1)).alias("times"))
    kept = small(checkpoint_parquet(kept.join(often, ["doc_id", "h1", "h2"]), "jaccard-kept"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("_row"), *[c.alias(f"_{n}") for n, c in zip(("id", "h1", "h2"), _identity(id_col, text_col))])
    found = keyed.join(kept, (F.col("_id") == F.col("doc_id")) & (F.col("_h1") == F.col("h1")) & (F.col("_h2") == F.col("h2")))
    once = found.where("times = 1").select("_row.*")
    repeated = found.where("times > 1").dropDuplicates(["doc_id", "h1", "h2"]).select("_row.*")
    return once.union(repeated).union(keyed.where("_id IS NULL").select("_row.*"))
