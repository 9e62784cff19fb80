"""Fuzzy line deduplication (operator 10, DataFrame functions only).

Lines are normalised (lower case, runs of anything but letters and digits
become one space). Equal lines of any length are one node each. A node's 64-bit
SimHash over its distinct words (runs of characters where it has fewer than
four; a script without spaces has a word per stretch) is cut into five blocks; two hashes that differ in at most three bits
agree in two blocks at least, so nodes meet on the ten pairs of blocks. In each
meeting every node is compared with the first one, and in one of up to four with
all others; larger meetings that still span several components are then compared
across the components, so no link is lost and a large family costs its size, not its square. Candidates
within three bits are linked when their edit similarity is high enough. Of each
connected group the first occurrence in the corpus stays.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.llm.graph import components
from sentinela.sinks.writers import checkpoint_parquet

#: Lines of fewer words are hashed by characters. Most differing bits, least edit similarity.
MIN_WORDS, BITS, SIMILARITY = 4, 3, 0.85
#: First bit and width of the blocks: BITS + 2 of them.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Words whose bits are counted by adders of columns; those of longer lines in lanes of 8 bits, CHUNK
#: words at a time; counts of so many chunks fit lanes of 16.
FLAT, CHUNK, WIDE_CHUNKS = 255, 120, 250
#: Nodes of a meeting in which all are compared at once (first, last and last but one reach no more).
FEW = 4
#: A side of at most so many short rows is broadcast after it was counted; a longer one is shuffled.
BROADCAST_ROWS = 1_000_000

#: Characters of a feature of a line without so many words.
GRAM = 3
_BYTES, _SHORTS = 0x0101010101010101, 0x00FF00FF00FF00FF


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def features(norm: Column) -> Column:
    """What the SimHash of a normalised line is taken over: its words, or with
    fewer than MIN_WORDS its runs of GRAM characters (all of it if shorter)."""
    words, chars = F.split(norm, " "), F.split(norm, "")
    # the array comes in as a lambda variable, so that it is made once a line
    grams = F.flatten(F.transform(F.array(chars), lambda c: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(c) - GRAM, F.lit(0))), lambda i: F.array_join(F.slice(c, i + 1, GRAM), ""))))
    # the words are counted by their spaces, so that only one of the two is split
    return F.when(F.substring_index(norm, " ", MIN_WORDS - 1) != norm, words).otherwise(grams)


def _lanes(hashes: Column) -> Column:
    """Counts of the 64 bits over at most CHUNK hashes: byte j of l{i} counts bit i + 8 j."""
    zero = F.struct(*[F.lit(0).cast("bigint").alias(f"l{i}") for i in range(8)])

    def add(sums, h):
        return F.struct(*[(sums[f"l{i}"] + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_BYTES))).alias(f"l{i}") for i in range(8)])

    return F.aggregate(hashes, zero, add)


def _wide(chunks: Column) -> Column:
    """The lanes of up to WIDE_CHUNKS chunks added up: 16-bit lane j of w{i} counts
    bit i + 16 j, of w{i + 8} bit i + 8 + 16 j."""
    zero = F.struct(*[F.lit(0).cast("bigint").alias(f"w{i}") for i in range(16)])

    def add(sums, c):
        return F.struct(*[(sums[f"w{i}"] + (c[f"l{i}"] if i < 8 else F.shiftrightunsigned(c[f"l{i - 8}"], 8)).bitwiseAND(F.lit(_SHORTS))).alias(f"w{i}") for i in range(16)])

    return F.aggregate(chunks, zero, add)


def _flat_majority(lines: DataFrame) -> DataFrame:
    """``lines`` with ``_flat``, the bits that more than half of the first FLAT of
    ``_hashes`` have. The 64 counts are kept bit by bit: a column of level w holds
    their bits of weight 2^w. Four full adders make one column of seven of a level
    and carry one into each of the next two; a single one does so for the last three
    or two, until each level has one column. Plain operations on columns, which Spark
    compiles; what four adders share is computed once."""
    def total(x: str, y: str, z: str) -> str:
        return f"({x} ^ {y} ^ {z})"

    def carry(x: str, y: str, z: str) -> str:
        return f"(({x} & {y}) | ({z} & ({x} | {y})))"

    own, n = [f"`{c}`" for c in lines.columns], FLAT
    level = {0: [f"_b{i}" for i in range(FLAT)]}
    # named first: the adders repeat their inputs, and the driver plans every repeat
    lines = lines.selectExpr(*own, *[f"coalesce(get(_hashes, {i}), 0L) AS _b{i}" for i in range(FLAT)])
    while any(len(x) > 1 for x in level.values()):
        after, kept = {w: [] for w in range(FLAT.bit_length())}, []
        for weight, left in level.items():
            while len(left) > 1:
                if len(left) >= 7:
                    (a, b, c, d, e, f, g), left = left[:7], left[7:]
                    low, high = total(a, b, c), total(d, e, f)
                    carries = carry(a, b, c), carry(d, e, f), carry(low, high, g)
                    made = [total(low, high, g), total(*carries), carry(*carries)]
                else:
                    (x, y, *z), left = left[:3], left[3:]
                    made = [total(x, y, z[0]), carry(x, y, z[0])] if z else [f"({x} ^ {y})", f"({x} & {y})"]
                for up, bits in enumerate(made):
                    if weight + up in after:  # no count passes FLAT
                        after[weight + up].append(f"_b{n}")
                        kept.append(f"{bits} AS _b{n}")
                        n += 1
            for bits in left:
                after[weight].append(f"_b{n}")
                kept.append(f"{bits} AS _b{n}")
                n += 1
        lines, level = lines.selectExpr(*own, *kept), {w: x for w, x in after.items() if x}
    greater = "0L"
    for weight, (count,) in sorted(level.items()):  # a count is greater if it is so in its highest bit that differs
        bit = f"-(shiftrightunsigned(n_words, {weight + 1}) & 1)"
        greater = f"(({count} & ~({bit})) | (~({count} ^ ({bit})) & {greater}))"
    return lines.selectExpr(*own, f"{greater} AS _flat")


def _long_majority(chunks: Column, wide: Column, n_words: Column) -> Column:
    """The same bits of more hashes, from their chunks, bit by bit in a loop."""
    def count(bit: Column) -> Column:
        i, byte = bit % 8, F.floor(bit / 8).cast("int")
        shifted = lambda x, by: F.call_function("shiftrightunsigned", x, by.cast("int"))
        few = shifted(F.get(F.array(*[wide[f"w{k}"] for k in range(16)]), i + 8 * (byte % 2)), 16 * F.floor(byte / 2)).bitwiseAND(F.lit(0xFFFF))
        many = F.aggregate(chunks, F.lit(0).cast("bigint"), lambda a, c: a + shifted(F.get(F.array(*[c[f"l{k}"] for k in range(8)]), i), 8 * byte).bitwiseAND(F.lit(0xFF)))
        return F.when(F.size(chunks) <= WIDE_CHUNKS, few).otherwise(many)

    one = lambda bit: F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"),
                       lambda sim, bit: sim.bitwiseOR(F.when(count(bit) * 2 > n_words, one(bit)).otherwise(F.lit(0).cast("bigint"))))


def with_simhash(lines: DataFrame) -> DataFrame:
    """``lines`` (words array<string> not empty) with ``n_words``, the number of
    distinct words, and ``sim``."""
    # the distinct ones of longs cost less than those of strings
    lines = lines.withColumn("_hashes", F.array_distinct(F.transform("words", lambda w: F.xxhash64(w))))
    lines = _flat_majority(lines.withColumn("n_words", F.size("_hashes")))
    parts = F.sequence(F.lit(0), F.floor((F.col("n_words") - 1) / CHUNK).cast("int"))
    is_long = F.col("n_words") > FLAT
    lines = lines.withColumn("_chunks", F.when(is_long, F.transform(parts, lambda c: _lanes(F.slice(F.col("_hashes"), c * CHUNK + 1, CHUNK)))))
    lines = lines.withColumn("_wide", F.when(F.size("_chunks") <= WIDE_CHUNKS, _wide(F.col("_chunks"))))
    sim = F.when(is_long, _long_majority(F.col("_chunks"), F.col("_wide"), F.col("n_words"))).otherwise(F.col("_flat"))
    return lines.withColumn("sim", sim).drop("_flat", "_chunks", "_wide", "_hashes")


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with a letter or digit: document, place, text and hashes."""
    own = F.transform(F.split(F.col(text_col), "\n"), normalised)
    # the outer form, as the other one also puts a condition on the array below, which makes it twice
    lines = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.posexplode_outer(own).alias("pos", "norm"))
    lines = lines.where("norm != ''")
    lines = lines.withColumn("words", features(F.col("norm")))
    return with_simhash(lines).select("doc_id", "text_hash", "pos", "norm", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit("line"), "norm").alias("h2"),
                                      F.length("norm").alias("len"), "sim")


def _keys(sim: Column) -> Column:
    part = [F.shiftrightunsigned(sim, at).bitwiseAND(F.lit((1 << width) - 1)) for at, width in BLOCKS]
    pairs = combinations(range(len(BLOCKS)), 2)
    return F.array(*[F.shiftleft(part[a], 13).bitwiseOR(part[b]) + F.lit(n << 26) for n, (a, b) in enumerate(pairs)])


def _close(a: str, b: str) -> Column:
    """Within the bits, and of lengths that allow the similarity."""
    col = lambda x, c: F.col(f"{x}.{c}")
    return ((F.bit_count(col(a, "sim").bitwiseXOR(col(b, "sim"))) <= BITS)
            & (F.abs(col(a, "len") - col(b, "len")) <= (1 - SIMILARITY) * F.greatest(col(a, "len"), col(b, "len"))))


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has been counted to be short."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _without_common_start(both: DataFrame) -> DataFrame:
    """``both`` without the words that its arrays x and y begin with alike, where they are open."""
    both = both.withColumn("differ", F.expr("if(open, array_position(zip_with(x, y, (v, w) -> v <=> w), false), 0)"))
    both = both.withColumn("alike", F.expr("if(differ = 0, least(size(x), size(y)), int(differ - 1))"))
    return both.withColumns({c: F.expr(f"if(open, slice({c}, alike + 1, size({c})), {c})") for c in ("x", "y")}).drop("differ", "alike")


def verified(pairs: DataFrame, nodes: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose lines are similar in edits."""
    ids = checkpoint_parquet(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "line-ids")
    wanted = checkpoint_parquet(nodes.join(small(ids), "node").select("node", "h1", "h2", "doc_id", "text_hash", "pos"), "line-wanted")
    # the first occurrence of a node has its text; the texts of all others are not moved
    place = ["h1", "h2", "text_hash", "pos"]
    texts = lines.select("doc_id", "text_hash", "pos", "h1", "h2", "norm").alias("l").join(
        small(wanted).alias("w"), [F.col(f"l.{c}") == F.col(f"w.{c}") for c in place] + [F.col("l.doc_id").eqNullSafe(F.col("w.doc_id"))])
    texts = checkpoint_parquet(texts.select("node", "norm").dropDuplicates(["node"]), "line-texts")
    x, y = texts.select(F.col("node").alias("a"), F.col("norm").alias("x")), texts.select(F.col("node").alias("b"), F.col("norm").alias("y"))
    most = F.floor(F.greatest(F.length("x"), F.length("y")) * F.lit(1 - SIMILARITY)).cast("int")
    both = pairs.join(x, "a").join(y, "b").withColumns({"most": most, "x": F.split("x", " "), "y": F.split("y", " ")})
    # word put for word at the same places is one way of edits, so pairs within it need no more
    in_place = F.expr("size(x) = size(y) AND aggregate(zip_with(x, y, (v, w) -> if(v <=> w, 0, greatest(length(v), length(w)))), 0, (a, n) -> a + n) <= most")
    both = both.withColumn("open", ~in_place)
    # words that both begin or end with don't count: the edits are those of what is between
    both = _without_common_start(both).withColumns({c: F.expr(f"if(open, reverse({c}), {c})") for c in ("x", "y")})
    both = _without_common_start(both).withColumns({c: F.expr(f"if(open, array_join(reverse({c}), ' '), '')") for c in ("x", "y")})
    longer = F.greatest(F.length("x"), F.length("y"))
    one_empty = (F.col("x") == "") != (F.col("y") == "")  # then a space goes as well
    near = F.when(one_empty, longer + 1 <= F.col("most")).otherwise((longer <= F.col("most")) | F.expr("levenshtein(x, y, most) >= 0"))
    # written before it is a condition: that would be pushed below the steps and hold all of them again and again
    both = both.select("a", "b", F.when(~F.col("open"), True).otherwise(near).alias("near"))
    return checkpoint_parquet(both, "line-links").where("near").select("a", "b")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, pos) of the lines to remove: of each group of equal
    or similar lines all occurrences but the first by (doc_id, text_hash, pos)."""
    lines = checkpoint_parquet(occurrences(docs, id_col, text_col), "line-occurrences")
    first = F.min(F.struct("doc_id", "text_hash", "pos"))
    nodes = lines.groupBy("h1", "h2").agg(first.alias("at"), F.first("sim").alias("sim"), F.first("len").alias("len"), F.count(F.lit(1)).alias("times"))
    nodes = checkpoint_parquet(nodes.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "sim", "len", "times", "at.*"), "line-nodes")
    keyed = nodes.select("node", "sim", "len", F.explode(_keys(F.col("sim"))).alias("key"))
    meet = Window.partitionBy("key").orderBy("node")
    whole = meet.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # in a meeting of up to FEW, the first, the last and the last but one are all that a node must be compared with
    own = F.struct("node", "sim", "len")
    met = (keyed.withColumn("n", F.count(F.lit(1)).over(whole))
           .withColumns({"f": F.first(own).over(whole), "l1": F.lag(own, 1).over(meet), "l2": F.lag(own, 2).over(meet)}).where("n > 1").withColumn("m", own))
    other = {"f": F.col("node") != F.col("f.node"), **{x: (F.col("n") <= FEW) & (F.col(f"{x}.node") != F.col("f.node")) for x in ("l1", "l2")}}
    met = met.select("key", "node", "sim", "len", "n", *[F.when(apart & _close("m", x), F.col(f"{x}.node")).alias(x) for x, apart in other.items()])
    met = checkpoint_parquet(met.where(F.coalesce("f", "l1", "l2").isNotNull() | (F.col("n") > FEW)), "line-meetings")
    star = met.select(F.explode(F.array("f", "l1", "l2")).alias("a"), F.col("node").alias("b"))
    star = checkpoint_parquet(star.where("a IS NOT NULL").distinct(), "line-star")
    links = verified(star, nodes, lines)
    member = components(links, "line-components")
    # what the first comparison left apart: larger meetings with several components
    left = met.where(F.col("n") > FEW).select("key", "node", "sim", "len").join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))
    meeting = Window.partitionBy("key")
    left = left.withColumns({"lo": F.min("component").over(meeting), "hi": F.max("component").over(meeting)})
    left = checkpoint_parquet(left.where("lo < hi").drop("lo", "hi"), "line-left")
    across = (left.alias("p").join(left.alias("q"), "key").where((F.col("p.component") < F.col("q.component")) & _close("p", "q"))
              .select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()
              .join(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    across = checkpoint_parquet(across, "line-across")
    if not across.isEmpty():
        more = verified(across, nodes, lines)
        if not more.isEmpty():
            member = components(links.union(more), "line-components")
    # a line without links goes only where it is repeated, and its node has the first place; most nodes move no more
    linked = nodes.join(small(member), "node")
    kept = linked.groupBy("component").agg(first.alias("kept"))
    kept = linked.join(kept, "component").select("h1", "h2", "kept")
    alone = nodes.where("times > 1").join(small(member.select("node")), "node", "left_anti")
    kept = small(checkpoint_parquet(kept.unionByName(alone.select("h1", "h2", F.struct("doc_id", "text_hash", "pos").alias("kept"))), "line-kept"))
    same = (F.col("doc_id").eqNullSafe(F.col("kept.doc_id"))) & (F.col("text_hash") == F.col("kept.text_hash")) & (F.col("pos") == F.col("kept.pos"))
    return lines.select("doc_id", "text_hash", "pos", "h1", "h2").join(kept, ["h1", "h2"]).where(~same).select("doc_id", "text_hash", "pos")


def drop_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines_col: str = "n_lines", dropped_col: str = "n_dropped") -> DataFrame:
    """``docs`` with the text without its duplicate lines, ``lines_col`` (lines
    before) and ``dropped_col`` (lines removed), which replace columns of those
    names; all other columns and all rows stay.

    Null texts stay null (0 lines); empty texts and lines without letters or
    digits stay as they are; all other lines take part whole, short ones too.
    A null id is the smallest. Rows that repeat an id and a text are one
    document, each with the same result. An empty table gives no rows.
    """
    drops = duplicate_lines(docs, id_col, text_col).distinct().groupBy("doc_id", "text_hash").agg(F.collect_list("pos").alias("drops"))  # of one document
    drops = small(checkpoint_parquet(drops, "line-drops")).alias("x")
    lines = F.split(F.col(f"d.{text_col}"), "\n")
    n = F.coalesce(F.size(lines), F.lit(0))
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("x.drops"))
    # the lines come in as a lambda variable, so that a text is split once and not for each of its lines
    kept = F.flatten(F.transform(F.array(lines), lambda own: F.transform(keep, lambda i: F.get(own, i))))
    text = F.when(F.col("x.drops").isNull(), F.col(f"d.{text_col}")).otherwise(F.array_join(kept, "\n"))
    joined = docs.alias("d").join(drops, F.col(f"d.{id_col}").eqNullSafe(F.col("x.doc_id")) & (F.xxhash64(F.col(f"d.{text_col}")) == F.col("x.text_hash")), "left")
    others = [F.col(f"d.`{c}`") if c != text_col else text.alias(text_col) for c in docs.columns if c not in (lines_col, dropped_col)]
    return joined.select(*others, F.when(F.col(f"d.{text_col}").isNull(), 0).otherwise(n).alias(lines_col),
                         F.coalesce(F.size("x.drops"), F.lit(0)).alias(dropped_col))
