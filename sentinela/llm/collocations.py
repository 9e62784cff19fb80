"""Phrase collocation mining (operator 12): HAT-trie counting.

Phrases are counted by length, from 1 word to WIDEST, one pass over the texts
for each. A phrase can only be frequent if the two phrases one word shorter
inside it are, so a pass counts only where a bit table of the level before, of
at most FILTER_BITS bits, has both (a false hit costs work, never a result).

A task counts in a HAT-trie: containers hash the rest of a phrase's word ids; one
of more than BURST entries bursts into a trie node by the next id. Beyond HELD
entries whole subtrees, largest first, leave as sorted runs of (lang, phrase, n).
Runs are merged by partitions of the first word; a first word with more than one
in HEADS of all words has that many more partitions, by the rest of the phrase.

Counts are whole numbers and scores whole quotients of decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.llm.textops import batches_of, column_bytes, hash_spans, lower_ascii, mix, word_hashes, word_spans
from sentinela.sinks.writers import checkpoint_parquet

WIDEST, LEAST, PERCENT, FIRST = 5, 100, 100, 2000
#: Entries of a container before it bursts; entries and words a task holds before it spills.
BURST, HELD = 32_768, 250_000
DIGIT_BITS = 12
FILTER_BITS = 1 << 27
HEADS = 1024
BATCH_BYTES = 2 << 20
#: Parts of a language in the first of the two steps of its top list.
SALTS = 64
ENDS_PIECE = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\v\f\r", np.uint8))
COUNTS = "lang string, phrase string, n bigint"


class Node:
    """A container (``held``: the rest of the digits, as bytes -> count) or, once burst, a trie node (``next``: digit -> node)."""
    __slots__ = ("held", "next")

    def __init__(self):
        self.held: dict[bytes, int] | None = {}
        self.next: dict[int, Node] | None = None

    def size(self) -> int:
        return len(self.held) if self.next is None else sum(child.size() for child in self.next.values())

    def containers(self, path: tuple = ()) -> Iterator[tuple[tuple, dict]]:
        """(digits that lead there, container) of all containers below."""
        if self.next is None:
            yield path, self.held
        else:
            for digit, child in self.next.items():
                yield from child.containers(path + (digit,))


class HatTrie:
    """Counts of sequences of ``length`` ids, language first. An id is two digits,
    its block of 2^DIGIT_BITS ids and its place there: words are numbered as they
    come, so frequent ones share the first blocks, whose containers burst, and
    rare ones stay together in containers worth their room."""

    def __init__(self, length: int, burst: int = BURST):
        self.root, self.entries, self._digits, self._burst = Node(), 0, 2 * length, burst

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct rows of ids, in lexicographic order, with their counts."""
        if len(rows):
            digits = np.empty((len(rows), self._digits), "<u2")
            digits[:, ::2], digits[:, 1::2] = rows >> DIGIT_BITS, rows & (2**DIGIT_BITS - 1)
            self._add(self.root, digits, counts.tolist(), 0)

    def _add(self, node: Node, digits: np.ndarray, counts: list[int], depth: int) -> None:
        if node.next is not None:
            first = digits[:, depth]
            at = [0, *(np.flatnonzero(first[1:] != first[:-1]) + 1).tolist(), len(digits)]
            for digit, i, j in zip(first[at[:-1]].tolist(), at, at[1:]):
                child = node.next.get(digit)
                if child is None:
                    child = node.next[digit] = Node()
                self._add(child, digits[i:j], counts[i:j], depth + 1)
            return
        held, before, width = node.held, len(node.held), 2 * (self._digits - depth)
        rest = digits[:, depth:].tobytes()
        for i, n in zip(range(0, len(rest), width), counts):
            key = rest[i:i + width]
            held[key] = held.get(key, 0) + n
        self.entries += len(held) - before
        self._split(node, depth)

    def _split(self, node: Node, depth: int) -> None:
        if len(node.held) <= self._burst or depth + 1 >= self._digits:
            return
        node.next = {}
        for key, n in node.held.items():
            digit = int.from_bytes(key[:2], "little")
            child = node.next.get(digit)
            if child is None:
                child = node.next[digit] = Node()
            child.held[key[2:]] = n
        node.held = None
        for child in node.next.values():
            self._split(child, depth + 1)

    def spill(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees of a language and first word (or block of words),
        largest first, until ``most`` entries are left; rows of ids and counts of
        each container."""
        tops = [((), None, self.root)]
        for _ in range(4):
            tops = [t for path, key, node in tops for t in (
                [(path, key, node)] if node.next is None else [(path + (d,), (node, d), child) for d, child in node.next.items()])]
        for path, key, node in sorted(tops, key=lambda t: -t[2].size()):
            if self.entries <= most:
                return
            for way, held in node.containers(path):
                digits = np.empty((len(held), self._digits), np.int32)
                digits[:, :len(way)] = way
                digits[:, len(way):] = np.frombuffer(b"".join(held), "<u2").reshape(len(held), -1)
                yield digits[:, ::2] << DIGIT_BITS | digits[:, 1::2], np.fromiter(held.values(), np.int64, len(held))
                self.entries -= len(held)
            if key is None:
                self.root = Node()
            else:
                del key[0].next[key[1]]


def gram_hashes(words: list[np.ndarray], langs: np.ndarray) -> np.ndarray:
    """One hash for each phrase, from the hashes of its words in order and of its language."""
    keys = mix(np.arange(1, len(words) + 1, dtype=np.uint64), 12) | np.uint64(1)
    total = mix(langs, 13)
    for word, key in zip(words, keys):
        total = total + word * key
    return mix(total, 14)


def text_hashes(column: pa.Array) -> np.ndarray:
    """A hash of every whole string of a column."""
    data, offsets = column_bytes(column)
    return hash_spans(data, offsets[:-1], offsets[1:])


def bit_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def has_bits(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), dtype=bool)
    for place in bit_places(hashes, len(table) * 64):
        found &= (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
    return found


def word_ids(column: pa.Array):
    """The words of a text column: code of each in ``vocabulary`` (exact), the text
    it is in, and whether it goes on the piece of the word before it."""
    data, offsets = column_bytes(column)
    data = lower_ascii(data)
    ends_piece = ENDS_PIECE[data]
    starts, ends, of = word_spans(np.where(ends_piece, np.uint8(32), data), offsets)
    pieces = np.concatenate([[0], np.cumsum(ends_piece)])[starts]
    goes_on = np.zeros(len(starts), dtype=bool)
    goes_on[1:] = pieces[1:] == pieces[:-1]
    goes_on[of[:-1][of[:-1] < of[1:]]] = False
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths)])
    letters = data[np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters))).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary, np.repeat(np.arange(len(of) - 1), np.diff(of)), goes_on


def distinct_rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First place and count of every distinct row of some columns of codes below
    2^31; the rows are in lexicographic order."""
    code = columns[0].astype(np.int64)
    for column in columns[1:]:
        _, code = np.unique(code, return_inverse=True)
        code = code.astype(np.int64) << 32 | column.astype(np.int64)
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return first, n


def sorted_run(parts: list[tuple[np.ndarray, np.ndarray]], words: list[str]) -> Iterator[pa.RecordBatch]:
    """The entries as (lang, phrase, n), sorted word by word."""
    if not parts:
        return
    rows, counts = np.concatenate([r for r, _ in parts]), np.concatenate([n for _, n in parts])
    known = pa.array(words, pa.string())
    rank = np.empty(len(words), np.int32)
    rank[pc.sort_indices(known).to_numpy()] = np.arange(len(words), dtype=np.int32)
    order = np.lexsort([rank[column] for column in rows.T[::-1]])
    for i in range(0, len(order), 1 << 16):
        some = rows[order[i:i + (1 << 16)]]
        lang, *phrase = (known.take(pa.array(column)) for column in some.T)
        yield pa.RecordBatch.from_arrays([lang, pc.binary_join_element_wise(*phrase, " "), pa.array(counts[order[i:i + (1 << 16)]])], names=["lang", "phrase", "n"])


def counter(width: int, table, held: int = HELD, burst: int = BURST):
    """The task that counts phrases of ``width`` words of (lang, text) batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, codes = HatTrie(width + 1, burst), {}  # word or (language,) -> id
        known = None if table is None else table.value

        def runs(most: int) -> Iterator[pa.RecordBatch]:
            return sorted_run(list(trie.spill(most)), [w if isinstance(w, str) else w[0] for w in codes])

        def own_ids(words: list) -> np.ndarray:
            return np.array([codes.setdefault(w, len(codes)) for w in words], np.int32)

        for batch in batches:
            for i, j in batches_of(batch.column(1), BATCH_BYTES):
                ids, vocabulary, text, goes_on = word_ids(batch.column(1).slice(i, j - i))
                langs = batch.column(0).slice(i, j - i).dictionary_encode()
                lang = langs.indices.to_numpy()[text]
                at = np.arange(max(len(ids) - width + 1, 0))
                ok = np.ones(len(at), dtype=bool)
                for k in range(1, width):
                    ok &= goes_on[at + k]
                at = at[ok]
                if known is not None and len(at):
                    hashes, lang_hashes = text_hashes(vocabulary)[ids], text_hashes(langs.dictionary)[lang]
                    for shift in (0, 1):
                        at = at[has_bits(known, gram_hashes([hashes[at + shift + k] for k in range(width - 1)], lang_hashes[at]))]
                if width == 1:  # the root of a language: all its words
                    at_lang, n = np.unique(lang, return_counts=True)
                    yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(at_lang)), pa.array([""] * len(n), pa.string()), pa.array(n.astype(np.int64))], names=["lang", "phrase", "n"])
                used = np.zeros(len(vocabulary), dtype=bool)
                for k in range(width):
                    used[ids[at + k]] = True
                own = np.zeros(len(vocabulary), np.int32)
                own[used] = own_ids(vocabulary.filter(pa.array(used)).to_pylist())
                own_lang = own_ids([(x,) for x in langs.dictionary.to_pylist()])
                columns = [own_lang[lang[at]], *[own[ids[at + k]] for k in range(width)]]
                first, n = distinct_rows(columns)
                rows = np.stack([column[first] for column in columns], axis=1)
                for a in range(0, len(rows), held):  # few rows at a time: what is held stays bounded
                    trie.add(rows[a:a + held], n[a:a + held])
                    if trie.entries > held:
                        yield from runs(held // 2)
                if len(codes) > held:
                    yield from runs(0)
                    codes.clear()
        yield from runs(0)

    return run


def _merged(runs: DataFrame, heads: DataFrame | None) -> DataFrame:
    """Sums of the runs, by partitions of the first word; ``heads`` has the words
    that take several, each a share of at least 1 / HEADS of all words."""
    first = F.substring_index("phrase", " ", 1)
    if heads is None:
        keyed = runs.withColumn("part", F.xxhash64("lang", first))
    else:
        keyed = (runs.withColumn("head", first).join(F.broadcast(heads), ["lang", "head"], "left")  # at most HEADS rows
                 .withColumn("part", F.xxhash64("lang", "head", F.pmod(F.hash("phrase"), F.coalesce("fan", F.lit(1))))))
    return keyed.repartition("part").groupBy("part", "lang", "phrase").agg(F.sum("n").alias("n")).drop("part")


def _bit_table(phrases: DataFrame, width: int):
    """The bits of the frequent phrases of a length, as a broadcast of at most FILTER_BITS bits."""
    bits = 1 << min(max((16 * phrases.count()).bit_length(), 16), FILTER_BITS.bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _ = word_hashes(batch.column(1))
            places = np.concatenate(bit_places(gram_hashes(list(words.reshape(-1, width).T), text_hashes(batch.column(0))), bits))
            slots, at = np.unique(places >> 6, return_inverse=True)
            held = np.zeros(len(slots), np.uint64)
            np.bitwise_or.at(held, at, np.uint64(1) << (places & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(held.view(np.int64))], names=["slot", "bits"])

    found = phrases.select("lang", "phrase").mapInArrow(run, "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(table)


def phrase_counts(docs: DataFrame, widest: int = WIDEST, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> list[DataFrame]:
    """For each length from 1 to ``widest`` a written table (lang, phrase, n) of
    the phrases that occur at least ``least`` times in their language, overlaps
    included; the first also has the phrase '' with the count of all words of
    every language, however few. A null language is ``und``, null texts are empty."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found, heads, table = [], None, None
    for width in range(1, widest + 1):
        counts = _merged(texts.mapInArrow(counter(width, table), COUNTS), heads)
        found.append(checkpoint_parquet(counts.where((F.col("n") >= least) | (F.col("phrase") == "")), f"phrases-{width}"))
        if width == 1:
            words = found[0].where("phrase <> ''")
            total = found[0].where("phrase = ''").agg(F.sum("n")).first()[0] or 0
            heads = checkpoint_parquet(words.where(F.col("n") * HEADS >= total).select(
                "lang", F.col("phrase").alias("head"), F.ceil(F.col("n") * HEADS / total).cast("int").alias("fan")) if total else
                words.select("lang", F.col("phrase").alias("head"), F.lit(1).alias("fan")), "phrase-heads")
        if table is not None:
            table.unpersist()
        table = _bit_table(words if width == 1 else found[-1], width) if width < widest else None
    return found


SCORE = "(cast(a as decimal(18,0)) * cast(n as decimal(18,0)) * 1000) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"


def collocations(docs: DataFrame, widest: int = WIDEST, least: int = LEAST, percent: int = PERCENT, first: int = FIRST,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``first`` phrases of every language by score: (lang, rank, phrase, a,
    l, r, n, score).

    A candidate has 2 to ``widest`` words and at least ``least`` occurrences a;
    its score is the least of floor(1000 * a * n / (l * r)) over its cuts, ties to
    the shortest first part. It goes when a longer candidate that holds it has
    at least ``percent`` per cent of its occurrences: counts do not rise with
    length, so one more word is all there is to look at. Empty tables, and
    languages without frequent phrases, give no rows; repeated rows count each."""
    levels = phrase_counts(docs, widest, least, lang_col, text_col)
    one = levels[0].where("phrase <> ''")
    totals = levels[0].where("phrase = ''").select("lang", F.col("n"))
    longer = [level.select("lang", "phrase", F.col("n").alias("a")) for level in levels[1:]]
    if not longer:
        raise ValueError("phrases have two words at least")
    candidates, parts = longer[0], one
    for level in longer[1:]:
        candidates = candidates.union(level)
    for level in levels[1:-1]:
        parts = parts.union(level)
    words = F.split("phrase", " ")
    inside = candidates.where(F.size(words) > 2).select("lang", F.explode(F.array(
        F.array_join(F.slice(words, 1, F.size(words) - 1), " "), F.array_join(F.slice(words, 2, F.size(words) - 1), " "))).alias("phrase"), F.col("a").alias("held"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    kept = candidates.join(inside, ["lang", "phrase"], "left").where(F.col("held").isNull() | (100 * F.col("held") < percent * F.col("a"))).drop("held")
    cuts = kept.select("lang", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left_part"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right_part"))
    part = lambda side, out: parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(out))
    scored = cuts.join(part("left_part", "l"), ["lang", "left_part"]).join(part("right_part", "r"), ["lang", "right_part"]).join(totals, "lang")
    best = scored.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = Window.partitionBy("lang", "salt").orderBy(*order)
    top = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("place", F.row_number().over(some)).where(F.col("place") <= first)
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return top.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
