"""Conversation structure repair (operator 13): grammar-compressed dynamic programming.

A conversation is a sequence of symbols, one a row: the class of its role and
its fault. A task compresses the sequences it holds with Re-Pair into one
grammar; every symbol, then every rule from the bottom up, gets one min-plus
transfer matrix over the states of the role pattern, whose entries are the least
cost and, as a rope, the ASCII-least audit of that cost. A conversation is the
product of the matrices of its compressed sequence; equal sequences and shared
rules are evaluated once.

Two audits of equal cost between the same two states never are one the beginning
of the other (they would differ by insertions, which cost), so the least audit
of a product is the least of the products of least audits.

Rows are sorted by ranges of (conversation, turn, role, text), so one
conversation may lie in many partitions: its stretches get their matrices apart
and only these are multiplied in one place. Texts never gather: the repaired text
goes through its digest row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.sinks.writers import checkpoint_parquet

BLANKS = " \t\n\x0b\x0c\r"
RATE = 20
#: Characters of role and text that deal rows out; rows are sorted by the whole of them.
KEY_CHARS = 64
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3

#: States of the pattern (s?(ua)+)?: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The one role that an insertion or a changed role can have in each state, and where it leads.
NEXT_ROLE = {NOTHING: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ENDS = (NOTHING, ASSISTANT)

#: Role classes (x: any other) and faults (k: none, t: truncated; blank and duplicate rows, b and d, have to go).
ROLES, FAULTS = "suax", "ktbd"
SYMBOLS = [(r, f) for f in "kt" for r in ROLES] + [("", "-")]


def damage(rows: DataFrame, rate: int = RATE) -> DataFrame:
    """(conv_id, turn, role, text) after damage by the crc32 of ``conv_id:turn``;
    null roles and texts are one space, so are null ids in the checksum."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % rate
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    found = rows.select("conv_id", "turn", "role", "text", kind.alias("kind")).where("kind <> 0")
    found = found.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(shown("role")).alias("role"), text.alias("text"),
                         F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return found.drop("copy")


# ------------------------------------------------------------------ grammar


def repair_grammar(sequences: list[np.ndarray], symbols: int, least: int = 2) -> tuple[list[tuple[int, int]], list[np.ndarray]]:
    """Re-Pair: as long as some pair of neighbours occurs ``least`` times, the most
    frequent one becomes a new symbol everywhere. Returns the rules, of which the
    i-th makes symbol ``symbols + i``, and the sequences that are left."""
    breaks = -np.arange(1, len(sequences) + 1)
    whole = np.concatenate([x for s, b in zip(sequences, breaks) for x in (s.astype(np.int64), [b])] or [np.zeros(0, np.int64)])
    rules: list[tuple[int, int]] = []
    while len(whole) > 1:
        inside = (whole[:-1] >= 0) & (whole[1:] >= 0)
        pairs, n = np.unique((whole[:-1] << 32 | whole[1:])[inside], return_counts=True)
        if not len(pairs) or n.max() < least:
            break
        pair = int(pairs[n.argmax()])
        a, b = pair >> 32, pair & (2**32 - 1)
        at = np.flatnonzero((whole[:-1] == a) & (whole[1:] == b))
        if a == b:  # of a run like aaaa every other place
            first = np.concatenate([[True], np.diff(at) > 1])
            start = at[first][np.cumsum(first) - 1]
            at = at[(at - start) % 2 == 0]
        if len(at) < least:
            break
        whole[at] = symbols + len(rules)
        whole = np.delete(whole, at + 1)
        rules.append((a, b))
    ends = np.flatnonzero(whole < 0)
    return rules, [whole[i:j] for i, j in zip(np.concatenate([[0], ends[:-1] + 1]).astype(int), ends)]


class Rope:
    """A string as the concatenation of two, written out when it is compared or read."""
    __slots__ = ("left", "right", "text")

    def __init__(self, left=None, right=None, text=None):
        self.left, self.right, self.text = left, right, text

    def __str__(self) -> str:
        if self.text is None:
            parts, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope.text is not None:
                    parts.append(rope.text)
                else:
                    todo += (rope.right, rope.left)
            self.text, self.left, self.right = "".join(parts), None, None
        return self.text


def _better(a, b):
    """The cheaper of two entries (cost, rope); of equal cost the ASCII-least one."""
    if a is None or b is None:
        return b if a is None else a
    return a if (a[0] < b[0] or a[0] == b[0] and str(a[1]) <= str(b[1])) else b


def product(left: list, right: list) -> list:
    """The min-plus product of two transfer matrices."""
    out = [[None] * 4 for _ in range(4)]
    for s in range(4):
        for m in range(4):
            if (a := left[s][m]) is not None:
                for t in range(4):
                    if (b := right[m][t]) is not None and (out[s][t] is None or a[0] + b[0] <= out[s][t][0]):
                        out[s][t] = _better(out[s][t], (a[0] + b[0], Rope(a[1], b[1])))
    return out


IDENTITY = [[(0, Rope(text="")) if s == t else None for t in range(4)] for s in range(4)]


def _insertions(state: int):
    """(state, insertions) reachable by inserting, each by the fewest."""
    found = [(state, 0)]
    while (after := NEXT_ROLE[found[-1][0]][1]) not in [s for s, _ in found]:
        found.append((after, found[-1][1] + 1))
    return found


def symbol_matrix(role: str, fault: str) -> list:
    """The transfer matrix of one row: insertions before it, then its edit."""
    out = [[None] * 4 for _ in range(4)]
    for s in range(4):
        for m, n in _insertions(s):
            edits = [(m, DELETE, "D")]
            if fault in "kt":
                more = CUT_OFF if fault == "t" else 0
                if (m, role) in STEP:
                    edits.append((STEP[m, role], more, "K"))
                edits.append((NEXT_ROLE[m][1], REROLE + more, "R"))
            for t, cost, letter in edits:
                out[s][t] = _better(out[s][t], (INSERT * n + cost, Rope(text="I" * n + letter)))
    return out


def _reduce(matrices: list) -> list:
    """The product in a balanced order, so that ropes are written out log-many times."""
    if not matrices:
        return IDENTITY
    while len(matrices) > 1:
        matrices = [product(*matrices[i:i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    return matrices[0]


def transfer_matrices(sequences: list[str], least: int | None = None) -> list[list]:
    """A matrix for each sequence, two characters (role class, fault) a row. Pairs
    that occur less than ``least`` times (by default a 512th of all rows, 2 at
    least) are no rules: they'd save less than they cost."""
    code = {s: i for i, s in enumerate(SYMBOLS)}
    distinct = {s: i for i, s in enumerate(dict.fromkeys(sequences))}
    rows = [np.array([code.get((s[i], s[i + 1]), code["", "-"]) for i in range(0, len(s), 2)], np.int64) for s in distinct]
    rules, left = repair_grammar(rows, len(SYMBOLS), least or max(2, sum(map(len, rows)) // 512))
    matrices = [symbol_matrix(*s) for s in SYMBOLS]
    for a, b in rules:
        matrices.append(product(matrices[a], matrices[b]))
    found = [_reduce([matrices[i] for i in rest]) for rest in left]
    return [found[distinct[s]] for s in sequences]


def cheapest(parts: list[list]) -> tuple[int, list[str]]:
    """Least cost of a conversation and its audit, cut at the stretches whose
    matrices are ``parts``; the last one has the insertions at the end."""
    best = [(0, "", ()) if s == NOTHING else None for s in range(4)]
    pick = lambda a, b: b if a is None or (b[0], b[1]) < (a[0], a[1]) else a
    for part in parts:
        now = [None] * 4
        for s in range(4):
            for t in range(4):
                if best[s] is not None and part[s][t] is not None:
                    own = str(part[s][t][1])
                    now[t] = pick(now[t], (best[s][0] + part[s][t][0], best[s][1] + own, (best[s][2], own)))
        best = now
    end = None
    for s in range(4):
        if best[s] is not None:
            for t, n in _insertions(s):
                if t in ENDS:
                    end = pick(end, (best[s][0] + INSERT * n, best[s][1] + "I" * n, best[s][2]))
    pieces, chain = [], end[2]
    while chain:
        chain, own = chain
        pieces.append(own)
    pieces.reverse()
    if pieces:
        pieces[-1] += end[1][sum(map(len, pieces)):]
    return end[0], pieces


def row_edits(pieces: list[str], roles: list[str]) -> list[list[str]]:
    """For each stretch one string a row: inserted roles before it (1: user, 2:
    assistant), its edit (K, D, U or A: a new role), inserted roles at the end."""
    state, out = NOTHING, []
    for piece, own in zip(pieces, roles):
        rows, before, place = [], "", 0
        for letter in piece:
            if letter == "I":
                role, state = NEXT_ROLE[state]
                before += "1" if role == "u" else "2"
                continue
            if letter == "K":
                state = STEP[state, own[place]]
            elif letter == "R":
                role, state = NEXT_ROLE[state]
                letter = role.upper()
            rows.append(before + letter)
            before, place = "", place + 1
        if before:
            rows[-1] += before
        out.append(rows)
    return out


# -------------------------------------------------------------------- Spark

_COUNTED = ("blank", "duplicate", "truncated", "illegal")
_ENTRY = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
STRETCH = "conv_id {0}, seg int, at bigint, symbols string, entries array<struct<start:int,end:int,cost:bigint,audit:string>>"
REPAIRED = "conv_id {0}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, edits array<struct<at:bigint,codes:array<string>>>"
SEQUENCES = 200_000


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, SEQUENCES):
            some = batch.slice(i, SEQUENCES)
            found = {}
            texts = some.column(3).to_pylist()
            entries = []
            for text, matrix in zip(texts, transfer_matrices(texts)):
                if text not in found:
                    found[text] = [{"start": s, "end": t, "cost": e[0], "audit": str(e[1])} for s, row in enumerate(matrix) for t, e in enumerate(row) if e]
                entries.append(found[text])
            yield pa.RecordBatch.from_arrays([*some.columns[:4], pa.array(entries, pa.list_(_ENTRY))], names=["conv_id", "seg", "at", "symbols", "entries"])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [[] for _ in range(7)]
        for runs in batch.column(1).to_pylist():
            runs.sort(key=lambda r: r["seg"])
            parts = []
            for run in runs:
                part = [[None] * 4 for _ in range(4)]
                for e in run["entries"]:
                    part[e["start"]][e["end"]] = (e["cost"], e["audit"])
                parts.append(part)
            cost, pieces = cheapest(parts)
            symbols = "".join(r["symbols"] for r in runs)
            roles, faults = symbols[::2], symbols[1::2]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
            edits = [{"at": r["at"], "codes": codes} for r, codes in zip(runs, row_edits(pieces, [r["symbols"][::2] for r in runs]))]
            for column, x in zip(columns, (faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, "".join(pieces), edits)):
                column.append(x)
        edit_type = pa.list_(pa.struct([("at", pa.int64()), ("codes", pa.list_(pa.string()))]))
        arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.string(), edit_type])]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["conv_id", *_COUNTED, "cost", "audit", "edits"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, which come in order, each after a line break."""
    now, sha, kind = (), None, None
    for batch in batches:
        done, kind = [], batch.column(0).type
        for conv, lines in zip(batch.column(0).to_pylist(), batch.column(1)):
            lines = lines.as_py()
            if now != (conv,):
                if sha is not None:
                    done.append((now[0], sha.hexdigest()))
                now, sha, lines = (conv,), hashlib.sha256(), lines[1:]
            sha.update(lines.encode("utf-8"))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([h for _, h in done])], names=["conv_id", "sha"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now[0]], kind), pa.array([sha.hexdigest()])], names=["conv_id", "sha"])


def _symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, seg, at, symbols): each stretch of a conversation in a partition,
    two characters a row. A row is a duplicate if its role and text have a smaller place."""
    light = rows.select("conv_id", "seg", "at", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("said"),
                        F.substring("role", 1, 1).alias("initial"), "last")
    firsts = light.groupBy("conv_id", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = (F.when(F.col("last") == "", "b").when(F.col("first").isNull(), "d")
             .when(F.col("last").isin(".", "!", "?"), "k").otherwise("t"))
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    marked = light.join(firsts, "at", "left").select("conv_id", "seg", "at", F.concat(role, fault).alias("symbol"))
    in_order = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "symbol"))), lambda r: r["symbol"]), "")
    return marked.groupBy("conv_id", "seg").agg(F.min("at").alias("at"), in_order.alias("symbols")).select("conv_id", "seg", "at", "symbols")


def _line(rows: Column, edit: Column) -> Column:
    """The lines of a row after its edit, each after a line break."""
    inserted = lambda marks: F.replace(F.replace(marks, F.lit("1"), F.lit("\nuser:")), F.lit("2"), F.lit("\nassistant:"))
    letter = F.regexp_extract(edit, "([A-Z])", 1)
    role = F.when(letter == "K", F.col("role")).when(letter == "U", "user").when(letter == "A", "assistant")
    own = F.when(letter == "D", F.lit("")).otherwise(F.concat(F.lit("\n"), role, F.lit(":"), rows))
    return F.concat(inserted(F.regexp_extract(edit, "^([12]*)", 1)), own, inserted(F.regexp_extract(edit, "[A-Z]([12]*)$", 1)))


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text), as
    they are: faults, illegal neighbours, cost and audit of the cheapest repair,
    SHA-256 of the repaired text.

    Rows are taken by turn, null turns first, then by role and text; equal rows of
    a turn are duplicates. Null roles and texts count as one space, null ids are
    one conversation. A role counts by its first character, case and all; one
    that is not s, u or a (an empty one too) can only be changed or deleted.
    Empty tables give no rows, other columns are ignored. The audit of a
    conversation is one value, so its symbols may be one as well; its texts never are."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = dict(rows.dtypes)["conv_id"]
    rows = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"))
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, KEY_CHARS), F.substring("text", 1, KEY_CHARS))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select(
        "*", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("seg"),
        F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1).alias("last"))
    dealt = checkpoint_parquet(dealt, "conversation-rows")
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = dealt.groupBy("conv_id").agg(F.coalesce(turns, F.lit(0)).cast("bigint").alias("gaps"))
    stretches = _symbols(dealt).mapInArrow(_matrices, STRETCH.format(kind))
    runs = stretches.groupBy("conv_id").agg(F.collect_list(F.struct("seg", "at", "symbols", "entries")).alias("runs"))
    done = checkpoint_parquet(runs.mapInArrow(_repaired, REPAIRED.format(kind)), "conversation-audits")
    edits = done.select(F.explode("edits").alias("e")).select("e.at", F.posexplode("e.codes").alias("place", "edit")).select((F.col("at") + F.col("place")).alias("at"), "edit")
    lines = dealt.select("conv_id", "at", "role", "text").join(edits.where("edit <> 'D'"), "at").select("conv_id", "at", _line(F.col("text"), F.col("edit")).alias("lines"))
    digests = lines.repartition("conv_id").sortWithinPartitions("conv_id", "at").select("conv_id", "lines").mapInArrow(_digests, f"conv_id {kind}, sha string")
    numbers = [*_COUNTED, "cost", "audit"]
    all_of = (done.select("conv_id", *numbers).unionByName(gaps, allowMissingColumns=True).unionByName(digests, allowMissingColumns=True)
              .groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ("gaps", *numbers, "sha")]))
    return all_of.select("conv_id", "gaps", *numbers, F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damage_and_repair(rows: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, with a row for every original conversation;
    those without rows left have zeros, an empty audit and the empty text's hash."""
    found = repair(damage(rows))
    every = rows.select("conv_id").unionByName(found, allowMissingColumns=True)
    numbers = [c for c in found.columns if c != "conv_id"]
    found = every.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in numbers])
    nothing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return found.select("conv_id", *[F.coalesce(c, nothing.get(c, F.lit(0).cast("bigint"))).alias(c) for c in numbers])
