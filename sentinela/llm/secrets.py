"""Secret scans (operator 11): assignment-aware lexing.

Three plain patterns give the base spans: ``assign``, ``access`` and ``hex``. On
top of them each text is lexed as source or configuration: every ``name =
expression`` (also ``:``, ``:=``, ``=>``, keyword arguments, quoted keys,
subscripts) becomes a pair of a target name and the literals and references of
its right side. Constants are propagated: a literal counts for every name it
reaches, through references, interpolation and concatenation, and its value is
that of the whole concatenation. A literal's score is the most sensitive name it
reaches times the strength of the value; literals that score THRESHOLD or more
and do not lie in a base span are spans of kind ``lexed``.

All work on a text is linear in its length and stays within its row; Spark
deals out the rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "lexed")
THRESHOLD = 0.5

#: The base patterns, each with the least length of its group that counts.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)

#: Weight of a word of a target name; a name weighs what its heaviest word does.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authkey": 1.0,
    "key": 0.7, "auth": 0.7, "pass": 0.7, "bearer": 0.7, "jwt": 0.7, "otp": 0.7, "salt": 0.7, "signature": 0.7, "dsn": 0.7, "cookie": 0.6, "session": 0.6,
}
#: Words that say that the value only describes a secret.
HARMLESS = {"public", "name", "file", "path", "url", "uri", "id", "type", "length", "size", "count", "ttl", "expiry", "hint", "label",
            "field", "prompt", "header", "policy", "limit", "min", "max", "format", "regex", "pattern"}
PLACEHOLDER = re.compile(r"x+|\*+|<.*>|\[.*\]|your.*|.*change.?me.*|.*example.*|.*placeholder.*|dummy.*|test|todo|none|null|true|false|nil|undefined|redacted|[\W_]*", re.I | re.S)

# An assignment's left side: a name, bare or quoted, maybe the end of a subscript, then the operator.
HEAD = re.compile(r"""(?<![\w$.@-])(?P<q>["'`]?)(?P<name>[A-Za-z_$@][\w$.@-]*+)(?P=q)[ \t]*\]?[ \t]*(?::=|=>|=(?![=>~])|:(?![:=/]))""", re.A)
# A call that names and sets a value: define("NAME", "value"), setProperty("name", "value").
SETTER = re.compile(r"""\b(?:define|putenv|setenv|set\w*|put|add\w*)[ \t]*\([ \t]*(["'])(?P<name>[A-Za-z_][\w.-]*)\1[ \t]*,""", re.A)
STRING = re.compile(r'''(?:[bBrRfFuUL@$]{0,2})(?:"""(?P<a>.*?)"""|\'\'\'(?P<b>.*?)\'\'\'|"(?P<c>(?:[^"\\\n]|\\.)*+)"|'(?P<d>(?:[^'\\\n]|\\.)*+)'|`(?P<e>[^`]*+)`)''', re.S)
LOOKUP = re.compile(r"""\$\{(\w+)[^}\n]*\}|\$(\w+)|%(\w+)%|\{\{[ ]*([\w.]+)[ ]*\}\}|(?:os\.environ|ENV|process\.env|getenv|config|settings)[ ]*[\[(.][ ]*["']?(\w+)["']?[ ]*[\])]?""", re.A)
INSIDE = re.compile(r"\$\{(\w+)\}|\$(\w+)|\{(\w+)\}|%\((\w+)\)", re.A)
NAME = re.compile(r"[A-Za-z_$@][\w$.@]*+", re.A)
BARE = re.compile(r"""[^\s,;'"`<>(){}\[\]#&|]++""")
GOES_ON = re.compile(r"""[^\s,;'"`<>(){}\[\]#&|+]""")
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", re.A)
BLANKS = re.compile(r"(?:[ \t]|\\\n)*+")
LINES = re.compile(r"(?:\s|\\\n)*+")
JOINT = re.compile(r"(?:[ \t]|\\\n)*+(?:\+|\|\||\.\.|\.(?=[ \t]*[\"'$])|&)\s*+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int  # exclusive
    name: str | None  # target name that made a lexed span
    score: float | None


class Pair(NamedTuple):
    at: int
    name: str
    literals: list[tuple[int, int]]
    refs: list[str]


def base_spans(text: str) -> list[Span]:
    """Spans of the three patterns, leftmost and non-overlapping for each kind;
    a match that is too short is dropped after it has taken its place."""
    return [Span(kind, m.start(), m.end(), None, None) for kind, pattern, group, least in BASE
            for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def name_weight(name: str) -> float:
    """How sensitive a target name is, from its words (camelCase, snake_case, dots)."""
    words = [w.lower() for w in WORDS.findall(name)]
    joined = words + [a + b for a, b in zip(words, words[1:])]
    weight = max((SENSITIVE.get(w, SENSITIVE.get(w.rstrip("s"), 0.0)) for w in joined), default=0.0)
    return weight * 0.3 if words and words[-1] in HARMLESS or "public" in words else weight


class Value(NamedTuple):
    """What is kept of a concatenated value: enough to rate it, however long it gets."""
    length: int
    letters: frozenset

    def __add__(self, other: Value) -> Value:
        return Value(self.length + other.length, self.letters | other.letters)


NOTHING = Value(0, frozenset())


def value_of(piece: str) -> Value:
    return NOTHING if PLACEHOLDER.fullmatch(piece) else Value(len(piece), frozenset(piece))


def strength(value: Value) -> float:
    """0 to 1: how much a value looks like a secret; by length, distinct characters and their classes."""
    if value.length < 6:
        return 0.0
    kinds = sum(any(test(c) for c in value.letters) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum() and not c.isspace()))
    spread = min(1.0, len(value.letters) / 8)
    variety = 1.0 if kinds >= 3 else 0.85 if kinds == 2 else 0.7 if len(value.letters) >= 12 else 0.5
    return spread * variety * (0.6 if " " in value.letters else 1.0)


def _expression(text: str, at: int, names) -> tuple[list[tuple[int, int]], list[str]]:
    """Literals and references of the expression that begins at ``at``: terms
    joined by operators or, for strings, by standing side by side."""
    literals: list[tuple[int, int]] = []
    refs: list[str] = []
    at = BLANKS.match(text, at).end()
    while text[at:at + 1] in ("(", "["):  # a list or a bracketed, maybe many-line, expression
        at = LINES.match(text, at + 1).end()
    while True:
        if m := STRING.match(text, at):
            inner = m.span(m.lastgroup)
            literals.append(inner)
            refs += [next(filter(None, r.groups())) for r in INSIDE.finditer(text, *inner)]
        elif m := LOOKUP.match(text, at):
            refs.append(next(filter(None, m.groups())))
        elif (m := NAME.match(text, at)) and text[m.end():m.end() + 1] == "(":
            at = LINES.match(text, m.end() + 1).end()  # a call: its first argument
            if text[at:at + 1] == ")":
                break
            continue
        elif head := HEAD.match(text, at):  # a = b = "...": what b gets is also a's
            refs.append(head["name"])
            break
        elif m and (m[0] in names or m[0].rpartition(".")[2] in names) and not GOES_ON.match(text, m.end()):
            refs.append(m[0])
        elif m := BARE.match(text, at):
            literals.append(m.span())
        else:
            break
        at = m.end()
        if j := JOINT.match(text, at):
            at = j.end()
        else:
            spot = LINES.match(text, at).end() if text[at:at + 1] in "\\\n" else BLANKS.match(text, at).end()
            if not (text[spot:spot + 1] in ('"', "'") and STRING.match(text, spot) and text[at - 1:at] in ('"', "'")):
                break
            at = spot
    return literals, refs


def lex(text: str) -> list[Pair]:
    """The (target name, literals and references) pairs of a text, in order."""
    heads = [(m.start(), m["name"], m.end()) for pattern in (HEAD, SETTER) for m in pattern.finditer(text)]
    heads.sort()
    names = {n for _, name, _ in heads for n in (name, name.rpartition(".")[2])}
    return [Pair(at, name, *_expression(text, end, names)) for at, name, end in heads]


def _definitions(pairs: list[Pair]) -> list[list[int]]:
    """For each pair the pairs its references mean: the last definition before, else the first after."""
    places: dict[str, list[int]] = {}
    for i, pair in enumerate(pairs):
        for name in {pair.name, pair.name.rpartition(".")[2]}:
            places.setdefault(name, []).append(i)
    found = []
    for i, pair in enumerate(pairs):
        own = []
        for ref in pair.refs:
            where = places.get(ref) or places.get(ref.rpartition(".")[2])
            if where:
                k = bisect_right(where, i - 1)
                after = bisect_right(where, i)
                own += where[k - 1:k] if k else where[after:after + 1]
        found.append(own)
    return found


def _values(text: str, pairs: list[Pair], means: list[list[int]]) -> list[Value]:
    """The value of each pair with its references put in; a cycle adds nothing."""
    done: list[Value | None] = [None] * len(pairs)
    open_now = set()
    for root in range(len(pairs)):
        stack = [root]
        while stack:
            i = stack[-1]
            if done[i] is not None:
                stack.pop()
                continue
            todo = [d for d in means[i] if done[d] is None and d not in open_now] if i not in open_now else []
            open_now.add(i)
            if todo:
                stack += todo
                continue
            value = NOTHING
            for piece in pairs[i].literals:
                value += value_of(text[slice(*piece)])
            for d in means[i]:
                value += done[d] or NOTHING
            done[i] = value
            open_now.discard(i)
            stack.pop()
    return done


def lexed_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Literals whose sensitive name and strong value reach ``threshold``."""
    if "=" not in text and ":" not in text and "(" not in text:
        return []
    pairs = lex(text)
    means = _definitions(pairs)
    values = _values(text, pairs, means)
    best: list[tuple[float, float, str]] = [(0.0, 0.0, "")] * len(pairs)  # score, weight and name of the use that scores highest
    order = sorted(((name_weight(p.name) * strength(v), name_weight(p.name), i) for i, (p, v) in enumerate(zip(pairs, values))), key=lambda r: (-r[0], r[2]))
    seen = [False] * len(pairs)
    for score, weight, i in order:  # the highest score reaches a definition first
        stack = [i] if score >= threshold else []
        while stack:
            d = stack.pop()
            if not seen[d]:
                seen[d] = True
                best[d] = (score, weight, pairs[i].name)
                stack += means[d]
    found = {}
    for pair, (score, _, name) in zip(pairs, best):
        if score >= threshold:
            for piece in pair.literals:
                if value_of(text[slice(*piece)]).length and (piece not in found or found[piece].score < score):
                    found[piece] = Span("lexed", *piece, name, round(score, 6))
    return list(found.values())


def scan_text(text: str | None) -> list[Span]:
    """All spans of a text by start, then by kind as listed; null is empty.
    Lexed spans inside a base span are left out: the base one stays."""
    text = text or ""
    base = sorted(base_spans(text), key=lambda s: (s.start, KINDS.index(s.kind)))
    furthest, ends = -1, []
    for span in base:
        furthest = max(furthest, span.end)
        ends.append(furthest)
    starts = [s.start for s in base]
    more = []
    for span in lexed_spans(text):
        k = bisect_right(starts, span.start)
        if not k or ends[k - 1] < span.end:
            more.append(span)
    return sorted(base + more, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))


def _scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in columns:
        yield pa.array([[s._asdict() for s in scan_text(column[i].as_py())] for i in range(len(column))], _ARROW)


def secret_spans(text: str | Column) -> Column:
    """The spans of a text column as an array of (kind, start, end, name, score),
    code points, end exclusive; a null text gives an empty array."""
    return F.arrow_udf(_scan, SPAN_TYPE)((F.col(text) if isinstance(text, str) else text).cast("string"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts of the base kinds, SHA-256 of the
    base spans and the list of all spans. Null texts are empty, repeated rows
    are scanned each, null ids stay null; other columns are ignored."""
    found = docs.select(F.col(id_col).alias("doc_id"), secret_spans(text_col).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(_listed(F.filter("found", lambda s: s["kind"] != "lexed")), 256).alias("base_sha256"),
                        _listed(F.col("found")).alias("spans"), count("lexed").alias("n_lexed"))
