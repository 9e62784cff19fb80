"""Text column expressions: header repair, regex capture, line splitting, prefix match."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentinela.functions.numeric import tcast


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters Python's str.strip() / str.split() treat as
# whitespace (ASCII controls and spaces, NEL, NBSP, Ogham, en/em spaces,
# line/paragraph separators, narrow NBSP, math space, ideographic space).
PY_WHITESPACE = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def py_strip(c: str | Column) -> Column:
    """str.strip() semantics (Spark's trim removes only ' ')."""
    return F.regexp_replace(_col(c), f"^{PY_WHITESPACE}+|{PY_WHITESPACE}+$", "")


def py_split(c: str | Column) -> Column:
    """str.split() with no separator: runs of whitespace, no empty tokens."""
    return F.filter(F.split(py_strip(c), f"{PY_WHITESPACE}+"), lambda x: x != F.lit(""))


def clean_header(name: str) -> str:
    """Header repair (SRC3, SCL1): strip, newline -> space, double space -> one."""
    return str(name).strip().replace("\n", " ").replace("  ", " ")


def first_capture(c: str | Column, pattern: str, group: int = 1) -> Column:
    """First regex capture, NULL when there is no match (SCL3)."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def capture_with_fallback(primary: str | Column, fallback: str | Column, pattern: str,
                          fallback_pattern: str | None = None, default=None, to: str | None = None) -> Column:
    """Capture from ``primary``; else from ``fallback``; else ``default`` (EXT1)."""
    a = first_capture(primary, pattern)
    b = first_capture(fallback, fallback_pattern or pattern)
    out = F.coalesce(a, b)
    if to:
        out = tcast(out, to)
    return F.coalesce(out, F.lit(default)) if default is not None else out


def nonblank_lines(c: str | Column) -> Column:
    """split on newline, trim, drop blanks -> array<string> (SCL5)."""
    return F.filter(F.transform(F.split(_col(c), "\n"), lambda x: py_strip(x)), lambda x: x != F.lit(""))


def longest_first_alternation(names: list[str]) -> str:
    """Anchored regex alternation over a catalogue, longest names first so that
    'Baja California Sur' wins over 'Baja California' (JN8)."""
    ordered = sorted(set(names), key=lambda s: (-len(s), s))
    return "^(" + "|".join(re.escape(n) for n in ordered) + ")"


def prefix_and_rest(c: str | Column, names: list[str]) -> tuple[Column, Column]:
    """(matched catalogue prefix or NULL, trimmed remainder of the line) (SCL4)."""
    line = _col(c)
    match = first_capture(line, longest_first_alternation(names))
    rest = F.when(match.isNotNull(), py_strip(F.substring(line, F.length(match) + 1, 1 << 30)))
    return match, rest
