"""Numeric parsing and null-safe arithmetic expressions (S1, S2, S9, S14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date sentinels that mean "no date yet" in the case line-list.
DATE_SENTINELS = ["9999-99-99", "9999/99/99"]

# Whitespace-like characters removed before parsing counts
# (narrow no-break space U+202F, no-break space U+00A0, plain space).
COUNT_SPACE_PATTERN = "[\u202f\u00a0 ]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


INTEGRAL = {"int", "integer", "long", "bigint", "short", "smallint", "tinyint", "byte"}


def tcast(c: str | Column, to: str) -> Column:
    """try_cast: NULL instead of an error when the value doesn't convert (S1).

    Strings headed for an integral type are first matched against a digits
    pattern: a failed cast costs an exception per row, so values that cannot
    convert are turned to NULL without attempting it (same result)."""
    x = _col(c)
    if to.lower() in INTEGRAL:
        # Spark trims characters <= U+0020 before an integral cast: same here
        return F.when(x.cast("string").rlike(r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"), x.try_cast(to))
    return x.try_cast(to)


def sentinel_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date parse where sentinels and impossible dates become NULL (CLN2)."""
    s = F.trim(_col(c).cast("string"))
    return F.when(~s.isin(DATE_SENTINELS), F.try_to_date(s, fmt))


def strip_thousands(c: str | Column, sep: str = ".", to: str = "double") -> Column:
    """Remove a thousands separator, then cast with null on failure (CLN4)."""
    return tcast(F.trim(F.replace(_col(c).cast("string"), F.lit(sep), F.lit(""))), to)


def parse_count(c: str | Column) -> Column:
    """Bulletin cell number (SCL6 + S14): drop NBSP/U+202F/space; a failed
    integer parse (``n.d.``, ``-``, ``1,234``, empty) gives 0, not NULL."""
    cleaned = F.regexp_replace(F.trim(_col(c).cast("string")), COUNT_SPACE_PATTERN, "")
    return F.coalesce(tcast(cleaned, "int"), F.lit(0))


def safe_ratio(num: str | Column, den: str | Column, default: float | None = None) -> Column:
    """num / den with NULL (or ``default``) when den is 0 or NULL (S2, AGG2)."""
    r = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return F.coalesce(r, F.lit(default)) if default is not None else r


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """pandas/Python rounding (S9, SCL10)."""
    return F.bround(_col(c), digits)


def clip(c: str | Column, lower: float | None = None, upper: float | None = None) -> Column:
    """SCL9: clip to a lower and/or upper bound (``abs`` is ``F.abs``)."""
    out = _col(c)
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return out


def band_label(c: str | Column, bands: list[tuple[float, str]], otherwise: str) -> Column:
    """Threshold bands (SCL15): first (lower bound, label) with value >= bound,
    bounds given from high to low; NULL stays NULL."""
    x = _col(c)
    out = None
    for bound, label in bands:
        out = F.when(x >= bound, F.lit(label)) if out is None else out.when(x >= bound, F.lit(label))
    return F.when(x.isNull(), F.lit(None)).otherwise(out.otherwise(F.lit(otherwise)))
