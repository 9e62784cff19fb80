"""Calendar column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month names, January..December (must equal the source files' spelling).
SPANISH_MONTHS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_name_map() -> Column:
    """Literal map lower-case month name -> month number."""
    kv = []
    for i, name in enumerate(SPANISH_MONTHS, start=1):
        kv += [F.lit(name), F.lit(i)]
    return F.create_map(*kv)


def month_number(month_name: str | Column) -> Column:
    """trim + lower + lookup; unknown names give NULL."""
    return month_name_map()[F.lower(F.trim(_col(month_name)))]


def month_name_to_date(year: str | Column, month_name: str | Column) -> Column:
    """First day of the month named in Spanish (CLN5); NULL when the name is unknown."""
    return year_month_to_date(year, month_number(month_name))


def year_month_to_date(year: str | Column, month: str | Column) -> Column:
    """make_date(y, m, 1) that yields NULL (not an error) for impossible values (CLN6)."""
    y, m = _col(year).cast("int"), _col(month).cast("int")
    return F.when(m.between(1, 12) & y.isNotNull(), F.make_date(y, m, F.lit(1)))


def month_start(d: str | Column) -> Column:
    """Floor a date/timestamp to the first of its month (SCL13)."""
    return F.trunc(_col(d).cast("date"), "MM")


def year_month_label(d: str | Column) -> Column:
    """'YYYY-MM' label of a date (pandas Period('M') string form)."""
    return F.date_format(_col(d), "yyyy-MM")


def iso_week_monday(year: str | Column, week: str | Column) -> Column:
    """Monday of ISO week ``week`` of ``year`` (SCL14).

    Week 53 in a year that has only 52 ISO weeks falls back to week 52. The
    ISO week 1 always contains 4 January, so its Monday is the week-truncation
    of that day.
    """
    y, w = _col(year).cast("int"), _col(week).cast("int")
    has53 = F.weekofyear(F.make_date(y, F.lit(12), F.lit(28))) == 53
    w_eff = F.when((w == 53) & ~has53, F.lit(52)).otherwise(w)
    week1 = F.date_trunc("week", F.make_date(y, F.lit(1), F.lit(4))).cast("date")
    return F.date_add(week1, (w_eff - 1) * 7)


def week_label(year: str | Column, week: str | Column) -> Column:
    """'YYYY-Www' with a zero-padded week (SCL2)."""
    return F.concat(_col(year).cast("string"), F.lit("-W"), F.lpad(_col(week).cast("string"), 2, "0"))


def cyclic_week(week: str | Column, period: int = 52) -> tuple[Column, Column]:
    """(sin, cos) encoding of the week number (SCL8)."""
    angle = F.lit(2 * math.pi) * _col(week).cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def in_calendar_window(d: str | Column, year: int, months: list[int]) -> Column:
    """year(d) == year and month(d) in months, as int 0/1 (TS6)."""
    dc = _col(d)
    return ((F.year(dc) == year) & F.month(dc).isin(months)).cast("int")


def year_between(d: str | Column, first_year: int, last_year: int) -> Column:
    """first_year <= year(d) <= last_year written as a range on the raw column,
    so Parquet scans get it as pushed filters (``year(d) BETWEEN`` is not)."""
    dc = _col(d)
    return (dc >= F.lit(f"{int(first_year):04d}-01-01")) & (dc < F.lit(f"{int(last_year) + 1:04d}-01-01"))
