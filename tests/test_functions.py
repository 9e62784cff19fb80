"""Column functions: calendar, numeric parsing, text (S1, S9, S14, CLN2-5, SCL2-14)."""

import datetime as dt
import re

from pyspark.sql import functions as F

from sentinela.functions.calendar import (iso_week_monday, month_name_to_date, week_label, year_month_to_date)
from sentinela.functions.numeric import parse_count, round_half_even, sentinel_date, strip_thousands
from sentinela.functions.text import longest_first_alternation, nonblank_lines, prefix_and_rest, py_split, py_strip


def _iso_monday(y, w):
    try:
        return dt.date.fromisocalendar(y, w, 1)
    except ValueError:
        return dt.date.fromisocalendar(y, 52, 1)


def test_iso_week_monday_matches_python(spark):
    rows = [(y, w) for y in range(1995, 2031) for w in range(1, 54)]
    df = spark.createDataFrame(rows, "y int, w int").select("y", "w", iso_week_monday("y", "w").alias("d"))
    got = {(r.y, r.w): r.d for r in df.collect()}
    assert all(got[(y, w)] == _iso_monday(y, w) for y, w in rows)


def test_week_label(spark):
    r = spark.range(1).select(week_label(F.lit(2020), F.lit(3)).alias("s")).first()
    assert r.s == "2020-W03"


def test_month_names(spark):
    df = spark.createDataFrame([(2020, " Enero "), (2021, "DICIEMBRE"), (2022, "setiembre"), (None, "mayo")],
                               "y int, m string")
    got = [r.d for r in df.select(month_name_to_date("y", "m").alias("d")).collect()]
    assert got == [dt.date(2020, 1, 1), dt.date(2021, 12, 1), None, None]


def test_year_month_bad_values(spark):
    df = spark.createDataFrame([(2020, 13), (2020, 0), (2020, 2)], "y int, m int")
    got = [r.d for r in df.select(year_month_to_date("y", "m").alias("d")).collect()]
    assert got == [None, None, dt.date(2020, 2, 1)]


def test_sentinel_dates(spark):
    df = spark.createDataFrame([("9999-99-99",), ("9999/99/99",), ("2021-02-30",), ("2021-03-04",), (None,)], "s string")
    got = [r.d for r in df.select(sentinel_date("s").alias("d")).collect()]
    assert got == [None, None, None, dt.date(2021, 3, 4), None]


def test_parse_count_quirks(spark):
    vals = ["1 234", "1 234", " 56 ", "n.d.", "-", "", None, "1,234", "s.n."]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.n for r in df.select(parse_count("s").alias("n")).collect()]
    assert got == [1234, 1234, 56, 0, 0, 0, 0, 0, 0]


def test_strip_thousands(spark):
    df = spark.createDataFrame([("1.234.567",), ("12",), ("x",)], "s string")
    got = [r.n for r in df.select(strip_thousands("s", ".", "long").alias("n")).collect()]
    assert got == [1234567, 12, None]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (2.675,)], "x double")
    got = [r.y for r in df.select(round_half_even("x", 0).alias("y")).collect()]
    assert got == [0.0, 2.0, 2.0, 3.0]


def test_longest_prefix(spark):
    names = ["Baja California", "Baja California Sur", "México", "Ciudad de México"]
    assert longest_first_alternation(names).startswith("^(" + re.escape("Baja California Sur") + "|")
    df = spark.createDataFrame([("Baja California Sur 12",), ("Baja California 3",), ("Ciudad de México 1",),
                                ("TOTAL 9",)], "l string")
    m, rest = prefix_and_rest("l", names)
    got = [(r.m, r.r) for r in df.select(m.alias("m"), rest.alias("r")).collect()]
    assert got == [("Baja California Sur", "12"), ("Baja California", "3"), ("Ciudad de México", "1"), (None, None)]


def test_python_whitespace_semantics(spark):
    vals = ["  a b  ", " x ", "1 234 5", "\tq\n"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.select(py_strip("s").alias("a"), py_split("s").alias("b"), nonblank_lines("s").alias("c")).collect()
    for v, r in zip(vals, got):
        assert r.a == v.strip()
        assert list(r.b) == v.split()
        assert list(r.c) == [x.strip() for x in v.split("\n") if x.strip()]
