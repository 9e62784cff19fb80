"""Small tables with the awkward rows every operator must take."""

import random

from pyspark.sql import types as T

LETTERS = "abcdefghijklmnop"


def words(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward(spark, extra=()):
    """Null and repeated ids, null, empty, blank and very long texts, equal
    rows, near copies, a null source, and columns of names used inside."""
    rng = random.Random(4)
    base = words(rng, 60)
    near = base.replace(base.split()[30], "changed", 1)
    long_text = words(rng, 60_000)
    texts = [(1, base), (2, near), (3, base), (3, base), (4, None), (5, ""), (6, " \n\t "), (7, long_text), (None, base), (None, None),
             (8, "one two"), (9, "One\vTWO"), (10, words(rng, 80)), (11, "ünïcode ß 日本 語 text here now"), (12, long_text + " end"), *extra]
    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()),
        ("score", T.StringType()), ("node", T.StringType()), ("h1", T.IntegerType()), ("mix_slot", T.StringType()), ("n_lines", T.StringType()))])
    rows = [(i, t, None, None if k % 5 == 0 else f"s{k % 3}", None, "x", None, 1, "y", "z") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def documents(spark, texts, source=lambda i: "a"):
    return spark.createDataFrame([(i, t, "en", source(i), len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def empty(df):
    return df.where("false")
