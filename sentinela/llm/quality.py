"""Quality classifier: a factorisation machine (operator 5).

A document is a sparse vector of hashed words and of binned structure
statistics (its length among them). Its logit is

    w0 + sum_j w_j x_j + 1/2 sum_f [(sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2],

so that all pairwise interactions cost time linear in the number of features.
Statistics are taken over the whole text and over the worst stretch of words,
so that junk inside a clean text shows. Training is NumPy in one task on a
bounded sample (``rows_per_class``); scoring is an Arrow UDF over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.llm.labelled import fit_in_one_task, held_out, training_rows
from sentinela.llm.textops import batches_of, column_bytes, hash_spans, is_space, lower_ascii, word_spans

#: Hashed words, bins of a statistic, rank of the interactions.
WORD_DIM, BINS, RANK = 1 << 15, 16, 8
#: Words of a stretch, and training rows of each class at most.
STRETCH, ROWS_PER_CLASS = 32, 4000
EPOCHS, STEPS, BATCH, RATE, DECAY = 8, 400, 64, 0.03, 1e-4  # at least so many passes and steps
THRESHOLD = 0.3

_MARKS = np.isin(np.arange(256), np.frombuffer(b"#%&$*|<>{}[]\\^~=+_@", np.uint8))


def _per_word(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return (sums[ends] - sums[starts]).astype(np.float64)


def _sums(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[of[1:]] - total[of[:-1]]


def _worst(top: np.ndarray, bottom: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each text, the largest ratio of sums over its stretches of words."""
    n_words = np.diff(of)
    stretches = np.maximum(n_words // STRETCH, (n_words > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n_words)), stretches)
    at = np.arange(len(text)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    a = of[text] + at * STRETCH
    b = np.where(at == stretches[text] - 1, of[text + 1], a + STRETCH)
    t, u = np.concatenate([[0.0], np.cumsum(top)]), np.concatenate([[0.0], np.cumsum(bottom)])
    out = np.zeros(len(n_words))
    np.maximum.at(out, text, (t[b] - t[a]) / np.maximum(u[b] - u[a], 1.0))
    return out


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature numbers, values, n + 1 offsets) of the texts of a column."""
    data, offsets = column_bytes(column)
    low = lower_ascii(data)
    starts, ends, of = word_spans(data, offsets)
    words = hash_spans(low, starts, ends)
    n, n_words, n_bytes = len(offsets) - 1, np.diff(of), np.diff(offsets)
    text = np.repeat(np.arange(n), n_words)
    length = (ends - starts).astype(np.float64)
    upper = _per_word(low != data, starts, ends)
    marks = _per_word(_MARKS[data], starts, ends)
    bangs = _per_word(data == 33, starts, ends)
    digits = _per_word((data >= 48) & (data <= 57), starts, ends)
    again = np.zeros(len(words))
    again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((words, text))
    first = np.ones(len(words), dtype=bool)
    first[1:] = (words[order][1:] != words[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct = np.bincount(text[order][first], minlength=n)
    one, size, count = np.ones(len(words)), np.maximum(_sums(length, of), 1), np.maximum(n_words, 1)
    shares = [_sums(upper, of) / size, _sums(marks, of) / size, _sums(bangs, of) / size, _sums(digits, of) / size, _sums(again, of) / count,
              _worst(upper, length, of), _worst(marks, length, of), _worst(bangs, length, of), _worst(digits, length, of), _worst(again, one, of)]
    scales = [np.minimum(np.sqrt(np.maximum(s, 0)), 1) * (BINS - 1) for s in shares]
    spaces = np.concatenate([[0], np.cumsum(is_space(data))])
    scales += [np.log2(1 + n_words), np.log2(1 + n_bytes) * 0.75, np.minimum(_sums(length, of) / count, 15), distinct / count * (BINS - 1),
               np.minimum((spaces[offsets[1:]] - spaces[offsets[:-1]]) / np.maximum(n_bytes, 1) * 2, 1) * (BINS - 1)]
    n_stats = len(scales)
    stat_ids = np.stack([WORD_DIM + k * BINS + np.clip(np.ceil(s - 1e-9) if k < len(shares) else np.rint(s), 0, BINS - 1).astype(np.int64) for k, s in enumerate(scales)], axis=1)
    word_ids = (words[order][first] % np.uint64(WORD_DIM)).astype(np.int64)
    out_of = np.concatenate([[0], np.cumsum(distinct + n_stats)])
    ids, values = np.empty(out_of[-1], np.int64), np.empty(out_of[-1], np.float32)
    to = np.arange(len(word_ids)) + np.repeat(np.arange(n) * n_stats, distinct)
    ids[to], values[to] = word_ids, np.repeat(1 / np.sqrt(np.maximum(distinct, 1)), distinct)
    to = (out_of[1:] - n_stats)[:, None] + np.arange(n_stats)
    ids[to], values[to] = stat_ids, 1.0 / np.sqrt(n_stats)
    return ids, values, out_of


def n_features() -> int:
    return WORD_DIM + 15 * BINS


def logits(model: dict, ids: np.ndarray, values: np.ndarray, of: np.ndarray):
    x = model["v"][ids] * values[:, None]
    total, squares = np.add.reduceat(x, of[:-1]), np.add.reduceat((x * x).sum(axis=1), of[:-1])
    linear = np.add.reduceat(model["w"][ids] * values, of[:-1])
    return model["w0"] + linear + 0.5 * ((total * total).sum(axis=1) - squares), x, total


def fit(texts: pa.Array, y: np.ndarray) -> dict:
    """Adagrad on the logistic loss, both classes of equal weight; the same rows
    in the same order give the same model."""
    rng = np.random.default_rng(11)
    model = {"w0": np.float32(0), "w": np.zeros(n_features(), np.float32),
             "v": rng.normal(0, 0.05, (n_features(), RANK)).astype(np.float32)}
    if not len(y):
        return model
    parts = [features(texts.slice(i, j - i)) for i, j in batches_of(texts)]
    ids, values = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    lengths = np.concatenate([np.diff(p[2]) for p in parts])
    of = np.concatenate([[0], np.cumsum(lengths)])
    seen_w, seen_v, seen_0 = np.full(n_features(), 1e-3, np.float32), np.full((n_features(), RANK), 1e-3, np.float32), 1e-3
    share = np.bincount(y.astype(np.int64), minlength=2) / len(y)
    weight = (0.5 / np.maximum(share, 1 / len(y)))[y.astype(np.int64)]
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(y)))):
        order = rng.permutation(len(y))
        for rows in (order[i:i + BATCH] for i in range(0, len(order), BATCH)):
            own = np.concatenate([[0], np.cumsum(lengths[rows])])
            take = np.repeat(of[rows] - own[:-1], lengths[rows]) + np.arange(own[-1])
            j, x = ids[take], values[take]
            z, vx, total = logits(model, j, x, own)
            error = ((1 / (1 + np.exp(-z)) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            each = np.repeat(error, lengths[rows])
            sort = np.argsort(j, kind="stable")
            keys, at = np.unique(j[sort], return_index=True)
            grad_w = np.add.reduceat((each * x)[sort], at) + DECAY * model["w"][keys]
            grad_v = np.add.reduceat(((each * x)[:, None] * (np.repeat(total, lengths[rows], axis=0) - vx))[sort], at) + DECAY * model["v"][keys]
            seen_w[keys] += grad_w**2
            seen_v[keys] += grad_v**2
            seen_0 += float(error.sum())**2
            model["w"][keys] -= RATE * 5 * grad_w / np.sqrt(seen_w[keys])
            model["v"][keys] -= RATE * grad_v / np.sqrt(seen_v[keys])
            model["w0"] -= np.float32(RATE * float(error.sum()) / np.sqrt(seen_0))
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> dict:
    """The model of ``label``, fitted in one task on a bounded sample; without
    rows it scores 1/2."""
    rows = training_rows(docs, labels, label, rows_per_class)
    return fit_in_one_task(rows, fit)


def scorer(spark, model: dict):
    """Text column -> probability of label 1."""
    shared = spark.sparkContext.broadcast(model)  # of a fixed size

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = [np.zeros(0)]
            for i, j in batches_of(column):
                out.append(1 / (1 + np.exp(-logits(shared.value, *features(column.slice(i, j - i)))[0].astype(np.float64))))
            yield pa.array(np.concatenate(out), pa.float64())

    return score


def quality_score(docs: DataFrame, model: dict, text_col: str = "text") -> Column:
    """The score of a text as a column; null and empty texts are scored by their
    statistics alone, texts of any length whole."""
    return scorer(docs.sparkSession, model)(F.col(text_col).cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every input row, repeated rows
    included; extra columns are ignored and an empty table gives no rows."""
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out().alias("held_out"), quality_score(docs, model).alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
