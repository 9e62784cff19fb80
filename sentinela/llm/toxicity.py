"""Toxicity: a bidirectional gated recurrent network with attention (operator 9).

A word enters as the sum of its own hashed vector and the mean vector of its
hashed character 3- and 5-grams (with marks at both ends). Two gated recurrent
passes read a window of words, attention pools their states, and a logistic
unit scores the window. Windows overlap by half and cover the whole text; the
score of a text is that of its worst window. Training is NumPy
back-propagation in one task on a bounded sample of labelled texts, by multiple
instances: the worst windows of a text, under the present network, carry its
label. Scoring computes the input projections once per distinct word of a batch
and steps all windows of the batch together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.llm.labelled import fit_in_one_task, held_out, training_rows
from sentinela.llm.textops import CHUNK_BYTES, batches_of, column_bytes, hash_spans, lower_ascii, mix, word_spans

#: Hashed words and character n-grams, their vectors' length, states of a direction, attention units.
WORD_DIM, GRAM_DIM, IN, HIDDEN, ATTEND = 1 << 12, 1 << 14, 8, 8, 8
#: Words of a window and from one window to the next.
WINDOW, STEP = 32, 16
ROWS_PER_CLASS, EPOCHS, MOST_EPOCHS, STEPS, BATCH, RATE = 2500, 14, 50, 800, 64, 0.01
#: Windows stepped together.
TOGETHER = 4096
THRESHOLD = 0.5
GRAMS = (3, 5)


def windows(of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of the windows; the last ends with the text,
    a text without words has one empty window."""
    n_words = np.diff(of)
    count = np.maximum(1, -(-(n_words - WINDOW) // STEP) + 1)
    text = np.repeat(np.arange(len(n_words)), count)
    at = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * STEP
    at = np.maximum(np.minimum(at, n_words[text] - WINDOW), 0)
    return text, of[text] + at, np.minimum(n_words[text], WINDOW)


def distinct_words(column: pa.Array):
    """(word of each position, n + 1 offsets, word buckets, n-gram buckets,
    offsets of each distinct word's n-grams)."""
    data, offsets = column_bytes(column)
    data = lower_ascii(data)
    starts, ends, of = word_spans(data, offsets)
    keys, first, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
    length = ends[first] - starts[first]
    # the distinct words, each between two marks, one after the other
    at = np.concatenate([[0], np.cumsum(length + 2)])
    own = np.repeat(starts[first] - at[:-1] - 1, length + 2) + np.arange(at[-1])
    own[at[:-1]] = own[at[1:] - 1] = 0
    chars = data[own].astype(np.uint64) if len(data) else np.zeros(0, np.uint64)
    chars[at[:-1]], chars[at[1:] - 1] = 1, 2
    word = np.repeat(np.arange(len(first)), length + 2)
    last = np.repeat(at[1:], length + 2)
    grams, of_word = [], []
    for g in GRAMS:
        n = max(len(chars) - g + 1, 0)
        h = np.zeros(n, np.uint64)
        for k in range(g):
            h = h * np.uint64(0x100000001B3) + chars[k:k + n]
        whole = np.arange(n) + g <= last[:n]
        grams.append((mix(h[whole], g) % np.uint64(GRAM_DIM)).astype(np.int64))
        of_word.append(word[:n][whole])
    grams, of_word = np.concatenate(grams), np.concatenate(of_word)
    order = np.argsort(of_word, kind="stable")
    gram_of = np.concatenate([[0], np.cumsum(np.bincount(of_word, minlength=len(first)))])
    return which.astype(np.int64), of, (mix(keys, 9) % np.uint64(WORD_DIM)).astype(np.int64), grams[order], gram_of


def new_model() -> dict:
    rng = np.random.default_rng(5)
    normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    return {"word": normal(0.1, WORD_DIM, IN), "gram": normal(0.3, GRAM_DIM, IN),
            "in": normal(0.4, IN, 6 * HIDDEN), "in0": np.zeros(6 * HIDDEN, np.float32),
            "back": normal(0.3, 2, HIDDEN, 3 * HIDDEN), "att": normal(0.4, 2 * HIDDEN, ATTEND), "att0": np.zeros(ATTEND, np.float32),
            "pick": normal(0.4, ATTEND), "out": normal(0.4, 2 * HIDDEN), "out0": np.zeros(1, np.float32)}


def word_vectors(model: dict, buckets, grams, gram_of) -> np.ndarray:
    """One row per distinct word; every word has at least one 3-gram."""
    if not len(buckets):
        return np.zeros((0, IN), np.float32)
    sums = np.add.reduceat(model["gram"][grams], gram_of[:-1])
    return model["word"][buckets] + sums / np.diff(gram_of)[:, None].astype(np.float32)


def _gates(x, h, back):
    """Update and reset gates, candidate and what it was made of."""
    past = h @ back
    zr = 0.5 * np.tanh(0.5 * (x[:, :2 * HIDDEN] + past[:, :2 * HIDDEN])) + np.float32(0.5)
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    n = np.tanh(x[:, 2 * HIDDEN:] + r * past[:, 2 * HIDDEN:])
    return z, r, n, past[:, 2 * HIDDEN:]


def _read(model, x, keep: bool):
    """States (windows, WINDOW, 2 * HIDDEN) of the projected inputs x, and per
    direction the steps' values where ``keep``."""
    states, kept = np.empty((len(x), WINDOW, 2 * HIDDEN), np.float32), ([], [])
    for d in (0, 1):
        h = np.zeros((len(x), HIDDEN), np.float32)
        for t in range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1):
            z, r, n, c = _gates(x[:, t, 3 * HIDDEN * d:3 * HIDDEN * (d + 1)], h, model["back"][d])
            if keep:
                kept[d].append((t, h, z, r, n, c))
            h = n + z * (h - n)
            states[:, t, HIDDEN * d:HIDDEN * (d + 1)] = h
    return states, kept


def _pool(model, states, n_words):
    u = np.tanh(states @ model["att"] + model["att0"])
    s = u @ model["pick"]
    s[np.arange(WINDOW)[None, :] >= np.maximum(n_words, 1)[:, None]] = -1e9
    a = np.exp(s - s.max(axis=1, keepdims=True))
    a /= a.sum(axis=1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", a, states)
    return u, a, pooled, pooled @ model["out"] + model["out0"][0]


def _positions(first, n_words, which, blank):
    """Distinct word at each step of the windows; steps behind a short text are blank."""
    step = np.arange(WINDOW)[None, :]
    inside = step < n_words[:, None]
    at = np.where(inside, first[:, None] + step, 0)
    return np.where(inside, which[at] if len(which) else blank, blank)


def window_logits(model, which, of, buckets, grams, gram_of):
    """(text of each window, first word, words, logit)."""
    text, first, n_words = windows(of)
    x = np.concatenate([word_vectors(model, buckets, grams, gram_of), np.zeros((1, IN), np.float32)]) @ model["in"] + model["in0"]
    out = np.empty(len(text), np.float32)
    for i in range(0, len(text), TOGETHER):
        s = slice(i, i + TOGETHER)
        states, _ = _read(model, x[_positions(first[s], n_words[s], which, len(x) - 1)], False)
        out[s] = _pool(model, states, n_words[s])[3]
    return text, first, n_words, out


def text_logits(model, column: pa.Array) -> np.ndarray:
    which, of, buckets, grams, gram_of = distinct_words(column)
    text, _, _, z = window_logits(model, which, of, buckets, grams, gram_of)
    return np.maximum.reduceat(z, np.searchsorted(text, np.arange(len(column))))


def gradients(model, words, n_words, y, buckets, grams, gram_of):
    """Loss gradients of a batch; ``words`` (windows, WINDOW) holds distinct
    words, len(buckets) where blank. Gradients of the two tables come as
    (rows, values)."""
    g = {k: np.zeros_like(v) for k, v in model.items() if k not in ("word", "gram")}
    used, at = np.unique(words, return_inverse=True)
    at = at.reshape(words.shape)
    known = used[used < len(buckets)]
    pieces = np.repeat(gram_of[known] - np.concatenate([[0], np.cumsum(np.diff(gram_of)[known])[:-1]]), np.diff(gram_of)[known]) + np.arange(np.diff(gram_of)[known].sum())
    counts = np.diff(gram_of)[known]
    own_of = np.concatenate([[0], np.cumsum(counts)])
    e = np.zeros((len(used), IN), np.float32)
    e[:len(known)] = word_vectors(model, buckets[known], grams[pieces], own_of)
    x = (e @ model["in"] + model["in0"])[at]
    states, kept = _read(model, x, True)
    u, a, pooled, z = _pool(model, states, n_words)
    dz = ((1 / (1 + np.exp(-z)) - y) / len(y)).astype(np.float32)
    g["out"], g["out0"][0] = pooled.T @ dz, dz.sum()
    dpool = dz[:, None] * model["out"]
    dstates = a[:, :, None] * dpool[:, None, :]
    da = np.einsum("nh,nth->nt", dpool, states)
    ds = a * (da - (a * da).sum(axis=1, keepdims=True))
    g["pick"] = np.einsum("nt,nta->a", ds, u)
    du = ds[:, :, None] * model["pick"] * (1 - u * u)
    g["att"], g["att0"] = np.einsum("nth,nta->ha", states, du), du.sum(axis=(0, 1))
    dstates += du @ model["att"].T
    dx = np.zeros_like(x)
    for d in (0, 1):
        dh = np.zeros((len(x), HIDDEN), np.float32)
        back = model["back"][d]
        for t, h, zg, r, n, c in reversed(kept[d]):
            dh = dh + dstates[:, t, HIDDEN * d:HIDDEN * (d + 1)]
            dn = dh * (1 - zg) * (1 - n * n)
            dzr = np.concatenate([dh * (h - n) * zg * (1 - zg), dn * c * r * (1 - r)], axis=1)
            dx[:, t, 3 * HIDDEN * d:3 * HIDDEN * (d + 1)] = np.concatenate([dzr, dn], axis=1)
            dpast = np.concatenate([dzr, dn * r], axis=1)
            g["back"][d] += h.T @ dpast
            dh = dh * zg + dpast @ back.T
    flat = dx.reshape(-1, 6 * HIDDEN)
    g["in0"] = flat.sum(axis=0)
    dproj = np.zeros((len(used), 6 * HIDDEN), np.float32)
    np.add.at(dproj, at.ravel(), flat)
    g["in"] = e.T @ dproj
    de = (dproj @ model["in"].T)[:len(known)]
    tables = {"word": (buckets[known], de), "gram": (grams[pieces], np.repeat(de / counts[:, None].astype(np.float32), counts, axis=0))}
    return g, tables


class _Adam:
    """Adam; of the two tables, only the rows that a batch meets are moved."""

    def __init__(self, model):
        self.model, self.t = model, 0
        self.m = {k: np.zeros_like(v) for k, v in model.items()}
        self.v = {k: np.zeros_like(v) for k, v in model.items()}

    def step(self, g, tables):
        self.t += 1
        scale = RATE * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        for k, (rows, values) in tables.items():
            keys, at = np.unique(rows, return_inverse=True)
            sums = np.zeros((len(keys), IN), np.float32)
            np.add.at(sums, at, values)
            g[k] = (keys, sums)
        for k, grad in g.items():
            rows, grad = grad if isinstance(grad, tuple) else (slice(None), grad)
            self.m[k][rows] = 0.9 * self.m[k][rows] + 0.1 * grad
            self.v[k][rows] = 0.99 * self.v[k][rows] + 0.01 * grad * grad
            self.model[k][rows] -= (scale * self.m[k][rows] / (np.sqrt(self.v[k][rows]) + 1e-6)).astype(np.float32)


def fit(texts: pa.Array, y: np.ndarray) -> dict:
    """The same rows in the same order give the same model."""
    model = new_model()
    if not len(y):
        return model
    rng, adam = np.random.default_rng(3), _Adam(model)
    which, of, buckets, grams, gram_of = distinct_words(texts)
    # few rows are gone through more often, for about STEPS steps
    for epoch in range(max(EPOCHS, min(MOST_EPOCHS, -(-STEPS * BATCH // len(y))))):
        text, first, n_words, z = window_logits(model, which, of, buckets, grams, gram_of)
        # the worst windows of each text, early on with some chance
        order = np.lexsort((-(z + rng.gumbel(0, max(0.0, 1.0 - epoch / 4) + 1e-3, len(z))), text))
        rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        chosen = order[rank < (3 if epoch < 4 else 1)]
        rng.shuffle(chosen)
        for i in range(0, len(chosen), BATCH):
            c = chosen[i:i + BATCH]
            words = _positions(first[c], n_words[c], which, len(buckets))
            adam.step(*gradients(model, words, n_words[c], y[text[c]], buckets, grams, gram_of))
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> dict:
    """The network of ``label``, fitted in one task on a bounded sample."""
    rows = training_rows(docs, labels, label, rows_per_class)
    return fit_in_one_task(rows, fit)


def toxicity_score(docs: DataFrame, model: dict, text_col: str = "text") -> Column:
    """The score of a text as a column; null and empty texts have one blank window."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = [np.zeros(0)]
            for i, j in batches_of(column, 4 * CHUNK_BYTES):  # many texts share their words
                out.append(1 / (1 + np.exp(-text_logits(shared.value, column.slice(i, j - i)).astype(np.float64))))
            yield pa.array(np.concatenate(out), pa.float64())

    return score(F.col(text_col).cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every input row, repeated rows
    included; extra columns are ignored and an empty table gives no rows."""
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity_score(docs, model).alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
