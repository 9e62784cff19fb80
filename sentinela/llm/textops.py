"""Vectorised text primitives on Arrow string columns.

All functions work on the raw UTF-8 bytes of a whole Arrow column, so a batch of
documents costs a few NumPy passes instead of a Python loop over its words.
Words are the maximal runs of bytes outside ``\\x20\\x09-\\x0D`` after lower-casing
A-Z. A word's hash is a polynomial in random 64-bit byte values, finished by a
bijective mixer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes handled at once; a longer text is cut at white space.
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20_240_817)
_BYTE_VALUE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**62)) * 8 + 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and odd multiplications)."""
    h = h.astype(np.uint64, copy=True)
    h += np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for key, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES) + 1, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each ``data[start:end]`` (starts ascending); the
    spans are hashed in runs of about CHUNK_BYTES."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        first = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, first + CHUNK_BYTES, side="right")))
        piece = data[first:ends[j - 1]]
        up, down = _powers(len(piece))
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[piece] * up[:len(piece)], out=sums[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        out[i:j] = mix((sums[e] - sums[s]) * down[s], 1)
        i = j
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word and, for n texts, n + 1 offsets into them."""
    word = ~is_space(data)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data) + 1, dtype=bool)  # nothing, white space or another text before this byte
    before[0] = True
    before[1:] = ~word
    before |= edge
    starts = np.flatnonzero(word & before[:-1])
    after = np.empty(len(data), dtype=bool)
    if len(data):
        after[:-1] = ~word[1:]
        after[-1] = True
        after |= edge[1:]
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column and n + 1 offsets into them."""
    data, offsets = column_bytes(column)
    data = lower_ascii(data)
    starts, ends, of = word_spans(data, offsets)
    return hash_spans(data, starts, ends), of


def batches_of(column: pa.Array, most: int = CHUNK_BYTES):
    """(first, last) row ranges of at most ``most`` bytes, or one text each."""
    _, offsets = column_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def shingle_hashes(words: np.ndarray, of: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles (with repeats) of each text, and
    n + 1 offsets; a text with fewer words gives one shingle of all of them."""
    n_words = np.diff(of)
    n_out = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(np.int64))
    out_of = np.concatenate([[0], np.cumsum(n_out)])
    out = np.empty(out_of[-1], dtype=np.uint64)
    keys = mix(np.arange(1, width + 1, dtype=np.uint64), 7) | np.uint64(1)
    total = len(words)
    if total >= width:
        acc = np.zeros(total - width + 1, dtype=np.uint64)
        for k in range(width):
            acc += words[k:total - width + 1 + k] * keys[k]
        acc = mix(acc, 2)
        full = n_words >= width
        lengths = np.where(full, n_out, 0)
        at = np.repeat(of[:-1] - np.concatenate([[0], np.cumsum(lengths)])[:-1], lengths) + np.arange(lengths.sum())
        to = np.repeat(out_of[:-1] - np.concatenate([[0], np.cumsum(lengths)])[:-1], lengths) + np.arange(lengths.sum())
        out[to] = acc[at]
    for i in np.flatnonzero((n_words > 0) & (n_words < width)):
        w = words[of[i]:of[i + 1]]
        out[out_of[i]] = mix((w * keys[:len(w)]).sum(dtype=np.uint64, keepdims=True), 100 + len(w))[0]
    return out, out_of
