"""Token ids of whole Arrow text columns with the ``tokenizers`` library.

Invented and natural prose alike repeat their words, so a column is cut at
places where the byte-level pre-tokeniser always starts a new token (a single
space or line break between two visible characters, a change between letters,
digits and other visible characters), every distinct piece is encoded once by
the library, and the ids are put together with NumPy. The ids equal those of
encoding each text alone; tests compare them.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from sentinela.llm.textops import batches_of, column_bytes, hash_spans

#: Distinct pieces remembered by one Python worker.
REMEMBERED = 1_500_000
#: Distinct pieces given to the library in one string, a line break between them.
JOINED = 30


def default_tokenizer() -> str:
    """Path of the public byte-level BPE file, a parameter of every operator here."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _starts_token() -> np.ndarray:
    """Bytes that begin a visible character for certain: no white space of
    Unicode starts with them (those start with C2, E1, E2 or E3)."""
    ok = np.zeros(256, dtype=bool)
    ok[0x21:0x7F] = True
    ok[0xC3:0xF5] = True
    ok[[0xE1, 0xE2, 0xE3]] = False
    return ok


_STARTS = _starts_token()
#: Bytes of pieces without white space but a leading space (which may not precede the bytes that start Unicode's white space).
_PLAIN = np.isin(np.arange(256), [*range(0x21, 0x7F), *range(0x80, 0xC2), *range(0xC3, 0xE1), *range(0xE4, 0xF5)])
#: Kinds of bytes: 1 ASCII letters, 2 digits, 3 other visible characters, 4 the apostrophe, which may take letters along, 5 the line break; 0 the rest.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[39], _KIND[10] = 4, 5
_TURNS = np.zeros((6, 6), dtype=bool)
_TURNS[1, [2, 3, 4]] = _TURNS[2, [1, 3, 4]] = _TURNS[3, [1, 2]] = _TURNS[4, 2] = True
_TURNS = _TURNS.ravel()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._library = Tokenizer.from_file(path)
        self._break, = self._library.encode("\n", add_special_tokens=False).ids
        self._kind = _KIND.copy()  # tokens that the library takes from a text before all others are not cut
        for token in self._library.get_added_tokens_decoder().values():
            inside = np.unique(np.frombuffer(token.content.encode(), np.uint8))
            self._kind[inside[_KIND[inside] != 1]] = 0
        self._forget()

    def _forget(self):
        self._keys = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int32)
        self._len = np.zeros(0, np.int32)
        self._ids = np.zeros(0, np.int32)

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode and remember the pieces ``data[start:end]``; their keys ascend and are new."""
        odd = np.concatenate([[0], np.cumsum(~_PLAIN[data])])
        lead = data[starts] == 32
        plain = (odd[ends] == odd[starts + lead]) & (ends - starts > lead)
        order = np.argsort(~plain, kind="stable")  # a piece with white space inside is encoded alone
        n_plain = int(plain.sum())
        first, size = starts[order[:n_plain]], (ends - starts)[order[:n_plain]] + 1
        of = np.concatenate([[0], np.cumsum(size)])
        joined = data[np.minimum(np.repeat(first - of[:-1], size) + np.arange(of[-1]), len(data) - 1)]
        joined[of[1:] - 1] = 10
        lines = [joined[of[i]:of[min(i + JOINED, n_plain)] - 1].tobytes() for i in range(0, n_plain, JOINED)]
        lines += [data[starts[i]:ends[i]].tobytes() for i in order[n_plain:]]
        found = [np.array(e.ids, np.int32) for e in self._library.encode_batch_fast([t.decode("utf-8") for t in lines], add_special_tokens=False)]
        n_lines = len(lines) - len(keys) + n_plain
        flat = np.concatenate([x for ids in found[:n_lines] for x in (ids, [self._break])] or [np.zeros(0, np.int32)])
        is_id = flat != self._break
        done = np.concatenate([[0], np.cumsum(is_id)[~is_id]])
        lengths = np.concatenate([np.diff(done), [len(x) for x in found[n_lines:]]]).astype(np.int32)
        at = (len(self._ids) + np.concatenate([[0], np.cumsum(lengths)[:-1]])).astype(np.int32)
        self._ids = np.concatenate([self._ids, flat[is_id], *found[n_lines:]]).astype(np.int32)
        back, place = np.argsort(order), np.searchsorted(self._keys, keys)
        self._keys = np.insert(self._keys, place, keys)
        self._at = np.insert(self._at, place, at[back])
        self._len = np.insert(self._len, place, lengths[back])

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.zeros(len(data) + 1, dtype=bool)
        if len(data) > 2:
            cut[1:-2] = (data[1:-1] == 32) & (data[:-2] > 32) & _STARTS[data[2:]]
            kind = self._kind[data]
            # U+00C0 to U+00FF are letters, but for the signs of multiplication and division
            kind[1:][(data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)] = 1
            cut[1:-1] |= _TURNS[kind[:-1] * 6 + kind[1:]]
            line = np.flatnonzero((kind[1:-1] == 5) & (kind[:-2] % 5 > 0) & _STARTS[data[2:]]) + 1
            cut[line] = cut[line + 1] = True
        cut[offsets] = True
        bounds = np.flatnonzero(cut)
        starts, ends = bounds[:-1], bounds[1:]
        keys, first, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._keys) > REMEMBERED:
            self._forget()
        place = np.minimum(np.searchsorted(self._keys, keys), max(len(self._keys) - 1, 0))
        new = np.flatnonzero(self._keys[place] != keys) if len(self._keys) else np.arange(len(keys))
        if len(new):
            self._learn(keys[new], data, starts[first[new]], ends[first[new]])
        place = np.searchsorted(self._keys, keys)[which]
        lengths = self._len[place].astype(np.int64)
        done = np.concatenate([[0], np.cumsum(lengths)])
        ids = self._ids[np.repeat(self._at[place] - done[:-1], lengths) + np.arange(done[-1])]
        return ids, done[np.searchsorted(starts, offsets)]

    def column(self, column: pa.Array):
        """Yields (first row, last row, ids, offsets) for runs of rows; the ids
        of row ``first + i`` are ``ids[offsets[i]:offsets[i + 1]]``. Null is empty."""
        data, offsets = column_bytes(column)
        for i, j in batches_of(column):
            own = offsets[i:j + 1] - offsets[i]
            ids, of = self._encode(data[offsets[i]:offsets[j]], own) if own[-1] else (np.zeros(0, np.int32), np.zeros(j - i + 1, np.int64))
            yield i, j, ids, of


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)
