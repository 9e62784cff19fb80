"""Packing by Karmarkar-Karp multiway differencing (operator 4).

A document's tokens fill whole sequences first; what remains is cut into short
pieces. Each task streams its part of the input: whenever a group of documents
has been read, their pieces are divided over k windows by multiway differencing
(the two partial partitions with the largest imbalance are merged, the heaviest
window of one with the lightest of the other). k starts at the smallest count
that could hold the tokens and rises while a window exceeds the capacity. No
row is shuffled, and a task holds one group.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm import tokens

CAPACITY, END_ID = 2048, 1
#: Longest piece of what remains of a document, and documents in a group.
PIECE, GROUP = 512, 256

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def differencing(sizes: np.ndarray, k: int) -> list[list[int]]:
    """The items of ``sizes`` divided over k windows of near equal sums."""
    leaf = len(sizes)
    left, right = [], []  # children of the merged nodes leaf, leaf + 1, ...
    heap = []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], nodes[0] = size, i
        heap.append((-int(size), i, sums, nodes))  # sums descend
    heapq.heapify(heap)
    tie = leaf
    while len(heap) > 1:
        _, _, a_sums, a_nodes = heapq.heappop(heap)
        _, _, b_sums, b_nodes = heapq.heappop(heap)
        sums, b_nodes = a_sums + b_sums[::-1], b_nodes[::-1]
        both = np.flatnonzero((a_nodes >= 0) & (b_nodes >= 0))
        nodes = np.maximum(a_nodes, b_nodes)
        if len(both):
            nodes[both] = leaf + len(left) + np.arange(len(both))
            left.extend(a_nodes[both].tolist())
            right.extend(b_nodes[both].tolist())
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), tie, sums, nodes))
        tie += 1
    windows = []
    for node in heap[0][3].tolist() if heap else []:
        window, todo = [], [node] if node >= 0 else []
        while todo:
            x = todo.pop()
            if x < leaf:
                window.append(x)
            else:
                todo += [left[x - leaf], right[x - leaf]]
        if window:
            windows.append(sorted(window))
    return windows


def windows(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity`` each, as few as differencing can fill."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = differencing(sizes, k)
        if all(int(sizes[w].sum()) <= capacity for w in found):
            return found
        k += max(1, k // 256)


def _pieces(n: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    """(start, length): whole sequences, then near equal parts of at most ``piece``."""
    whole = n // capacity * capacity
    yield from ((s, capacity) for s in range(0, whole, capacity))
    if rest := n - whole:
        parts = -(-rest // piece)
        cuts = [whole + rest * i // parts for i in range(parts + 1)]
        yield from ((a, b - a) for a, b in zip(cuts, cuts[1:]))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, piece: int = PIECE,
         group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece (SCHEMA; with ``ids`` array<int> if asked for).

    Every input row is a document of its own, repeated ids included; null and
    empty texts have the end id only; a null id stays null. Extra columns are
    ignored; an empty table gives no rows. A sequence holds at most
    ``capacity`` ids; its offsets run from 0 without gaps.
    """
    path = tokenizer or tokens.default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        part = TaskContext.get().partitionId()
        out: dict[str, list] = {}
        made = 0

        def emit(doc, n, start, ids, sequence, offset):
            for key, value in (("doc_id", doc), ("start", start), ("length", len(ids)), ("ids_crc32", zlib.crc32(ids.astype("<u4").tobytes())),
                               ("doc_tokens", n), ("sequence_id", (part << 36) + sequence), ("offset", offset)):
                out.setdefault(key, []).append(value)
            if with_ids:
                out.setdefault("ids", []).append(ids)

        def flush():
            types = {"ids": pa.list_(pa.int32())}
            batch = pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in out.items()], names=list(out))
            out.clear()
            return batch

        def settle(small):
            nonlocal made
            for window in windows(np.array([len(x[3]) for x in small], np.int64), capacity):
                offset = 0
                for i in window:
                    emit(*small[i], made, offset)
                    offset += len(small[i][3])
                made += 1

        small, held = [], 0
        for batch in batches:
            for i, j, ids, of in encode.column(batch.column(1)):
                for doc, a, b in zip(batch.column(0)[i:j].to_pylist(), of[:-1], of[1:]):
                    own = np.append(ids[a:b], np.int32(end_id))
                    for start, length in _pieces(len(own), capacity, piece):
                        x = own[start:start + length]
                        if length == capacity:
                            emit(doc, len(own), start, x, made, 0)
                            made += 1
                        else:
                            small.append((doc, len(own), start, x))
                    held += 1
                    if held == group:
                        settle(small)
                        small, held = [], 0
                        if len(out.get("start", ())) > 2000:
                            yield flush()
                if len(out.get("start", ())) > 2000:
                    yield flush()
        if small:
            settle(small)
        if out:
            yield flush()

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
