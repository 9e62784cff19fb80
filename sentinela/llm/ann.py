"""Approximate nearest neighbours by robust-pruned directed graphs (operator 7).

Vectors are dealt by their hash over shards of bounded size, equal ones to the
same shard with as many of their smallest ids as a result can hold. In each
shard equal vectors are one node, as edges between them would be pruned, and a
node that is found stands for all its ids. A graph is grown in batches: a greedy search from the central vector proposes
neighbours for a new vector; pruning with a relaxed distance keeps a candidate
only if no kept one is nearer to it by the factor ALPHA, so that edges point in
different directions; edges are made in both ways and pruned again. Queries, in
blocks, run a beam search over every shard; the nearest of all shards are
merged. Distances of results are exact, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.llm.trees import runs
from sentinela.llm.vectors import comparable, matrix
from sentinela.sinks.writers import checkpoint_parquet

#: Vectors of a shard, queries of a block.
SHARD_ROWS, QUERY_ROWS = 8192, 512
#: Edges of a vector, beam while building and while searching, relaxation.
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 400, 1.2
#: Vectors inserted at once, nodes expanded in one step of a search.
INSERT, EXPAND = 256, 4


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, squared distances) of the ``beam`` nearest found for each query,
    nearest first; -1 and inf where fewer were reached."""
    n, q = len(x), len(queries)
    seen = np.zeros((q, n), dtype=bool)
    seen[:, start] = True
    ids = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    done = np.ones((q, beam), dtype=bool)
    ids[:, 0], dist[:, 0], done[:, 0] = start, ((queries - x[start]) ** 2).sum(axis=1), False
    live = np.arange(q)
    while len(live):
        open_ = np.where(done[live], np.inf, dist[live])
        pick = np.argpartition(open_, EXPAND - 1, axis=1)[:, :EXPAND]
        rows = live[:, None]
        usable = np.isfinite(np.take_along_axis(open_, pick, axis=1))
        done[rows, pick] = True
        near = graph[np.where(usable, ids[rows, pick], 0)]
        near = np.where(usable[:, :, None], near, -1).reshape(len(live), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        near = np.where(fresh, near, 0)
        fresh &= ~seen[rows, near]
        at, col = np.nonzero(fresh)
        seen[live[at], near[at, col]] = True
        d = np.full(near.shape, np.inf, np.float32)
        gap = x[near[at, col]] - queries[live[at]]
        d[at, col] = np.einsum("ij,ij->i", gap, gap)
        all_d = np.concatenate([dist[live], d], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[live] = np.take_along_axis(all_d, order, axis=1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1), order, axis=1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], axis=1), order, axis=1)
        live = live[(~done[live]).any(axis=1)]
    return ids, dist


def robust_prune(x: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """The edges (-1 where fewer than ``degree``) kept for the vectors ``own``
    from their candidate rows (-1: none): the nearest first, then each whose
    distance to every kept one times ALPHA exceeds its own distance."""
    candidates = np.where(candidates == own[:, None], -1, candidates)
    candidates = np.sort(candidates, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    points = x[np.maximum(candidates, 0)]
    d = ((points - x[own][:, None, :]) ** 2).sum(axis=2)
    d[candidates < 0] = np.inf
    out = np.full((len(own), degree), -1, np.int64)
    rows = np.arange(len(own))
    for k in range(degree):
        best = d.argmin(axis=1)
        ok = np.isfinite(d[rows, best])
        if not ok.any():
            break
        out[ok, k] = candidates[rows, best][ok]
        to_best = ((points - points[rows, best][:, None, :]) ** 2).sum(axis=2)
        d[(ALPHA * ALPHA * to_best <= d) & ok[:, None]] = np.inf
        d[rows, best] = np.inf
    return out


def distinct_nodes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, offsets): the rows of ``x`` sorted so that rows equal in single
    precision, in which graphs are built and searched, are one after the other,
    and where those of each node begin."""
    _, node, counts = np.unique(x.astype(np.float32) + np.float32(0), axis=0, return_inverse=True, return_counts=True)
    return np.argsort(node.ravel(), kind="stable"), np.concatenate([[0], np.cumsum(counts)])


def build(x: np.ndarray) -> tuple[np.ndarray, int]:
    """(edges, start) of the rows of ``x``, no two of them equal; every row is inserted."""
    x = x.astype(np.float32)
    n = len(x)
    start = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    graph = np.full((n, DEGREE), -1, np.int64)
    order = np.random.default_rng(17).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    i = 1
    while i < n:
        new = order[i:i + min(max(i, 1), INSERT)]
        found, _ = beam_search(x, graph, start, x[new], BUILD_BEAM)
        # vectors of one batch see each other too
        gap = ((x[new][:, None, :] - x[new][None, :, :]) ** 2).sum(axis=2)
        mates = new[np.argsort(gap, axis=1)[:, :min(8, len(new))]]
        graph[new] = robust_prune(x, new, np.concatenate([found, mates], axis=1), DEGREE)
        src, dst = np.repeat(new, DEGREE), graph[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        sort = np.argsort(dst, kind="stable")
        targets, at, counts = np.unique(dst[sort], return_index=True, return_counts=True)
        back = np.full((len(targets), counts.max()), -1, np.int64)
        back[np.repeat(np.arange(len(targets)), counts), np.arange(len(dst)) - np.repeat(at, counts)] = src[sort]
        graph[targets] = robust_prune(x, targets, np.concatenate([graph[targets], back], axis=1), DEGREE)
        i += len(new)
    return graph, start


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, rows in runs(batches, "shard"):
        x, ids = matrix(rows["embedding"]), rows["vec_id"].to_numpy()
        order, of = distinct_nodes(x)
        x, ids = x[order], ids[order]
        graph, start = build(x[of[:-1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.array([x.shape[1]], pa.int32()), pa.array([start]), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
             pa.array([x.astype("<f8").tobytes()], pa.binary()), pa.array([of.astype("<i4").tobytes()], pa.binary()),
             pa.array([graph.astype("<i4").tobytes()], pa.binary())],
            names=["shard", "dim", "start", "ids", "vectors", "offsets", "edges"])


def least_ids(vectors: DataFrame, copies: int) -> DataFrame:
    """``vectors`` with the ``copies`` smallest ids of each group of equal ones;
    Spark cuts a large group down before it is shuffled."""
    key = F.xxhash64("embedding").alias("_hash")
    rank = F.row_number().over(Window.partitionBy("_hash", "embedding").orderBy("vec_id"))
    return vectors.select("vec_id", "embedding", key).withColumn("_rank", rank).where(F.col("_rank") <= copies).select("vec_id", "embedding")


def index(vectors: DataFrame, copies: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard of (vec_id, embedding) rows that are ``comparable``:
    its ids, vectors, edges and where the rows of each node begin, written to
    the shared folder. Vectors of different lengths are in different shards; of
    equal vectors the ``copies`` smallest ids take part."""
    vectors = checkpoint_parquet(least_ids(vectors, copies), "graph-vectors")
    counts = vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).select(
        "dim", F.ceil(F.col("n") / F.lit(shard_rows)).alias("shards"))
    dealt = vectors.withColumn("dim", F.size("embedding")).join(F.broadcast(counts), "dim")  # a row per vector length
    part = F.pmod(F.xxhash64(F.transform("embedding", lambda v: v.cast("float") + F.lit(0).cast("float"))), F.col("shards"))
    dealt = dealt.withColumn("shard", F.col("dim").cast("bigint") * F.lit(1 << 40) + part)
    return checkpoint_parquet(
        dealt.select("shard", "vec_id", "embedding").repartition("shard").sortWithinPartitions("shard", "vec_id", "embedding")
        .mapInArrow(_build_shards, "shard bigint, dim int, start bigint, ids binary, vectors binary, offsets binary, edges binary"), "graph-index")


def _search(k: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                x = np.frombuffer(row["vectors"], "<f8").reshape(len(ids), row["dim"])
                of = np.frombuffer(row["offsets"], "<i4").astype(np.int64)
                nodes = len(of) - 1
                graph = np.frombuffer(row["edges"], "<i4").reshape(nodes, -1)
                queries = np.array([q["embedding"] for q in row["queries"]], np.float64)
                query_ids = np.array([q["vec_id"] for q in row["queries"]], np.int64)
                found, _ = beam_search(x[of[:-1]].astype(np.float32), graph, row["start"], queries.astype(np.float32), min(beam, max(nodes, EXPAND)))
                out: tuple[list, list, list] = ([], [], [])
                for own, q, hits in zip(query_ids, queries, found):
                    hits = hits[hits >= 0]
                    n = of[hits + 1] - of[hits]
                    hits = np.repeat(of[hits + 1] - np.cumsum(n), n) + np.arange(n.sum())  # the rows of the nodes
                    hits = hits[ids[hits] != own]
                    d = np.sqrt(((x[hits] - q) ** 2).sum(axis=1))
                    best = np.lexsort((ids[hits], d))[:k]
                    out[0].append(np.full(len(best), own))
                    out[1].append(ids[hits][best])
                    out[2].append(d[best])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query by
    Euclidean distance, ties to the smaller id; all candidates if fewer.

    Both tables have vec_id and embedding. Null, zero and non-finite vectors
    and null ids take no part; a row repeated as a whole counts once; rows that
    share the query's id are its own; only vectors of the query's length are
    candidates. Empty tables give no rows; other columns are ignored.
    """
    usable = lambda df: df.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & comparable("embedding")).distinct()
    shards = index(usable(vectors), k + 1, shard_rows)  # one id may be the query's own
    asked = checkpoint_parquet(usable(queries).withColumn("dim", F.size("embedding")), "graph-queries")
    blocks = asked.count() // QUERY_ROWS + 1
    asked = (asked.groupBy("dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("query_block"))
             .agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries")))  # about QUERY_ROWS each
    work = asked.join(shards, "dim").repartition("shard", "query_block")  # the stated queries, in blocks, against every shard
    found = work.select("dim", "start", "ids", "vectors", "offsets", "edges", "queries").mapInArrow(_search(k, beam), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
