"""K-Means (CLU2, CLU3): many restarts in one pass, and Lloyd steps with bounds.

``kmeans_many`` advances all restarts of all k together: one job a step, in which
only restarts that still move take part. Every restart begins from a seeding on
a bounded sample of rows, moved to rest on that sample inside a task.

``lloyd_bounded`` starts from the farthest-first centres and keeps, in a written
table sorted by it, each row's margin: its distance to the second nearest centre
less that to the nearest. A row keeps its centre until the centres have moved by
its margin, so a step reads only the rows of smaller margins; their changes
are added to the sums of the table.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.sinks.writers import checkpoint_parquet

SAMPLE_PER_CENTER = 20
#: Share of the rows to be read in a step beyond which the margins are taken anew.
REFRESH = 0.5


def as_array(df: DataFrame, features: str):
    """A vector or array column as array<double>."""
    return (F.col(features) if dict(df.dtypes)[features].startswith("array") else vector_to_array(F.col(features))).cast("array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _squares(X: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances by one matrix product."""
    return np.maximum((X * X).sum(axis=1)[:, None] - 2 * (X @ centers.T) + (centers * centers).sum(axis=1), 0)


def _starts(ks: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(ks)]).astype(int)


def _nearest(squares: np.ndarray, ks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For restarts of ``ks`` centres that lie side by side: each row's centre
    (its column) and squared distance, one column a restart."""
    at = _starts(ks)
    own, best = np.empty((len(squares), len(ks)), np.int64), np.empty((len(squares), len(ks)))
    for r, (a, b) in enumerate(zip(at, at[1:])):
        own[:, r] = squares[:, a:b].argmin(axis=1) + a
        best[:, r] = squares[np.arange(len(squares)), own[:, r]]
    return own, best


def _sums(X: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each of ``n`` centres."""
    out = np.zeros((n, X.shape[1]))
    for column in own.T:
        order = np.argsort(column, kind="stable")
        keys, first = np.unique(column[order], return_index=True)
        out[keys] += np.add.reduceat(X[order], first, axis=0)
    return out


def _seeded(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ seeding, then Lloyd's steps on the same points until they rest."""
    centers = [points[rng.integers(len(points))]]
    d2 = ((points - centers[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = d2.sum()
        i = rng.integers(len(points)) if total <= 0 else rng.choice(len(points), p=d2 / total)
        centers.append(points[i])
        d2 = np.minimum(d2, ((points - points[i]) ** 2).sum(1))
    centers = np.array(centers)
    for _ in range(100):
        own, _ = _nearest(_squares(points, centers), [k])
        n = np.bincount(own[:, 0], minlength=k)
        new = np.where(n[:, None] > 0, _sums(points, own, k) / np.maximum(n, 1)[:, None], centers)
        if ((new - centers) ** 2).sum(1).max() <= 1e-6:
            return new
        centers = new
    return centers


def _step(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: count, cost and sum of every centre of the restarts in ``shared``."""
    centers, ks = shared.value
    n, cost, sums = np.zeros(len(centers), np.int64), np.zeros(len(ks)), np.zeros_like(centers)
    for batch in batches:
        X = _matrix(batch.column(0))
        if len(X):
            own, best = _nearest(_squares(X, centers), ks)
            n += np.bincount(own.ravel(), minlength=len(centers))
            cost += best.sum(axis=0)
            sums += _sums(X, own, len(centers))
    of_first = np.zeros(len(centers))
    of_first[_starts(ks)[:-1]] = cost  # a restart's cost goes with its first centre
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centers))), pa.array(n), pa.array(of_first), pa.array(list(sums))], names=["slot", "n", "cost", "s"])


class Fit(NamedTuple):
    k: int
    centers: np.ndarray
    cost: float


def kmeans_many(df: DataFrame, ks: list[int], features: str = "features", n_init: int = 30, max_iter: int = 300, tol: float = 1e-4, seed: int = 42) -> list[Fit]:
    """The best of ``n_init`` restarts for every k, by cost.

    Seeding: the rows of the lowest seeded hashes (SAMPLE_PER_CENTER for each
    centre of all restarts of the largest k, a bound that does not grow with the
    data) are sent to tasks that seed the restarts. A restart rests when no centre moves by more
    than ``tol`` (squared). At most max_iter jobs read the data, whatever n_init."""
    spark = df.sparkSession
    data = checkpoint_parquet(df.select(as_array(df, features).alias("_v")), "kmeans-rows")
    sample = np.array([r["_v"] for r in data.orderBy(F.xxhash64(F.lit(seed), "_v"), "_v").limit(SAMPLE_PER_CENTER * max(ks) * n_init).collect()], dtype=float)
    of = [k for k in ks for _ in range(n_init)]
    points = spark.sparkContext.broadcast(sample)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([r]), pa.array([_seeded(points.value, of[r], np.random.default_rng([seed, r])).ravel()])], names=["r", "c"])

    rows = spark.range(0, len(of), numPartitions=len(of)).mapInArrow(seeds, "r bigint, c array<double>").collect()
    centers = [np.array(r["c"]).reshape(of[r["r"]], -1) for r in sorted(rows, key=lambda r: r["r"])]
    points.unpersist()
    cost, active, dim = np.full(len(of), np.inf), list(range(len(of))), sample.shape[1]
    for _ in range(max_iter):
        shared = spark.sparkContext.broadcast((np.concatenate([centers[r] for r in active]), [of[r] for r in active]))
        parts = data.mapInArrow(functools.partial(_step, shared), "slot bigint, n bigint, cost double, s array<double>")
        found = parts.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("s")[i]) for i in range(dim)]).alias("s")).toArrow().sort_by("slot")
        shared.unpersist()
        n, sums, at = found["n"].to_numpy(), _matrix(found["s"].combine_chunks()), _starts([of[r] for r in active])
        cost[active] = found["cost"].to_numpy()[at[:-1]]
        moving = []
        for r, a, b in zip(active, at, at[1:]):
            new = np.where(n[a:b, None] > 0, sums[a:b] / np.maximum(n[a:b], 1)[:, None], centers[r])
            if ((new - centers[r]) ** 2).sum(axis=1).max() > tol:
                moving.append(r)
            centers[r] = new
        active = moving
        if not active:
            break
    best = [min(range(i * n_init, (i + 1) * n_init), key=lambda r: (cost[r], r)) for i in range(len(ks))]
    return [Fit(k, centers[r], float(cost[r])) for k, r in zip(ks, best)]


def assigned(df: DataFrame, centers: np.ndarray, features: str = "features", out: str = "cluster") -> DataFrame:
    """``df`` with the number of each row's nearest centre, ties to the lowest."""
    shared = df.sparkSession.sparkContext.broadcast(centers)

    def nearest(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            X = _matrix(column)
            yield pa.array(_squares(X, shared.value).argmin(axis=1) if len(X) else [], pa.int32())

    return df.withColumn(out, F.arrow_udf(nearest, "int")(as_array(df, features)))


# ------------------------------------------------------------- bounded Lloyd

_STATE = "id bigint, v array<double>, label int, margin double"
_PARTS = "label int, n bigint, s array<double>"


def _distances(X: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([((X - c) ** 2).sum(axis=1) for c in centers], axis=1))


def farthest_first(points: DataFrame, k: int) -> np.ndarray:
    """Centres of ``points`` (id, v): the row of the smallest id, then the row
    farthest from all so far, ties to the smallest id. One aggregate each."""
    centers = [points.agg(F.min_by("v", "id")).first()[0]]
    for _ in range(1, k):
        shared = np.array(centers)

        def far(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = None
            for batch in batches:
                X, ids = _matrix(batch.column(1)), batch.column(0).to_numpy()
                if len(X):
                    d = _distances(X, shared).min(axis=1)
                    i = np.lexsort([ids, -d])[0]
                    best = max(filter(None, [best, (float(d[i]), -int(ids[i]), X[i])]), key=lambda b: b[:2])
            if best:
                yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]]), pa.array([best[2]])], names=["d", "m", "v"])

        # one row a task
        centers.append(points.mapInArrow(far, "d double, m bigint, v array<double>").agg(F.max(F.struct("d", "m", "v")).alias("far")).first()["far"]["v"])
    return np.array(centers)


def _with_margins(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """A new state: every row's centre and margin, written in order of margins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            X = _matrix(batch.column(1))
            if len(X):
                d = _distances(X, centers)
                label = d.argmin(axis=1).astype(np.int32)
                own = d[np.arange(len(d)), label]
                d[np.arange(len(d)), label] = np.inf
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(label), pa.array(d.min(axis=1) - own)], names=["id", "v", "label", "margin"])

    return checkpoint_parquet(points.select("id", "v").mapInArrow(run, _STATE).sortWithinPartitions("margin"), "kmeans-margins")


def _changes(rows: DataFrame, centers: np.ndarray) -> list:
    """What the rows (id, v, label) that have another nearest centre now add to and take from the sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(len(centers), np.int64), np.zeros_like(centers)
        for batch in batches:
            X, old = _matrix(batch.column(1)), batch.column(2).to_numpy()
            if len(X):
                new = _distances(X, centers).argmin(axis=1)
                moved = new != old
                for label, sign in ((new, 1), (old, -1)):
                    n += sign * np.bincount(label[moved], minlength=len(centers))
                    np.add.at(s, label[moved], sign * X[moved])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centers), dtype=np.int32)), pa.array(n), pa.array(list(s))], names=["label", "n", "s"])

    return _summed(rows.select("id", "v", "label").mapInArrow(run, _PARTS), centers.shape[1])


def _summed(parts: DataFrame, dim: int) -> list:
    return parts.groupBy("label").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(dim)]).alias("s")).collect()  # k rows


def lloyd_bounded(df: DataFrame, k: int, features: str = "features", id_col: str = "id", steps: int = 10, refresh: float = REFRESH):
    """(centres, rows, reads) after ``steps`` Lloyd steps, or fewer once nothing
    moves, from the farthest-first start; ``rows`` is (id, cluster, distance), ``reads`` the number of
    rows that each step had to look at. A cluster without rows keeps its centre,
    equal distances go to the first centre. Rows without an id or a vector take no part."""
    points = df.select(F.col(id_col).cast("bigint").alias("id"), as_array(df, features).alias("v")).where("id IS NOT NULL AND size(v) > 0")
    points = checkpoint_parquet(points, "kmeans-points")
    total = points.count()
    if not total:
        return np.zeros((0, 0)), points.select("id", F.lit(0).alias("cluster"), F.lit(0.0).alias("distance")), []
    centers = farthest_first(points, k)
    reference, state, reads = centers, _with_margins(points, centers), [total]
    dim = centers.shape[1]
    n0, s0 = np.zeros(k, np.int64), np.zeros_like(centers)
    for row in state.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("v")[i]) for i in range(dim)]).alias("s")).collect():  # k rows
        n0[row["label"]], s0[row["label"]] = row["n"], row["s"]
    n, s = n0, s0
    for step in range(steps):
        new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], centers)
        still = np.array_equal(new, centers)
        centers = new
        if still or step == steps - 1:
            break
        moved = 2 * np.sqrt(((centers - reference) ** 2).sum(axis=1)).max() * (1 + 1e-9)
        open_rows = state.where(F.col("margin") <= float(moved))  # pushed into the scan
        reads.append(open_rows.count())
        n, s = n0.copy(), s0.copy()
        for row in _changes(open_rows, centers):
            n[row["label"]] += row["n"]
            s[row["label"]] += np.array(row["s"])
        if reads[-1] > refresh * total:
            reference, state, n0, s0 = centers, _with_margins(points, centers), n, s

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            X = _matrix(batch.column(1))
            if len(X):
                d = _distances(X, centers)
                own = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int32)), pa.array(d[np.arange(len(d)), own])], names=["id", "cluster", "distance"])

    return centers, points.mapInArrow(label, "id bigint, cluster int, distance double"), reads
