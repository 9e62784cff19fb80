"""Near-duplicate embeddings by an epsilon grid order join (operator 8).

Vectors are scaled to length 1, where cosine >= t means a Euclidean distance of
at most eps = sqrt(2 - 2 t), and turned onto the principal axes of the whole
table. Within a label they are sorted by the cells, eps wide, of the leading
axes, and the sequence is cut into blocks. Intervals of the sequence are joined
recursively (``trees.block_pairs``): two intervals whose boxes lie more than
eps apart cannot hold a link and are skipped. Pairs of blocks that remain are
compared with the exact cosine of the original vectors. A block pair returns
counts and a spanning set of its links, never all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.graph import components
from sentinela.llm.trees import block_pairs, cut, pair_rows, runs
from sentinela.llm.vectors import comparable, matrix
from sentinela.sinks.writers import checkpoint_parquet

SIMILARITY = 0.98
#: Leading axes that are sorted by, axes with a box, vectors of a block.
SORT_AXES, BOX_AXES, BLOCK_ROWS = 6, 12, 256


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length d, the d x d axes by falling variance of the unit
    vectors; every task adds up a matrix of moments of its rows."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column(0)
            sizes = np.diff(column.offsets.to_numpy())
            for d in np.unique(sizes):
                x = matrix(column.filter(pa.array(sizes == d)))
                x = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.ones((len(x), 1))])
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, d, np.int32)), pa.array(np.arange(s.size, dtype=np.int32)), pa.array(s.ravel())],
                                             names=["dim", "at", "value"])

    rows = (vectors.select("embedding").mapInArrow(moments, "dim int, at int, value double")
            .groupBy("dim", "at").agg(F.sum("value").alias("value")).collect())  # (d + 1)^2 sums for each length d
    found: dict[int, np.ndarray] = {}
    for d in {r["dim"] for r in rows}:
        s = np.zeros((d + 1) * (d + 1))
        for r in rows:
            if r["dim"] == d:
                s[r["at"]] = r["value"]
        s = s.reshape(d + 1, d + 1)
        mean = s[d, :d] / s[d, d]
        _, axes = np.linalg.eigh(s[:d, :d] / s[d, d] - np.outer(mean, mean))
        found[d] = np.ascontiguousarray(axes[:, ::-1])
    return found


def _project(axes: dict[int, np.ndarray], eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("embedding"))
            sizes = np.diff(column.offsets.to_numpy())
            leading = np.zeros((len(column), BOX_AXES))
            for d in np.unique(sizes):
                x = matrix(column.filter(pa.array(sizes == d)))
                y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes[int(d)]
                leading[sizes == d, :min(int(d), BOX_AXES)] = y[:, :BOX_AXES]
            cells = np.floor(leading[:, :SORT_AXES] / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in cells.T), *(pa.array(p) for p in leading.T)],
                                             names=[*batch.schema.names, *(f"c{i}" for i in range(SORT_AXES)), *(f"p{i}" for i in range(BOX_AXES))])

    return run


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row of a symmetric boolean matrix."""
    root = np.arange(len(linked))
    while True:
        low = np.where(linked, root[None, :], len(root)).min(axis=1)
        new = np.minimum(root, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _compare(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches):
            side, ids = rows["side"].to_numpy(), rows["rid"].to_numpy()
            x = matrix(rows["embedding"])
            norm = np.sqrt((x * x).sum(axis=1))
            linked = (x @ x.T) / (norm[:, None] * norm[None, :]) >= similarity
            np.fill_diagonal(linked, False)
            root = _roots(linked)
            if side.any():  # two blocks: links inside either are counted elsewhere
                linked &= side[:, None] != side[None, :]
            n = linked.sum(axis=1)
            some = np.flatnonzero((n > 0) | (root != np.arange(len(root))))
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[root[some]]), pa.array(n[some].astype(np.int64))],
                                                 names=["rid", "root", "n"])

    return run


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id,
    n_links, component_id, kept.

    Only vectors of one label and one length are compared. Vectors that are
    null, zero or hold null or non-finite components, and rows with a null
    label or id, link with nothing (n_links 0, component their own id, kept).
    Rows that repeat an id are vectors of their own. Other columns are ignored;
    an empty table gives no rows.
    """
    eps = float(np.sqrt(max(0.0, 2 - 2 * similarity))) + 1e-9
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & comparable("embedding")
    rows = checkpoint_parquet(vectors.select(F.monotonically_increasing_id().alias("rid"), "vec_id",
                                             F.when(usable, F.xxhash64("label", F.size("embedding"))).alias("bucket"), "embedding"), "ego-rows")
    some = rows.where(F.col("bucket").isNotNull()).select("bucket", "rid", "embedding")
    axes = principal_axes(some)
    schema = ("bucket bigint, rid bigint, embedding array<float>, " if dict(vectors.dtypes)["embedding"] == "array<float>" else "bucket bigint, rid bigint, embedding array<double>, ")
    schema += ", ".join([f"c{i} int" for i in range(SORT_AXES)] + [f"p{i} double" for i in range(BOX_AXES)])
    order = [f"c{i}" for i in range(SORT_AXES)] + ["rid"]
    blocked = checkpoint_parquet(cut(some.mapInArrow(_project(axes, eps), schema), order, BLOCK_ROWS), "ego-blocks")
    boxes = [(f"lo{i}", f"hi{i}", f"p{i}") for i in range(BOX_AXES)]
    summary = blocked.groupBy("bucket", "block").agg(*[f(p).alias(c) for lo, hi, p in boxes for c, f in ((lo, F.min), (hi, F.max))])

    def near(a: str, b: str):
        gaps = [F.greatest(F.col(f"{a}.{lo}") - F.col(f"{b}.{hi}"), F.col(f"{b}.{lo}") - F.col(f"{a}.{hi}"), F.lit(0.0)) for lo, hi, _ in boxes]
        return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= (eps + 1e-6) ** 2

    merged = {c: f for lo, hi, _ in boxes for c, f in ((lo, F.min), (hi, F.max))}
    pairs = block_pairs(summary, merged, near, "ego-intervals")
    found = checkpoint_parquet(pair_rows(pairs.drop("bucket"), blocked.select("block", "rid", "embedding"))
                               .select("key", "side", "rid", "embedding").mapInArrow(_compare(similarity), "rid bigint, root bigint, n bigint"), "ego-links")
    member = components(found.select("rid", "root"), "ego-components")
    ids = rows.select("rid", "vec_id")
    named = ids.join(member, ids["rid"] == member["node"], "left").select(
        "rid", "vec_id", F.coalesce("component", "rid").alias("component"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    links = found.groupBy("rid").agg(F.sum("n").alias("n_links"))
    return (named.join(least, "component").join(links, "rid", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
                    F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")))
