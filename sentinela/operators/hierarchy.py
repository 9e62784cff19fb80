"""Ward hierarchy by reciprocal nearest neighbours (CLU6).

The state is a table of clusters (id, weight, centroid); the cost of a merge is
the rise of the within-cluster sum of squares. A merge never comes nearer to a
third cluster than the nearer of its parts was, so any merges of clusters that
are each other's nearest make the hierarchy of one merge at a time.

The clusters are dealt once into blocks of near ones (a tree of median cuts,
fitted on a bounded sample; it decides the speed, not the result). A block is one row, and
keeps for each cluster and each block the nearest there with its cost, or a bound of the cost
where it is not known: first the distance from the block's box, later what the
parts of a merge had, which grows with the merge. In a round only those clusters are searched in a
block whose nearest of all could be there and is not known; clusters grown across blocks are
compared with the others both ways. Blocks are held in groups, so that a block is
copied for each group and not for each block. Each block then merges inside as long as
pairs are cheaper than what its clusters have outside, and proposes the rest
to the blocks of their nearest; those that propose to each other are merged. Neighbouring blocks
are joined as they empty. When two blocks' size holds all clusters, nothing is outside and one task makes
the remaining merges by the same rule. Costs come from matrix products in single
precision (double where it tells too little), of which only the least of each run
of clusters is kept; those that could be the least
within the rounding are computed again in double from differences.
Nothing but counts, the sample and a few numbers a block reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.sinks.writers import checkpoint_parquet

#: Most clusters of a block (one task finishes twice as many), and its most numbers; clusters that the cuts into blocks are fitted on.
BLOCK, _WIDE, SAMPLE = 32768, 1 << 21, 4096
#: Groups of blocks at least; numbers of a group; rounds without a merge before all is searched afresh.
_GROUPS, _HELD, _IDLE = 6, 1 << 22, 3
#: Costs computed exactly in one step; clusters that stand for each other in a comparison; queries of one product.
_STEP, _RUN, _TILE = 1 << 19, 32, 512
#: Nearest ones kept for each cluster while a block merges, in blocks of so many at least.
LISTED, _LONG = 8, 4096
#: Candidates a cluster above which single precision tells too little.
ALIKE = 16

_PACKS = "part int, first bigint, n bigint, ids binary, ws binary, cs binary"
_BLOCKS = "block bigint, ids binary, ws binary, cs binary, low array<double>, high array<double>, least double"
#: The rows of a round: a block; for one block in another what was found, what is nearest of its clusters that grew, a bound of those
#: that were not compared; proposals to a block from clusters with the smaller and the larger id.
_STATE, _FOUND, _GREW, _FLOOR, _SMALLER, _LARGER = range(6)
_SEARCH, _VERIFY = 2, 1
_ROUND = ("kind int, block bigint, n bigint, ids binary, ws binary, cs binary, nears binary, costs binary, needs binary, grew binary, "
          "bnears binary, bcosts binary, wants array<int>, floors array<double>, floor double, left array<bigint>, right array<bigint>, height array<double>, size array<bigint>")
MERGES = "left bigint, right bigint, height double, size bigint"


def merge_cost(wa: np.ndarray, ca: np.ndarray, wb: np.ndarray, cb: np.ndarray) -> np.ndarray:
    """Costs of merging each cluster of a with that of b beside it, the same both ways to the last bit."""
    out, step = np.empty(len(wa)), max(1, _STEP // max(ca.shape[1], 1))
    for i in range(0, len(wa), step):
        at = slice(i, i + step)
        out[at] = (wa[at] * wb[at]) / (wa[at] + wb[at]) * ((ca[at] - cb[at]) ** 2).sum(axis=1)
    return out


class _Best:
    """The least (cost, smaller id, larger id) seen so far of each of ``ids``."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.cost, self.near = ids, np.full(len(ids), np.inf), np.full(len(ids), -1, np.int64)
        self.at = np.full(len(ids), -1, np.int64)

    def take(self, i: np.ndarray, others: np.ndarray, at: np.ndarray, cost: np.ndarray) -> None:
        key = lambda a, b: (np.maximum(a, b), np.minimum(a, b))
        order = np.lexsort((*key(self.ids[i], others), cost, i))
        order = order[np.r_[True, i[order][1:] != i[order][:-1]]] if len(order) else order
        i, others, at, cost = i[order], others[order], at[order], cost[order]
        (high, low), (old_high, old_low) = key(self.ids[i], others), key(self.ids[i], self.near[i])
        better = (cost < self.cost[i]) | ((cost == self.cost[i]) & (self.at[i] >= 0) & ((low < old_low) | ((low == old_low) & (high < old_high))))
        i = i[better]
        self.cost[i], self.near[i], self.at[i] = cost[better], others[better], at[better]


def _products(a: tuple, b: tuple, kind: type) -> tuple:
    """Two matrices whose product has the squares of the distances, and what the
    rounding in ``kind`` can add to the costs of each of a and b."""
    (_, w, c), (_, v, e) = a, b
    mid = e.mean(axis=0)
    x, y = c - mid, e - mid
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    hair = (4 if kind is np.float32 else 16) * (c.shape[1] + 8) * np.finfo(kind).eps  # more than the products' rounding
    slack, slack_b = hair * (xx + yy.max()) * np.minimum(w, v.max()), hair * (yy + xx.max()) * np.minimum(v, w.max())
    left, right = np.column_stack([-2 * x, xx, np.ones(len(x))]), np.column_stack([y, np.ones(len(y)), yy]).T
    return tuple(np.ascontiguousarray(z, kind) for z in (left, right, slack, slack_b, 1 / w, 1 / v))


def _single(a: tuple, b: tuple) -> bool:
    """Whether no cost and no slack of a and b can leave the range of single precision."""
    (_, w, c), (_, v, e) = a, b
    mid = e.mean(axis=0)
    most = [float(np.abs(z - mid).max()) for z in (c, e)]
    return max(most) < 1e12 and min(most) > 1e-12 and max(w.max(), v.max()) < 1e6 and min(w.min(), v.min()) > 1e-3


def _pick(best: _Best, q: tuple, base: tuple, minima: np.ndarray, places: np.ndarray, order: np.ndarray, clusters: tuple, others: tuple, own: np.ndarray | None) -> bool:
    """The best ones of some queries (``places``) into ``best``, from the least products
    with each run of base clusters; False where single precision tells too little."""
    (x, slack, part), (y, part_b) = q, base
    low = np.maximum(minima, 0)
    runs = part_b.reshape(-1, _RUN)
    most = np.nanmax(runs, axis=1)[:, None] + part, np.nanmin(runs, axis=1)[:, None] + part
    least = (low / most[1]).min(axis=0)
    run, at = np.nonzero(~(low / most[0] > least + slack))
    single = x.dtype == np.float32
    if single and len(run) > ALIKE * len(places):
        return False
    y, step = y.reshape(len(runs), _RUN, -1), max(1, (_STEP << 3) // (_RUN * y.shape[1]))
    costs, least = [], np.full(len(places), np.inf, x.dtype)
    for k in range(0, len(run), step):
        r, i = run[k:k + step], at[k:k + step]
        cost = np.matmul(y[r], x[i][:, :, None])[:, :, 0] / (part[i][:, None] + runs[r])
        cost[np.isnan(runs[r])] = np.inf
        if own is not None:
            cost[r[:, None] * _RUN + np.arange(_RUN) == own[i][:, None]] = np.inf
        np.minimum.at(least, i, cost.min(axis=1))
        costs.append(cost)
    pairs = []
    for k, cost in zip(range(0, len(run), step), costs):
        j, r = np.nonzero(~(cost > (least + slack)[at[k:k + step]][:, None]))
        pairs.append((at[k + j], run[k + j] * _RUN + r))
    i, j = (np.concatenate(z) for z in zip(*pairs))
    real = (j < len(order)) if own is None else (j < len(order)) & (own[i] != j)
    i, j = i[real], j[real]
    if single and len(i) > ALIKE * len(places):
        return False
    (_, w, c), (names, v, e) = clusters, others
    for k in range(0, len(i), _STEP):
        r, t = places[i[k:k + _STEP]], order[j[k:k + _STEP]]
        best.take(r, names[t], t, merge_cost(w[r], c[r], v[t], e[t]))
    return True


class _Lists:
    """Some of the nearest of each of ``ids`` with their costs, and a bound of the costs of all others (-1: not known)."""

    def __init__(self, ids: np.ndarray):
        self.at, self.cost, self.reach = np.full((len(ids), LISTED), -1), np.full((len(ids), LISTED), np.inf), np.full(len(ids), -1.0)

    def pick(self, q: tuple, base: tuple, minima: np.ndarray, places: np.ndarray, order: np.ndarray, clusters: tuple, others: tuple, own: np.ndarray) -> bool:
        """From the runs with the least products; as ``_pick``."""
        (x, slack, part), (y, part_b) = q, base
        runs, n, k = part_b.reshape(-1, _RUN), len(places), LISTED
        least = np.ascontiguousarray((np.maximum(minima, 0) / (np.nanmax(runs, axis=1)[:, None] + part)).T)
        first = np.argpartition(least, k, axis=1)[:, :k + 1]
        reach = least[np.arange(n), first[:, k]]
        run, at = first[:, :k].ravel(), np.repeat(np.arange(n), k)
        y, step, costs = y.reshape(len(runs), _RUN, -1), max(1, (_STEP << 3) // (_RUN * y.shape[1])), []
        for i in range(0, len(run), step):
            r, t = run[i:i + step], at[i:i + step]
            costs.append(np.matmul(y[r], x[t][:, :, None])[:, :, 0] / (part[t][:, None] + runs[r]))
        place = run[:, None] * _RUN + np.arange(_RUN)
        cost = np.where(np.isnan(runs[run]) | (place == own[at][:, None]), np.inf, np.concatenate(costs)).reshape(n, -1)
        some = np.argpartition(cost, k, axis=1)[:, :k + 1]
        last = cost[np.arange(n), some[:, k]]
        place = np.take_along_axis(place.reshape(n, -1), some[:, :k], 1)
        real = np.isfinite(np.take_along_axis(cost, some[:, :k], 1))
        (_, w, c), (_, v, e) = clusters, others
        i, j = np.nonzero(real)
        r, t = places[i], order[place[i, j]]
        self.at[r, j], self.cost[r, j] = t, merge_cost(w[r], c[r], v[t], e[t])
        self.reach[places] = (np.minimum(reach, last).astype(float) - slack) * (1 - 1e-9)
        return True


def _scan(a: tuple, b: tuple, rows: _Best | None, columns: _Best | None, own: np.ndarray | None, kind: type) -> bool:
    orders = [np.argsort(z[1], kind="stable") for z in (a, b)]  # runs of near weights
    left, right, slack, slack_b, part, part_b = _products(*(tuple(x[o] for x in z) for z, o in zip((a, b), orders)), kind)
    n, m = len(left), right.shape[1]
    padded = lambda z, fill: np.concatenate([z, np.full((-len(z) % _RUN, *z.shape[1:]), fill, kind)])
    x, y, part, part_b = padded(left, 0), padded(np.ascontiguousarray(right.T), 0), padded(part, np.nan), padded(part_b, np.nan)
    if own is not None:
        place = np.empty(m, np.int64)
        place[orders[1]] = np.arange(m)
        own = place[own[orders[0]]]
    below = None if columns is None else np.empty((len(x) // _RUN, len(y)), kind)
    for i in range(0, n, _TILE):
        some = slice(i, min(i + _TILE, n))
        wide = min(i + _TILE, len(x)) - i
        beside = None if rows is None else np.empty((len(y) // _RUN, wide), kind)
        for j in range(0, len(y), 2 * _TILE):
            cost = y[j:j + 2 * _TILE] @ x[i:i + wide].T
            cost[max(0, m - j):], cost[:, n - i:] = np.inf, np.inf
            if own is not None:
                at = np.flatnonzero((own[some] >= j) & (own[some] < j + len(cost)))
                cost[own[some][at] - j, at] = np.inf
            if rows is not None:
                beside[j // _RUN:(j + len(cost)) // _RUN] = cost.reshape(-1, _RUN, wide).min(axis=1)
            if columns is not None:
                below[i // _RUN:(i + wide) // _RUN, j:j + len(cost)] = cost.reshape(len(cost), -1, _RUN).min(axis=2).T
        if rows is not None:
            q = x[some], slack[some], part[some]
            if not (rows.pick if isinstance(rows, _Lists) else partial(_pick, rows))(q, (y, part_b), beside[:, :q[0].shape[0]], orders[0][some], orders[1], a, b, None if own is None else own[some]):
                return False
    for j in range(0, m if columns is not None else 0, _TILE):
        some = slice(j, min(j + _TILE, m))
        if not _pick(columns, (y[some], slack_b[some], part_b[some]), (x, part), below[:, some], orders[1][some], orders[0], b, a, None):
            return False
    return True


def _compare(a: tuple, b: tuple, rows: _Best | None, columns: _Best | None, own: np.ndarray | None = None) -> None:
    """All clusters (ids, w, c) of a with all of b: the best ones of a into
    ``rows``, of b into ``columns``. ``own``: the place in b of each of a. Of each
    run of clusters with near weights only the least product is kept; runs that could have the
    least cost are looked at again. The products are in single precision unless too many costs come out alike."""
    if not len(a[0]) or not len(b[0]):
        return
    with np.errstate(all="ignore"):
        if not _single(a, b) or not _scan(a, b, rows, columns, own, np.float32):
            _scan(a, b, rows, columns, own, np.float64)


def _grown(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, cost: np.ndarray, scale: float) -> np.ndarray:
    """Bounds of the costs of merged clusters with those outside, from the bounds
    (a row a cluster) of the parts: the cost with a third one of weight 1, the least that there is."""
    total, least = wa + wb, np.minimum(a, b)
    grown = ((wa + 1)[:, None] * a + (wb + 1)[:, None] * b - cost[:, None]) / (total + 1)[:, None]
    return np.maximum(least, grown * (1 - 1e-12) - 8 * np.finfo(float).eps * scale * np.sqrt(np.where(np.isfinite(grown), grown, 0) * total[:, None]))


def agglomerate(ids: np.ndarray, w: np.ndarray, c: np.ndarray, out: np.ndarray, start: tuple | None = None) -> tuple:
    """Merges of a block's clusters (ids ascending) that are each other's nearest
    and cheaper than ``out``, bounds of each cluster's cost with those
    outside (one for all or a row of them); ``start``: place and cost of the nearest in the block, where known.
    Gives the places of the clusters left, their weights and centroids, which of them are new, their bounds, their nearest in the block
    and its cost, and the merges."""
    w, c, out = w.copy(), c.copy(), (out[:, None] if out.ndim == 1 else out).copy()
    near, price, reach = np.full((len(ids), LISTED), -1), np.full((len(ids), LISTED), np.inf), np.full(len(ids), -1.0)
    if start:
        near[:, 0], price[:, 0], reach = start[0], start[1], np.where(start[0] >= 0, start[1], -1.0)
    at, cost = np.full(len(ids), -1), np.full(len(ids), np.inf)
    places, new, scale = np.arange(len(ids)), np.zeros(len(ids), bool), float(np.sqrt((c * c).sum(axis=1).max())) if len(ids) else 0.0
    merges = []
    while len(ids) > 1:
        _relist(ids, w, c, near, price, reach)
        at, cost = _first(near, price)
        bound = out.min(axis=1, initial=np.inf) * (1 - 1e-9)
        a = np.flatnonzero((at >= 0) & (at[at] == np.arange(len(ids))) & (np.arange(len(ids)) < at) & (cost < np.minimum(bound, bound[at])))
        if not len(a):
            break
        b = at[a]
        total = w[a] + w[b]
        merges.append((ids[a], ids[b], np.sqrt(2 * cost[a]), np.rint(total).astype(np.int64)))
        out[a] = _grown(out[a], out[b], w[a], w[b], cost[a], scale)
        reach[a] = _grown(reach[a, None], reach[b, None], w[a], w[b], cost[a], scale)[:, 0]
        c[a], w[a], new[a] = (c[a] * w[a, None] + c[b] * w[b, None]) / total[:, None], total, True
        _remap(a, b, w, c, near, price, reach)
        keep = np.ones(len(ids), bool)
        keep[b] = False
        place = np.cumsum(keep) - 1
        near = np.where(near >= 0, place[near], -1)[keep]
        places, ids, w, c, out, new, price, reach = (x[keep] for x in (places, ids, w, c, out, new, price, reach))
        at, cost = np.full(len(ids), -1), np.full(len(ids), np.inf)
    return places, w, c, new, out, np.where(at >= 0, ids[at], -1) if len(ids) else at, np.where(at >= 0, cost, np.inf), merges


def _first(near: np.ndarray, price: np.ndarray) -> tuple:
    """The nearest of each list by (cost, smaller place, larger place)."""
    cost, at = price.min(axis=1), near[np.arange(len(near)), price.argmin(axis=1)]
    tied = np.flatnonzero(((price == cost[:, None]) & (near >= 0)).sum(axis=1) > 1)
    if len(tied):
        tie = (price[tied] == cost[tied, None]) & (near[tied] >= 0)
        for part in (np.minimum(near[tied], tied[:, None]), np.maximum(near[tied], tied[:, None])):
            part = np.where(tie, part, np.iinfo(np.int64).max)
            tie &= part == part.min(axis=1)[:, None]
        at[tied] = near[tied, tie.argmax(axis=1)]
    return at, cost


def _relist(ids: np.ndarray, w: np.ndarray, c: np.ndarray, near: np.ndarray, price: np.ndarray, reach: np.ndarray) -> None:
    """Searches the clusters whose list does not tell their nearest."""
    lost = np.flatnonzero(~((price.min(axis=1) <= reach) & (near >= 0).any(axis=1)))
    sides = lambda: ((ids[lost], w[lost], c[lost]), (ids, w, c))
    if len(lost) and len(ids) >= _LONG:
        with np.errstate(all="ignore"):
            lists = _Lists(lost)
            if _single(*sides()):
                _scan(*sides(), lists, None, lost, np.float32)
        near[lost], price[lost], reach[lost] = lists.at, lists.cost, lists.reach
        _within(near, price, reach)
        lost = lost[~((price[lost].min(axis=1) <= reach[lost]) & (near[lost] >= 0).any(axis=1))]
    if len(lost):  # one, as the rest is too alike or too little
        best = _Best(ids[lost])
        _compare(*sides(), best, None, own=lost)
        near[lost], price[lost] = -1, np.inf
        near[lost, 0], price[lost, 0], reach[lost] = best.at, best.cost, best.cost


def _within(near: np.ndarray, price: np.ndarray, reach: np.ndarray) -> None:
    """Nothing is listed that is beyond the bound of those not listed."""
    beyond = price > reach[:, None]
    near[beyond], price[beyond] = -1, np.inf


def _remap(a: np.ndarray, b: np.ndarray, w: np.ndarray, c: np.ndarray, near: np.ndarray, price: np.ndarray, reach: np.ndarray) -> None:
    """The lists after the merges of b into a: those of a have what both had, others the costs of what they became."""
    into, gone = np.arange(len(w)), np.zeros(len(w), bool)
    into[b], gone[a], gone[b] = a, True, True
    both = np.concatenate([near[a], near[b]], axis=1)
    both = np.where(both >= 0, into[both], -1)
    both[both == a[:, None]] = -1
    both.sort(axis=1)
    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
    cost = np.full(both.shape, np.inf)
    i, j = np.nonzero(both >= 0)
    cost[i, j] = merge_cost(w[a[i]], c[a[i]], w[both[i, j]], c[both[i, j]])
    order = np.argsort(cost, axis=1, kind="stable")
    both, cost = np.take_along_axis(both, order, 1), np.take_along_axis(cost, order, 1)
    reach[a] = np.minimum(reach[a], cost[:, LISTED] * (1 - 1e-9))
    i, j = np.nonzero((near >= 0) & gone[near] & ~gone[:, None])
    near[i, j] = into[near[i, j]]
    price[i, j] = merge_cost(w[i], c[i], w[near[i, j]], c[near[i, j]])
    reach[i] *= 1 - 1e-9
    near[a], price[a] = both[:, :LISTED], cost[:, :LISTED]
    _within(near, price, reach)


def _cuts(sample: np.ndarray, depth: int) -> list:
    """A tree of median cuts along the widest direction: (direction, cut) a node, level by level."""
    scale = np.abs(sample).max() or 1.0
    nodes, groups, rng = [], [sample / scale], np.random.default_rng(0)
    start = rng.normal(size=sample.shape[1])
    for _ in range(depth):
        parts = []
        for g in groups:
            v = start
            if len(g) > 1:
                x = g - g.mean(axis=0)
                for _ in range(12):
                    u = x.T @ (x @ v)
                    v = u / np.linalg.norm(u) if np.linalg.norm(u) > 0 else v
            t = g @ v
            m = float(np.median(t)) if len(g) else 0.0
            nodes.append((v / scale, m))
            parts += [g[t < m], g[t >= m]]
        groups = parts
    return nodes


def _leaves(c: np.ndarray, nodes: list, depth: int) -> np.ndarray:
    leaf, first = np.zeros(len(c), np.int64), 0
    for level in range(depth):
        here = nodes[first:first + (1 << level)]
        right = (c * np.array([v for v, _ in here])[leaf]).sum(axis=1) >= np.array([m for _, m in here])[leaf]
        leaf, first = 2 * leaf + right, first + (1 << level)
    return leaf


def _packed(nodes: list, depth: int, most: int):
    """Rows of (id, w, c) -> rows of at most ``most`` clusters of one leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(ids):
                continue
            c = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            leaf = _leaves(c, nodes, depth)
            for part in np.unique(leaf):
                at = np.flatnonzero(leaf == part)
                for i in range(0, len(at), most):
                    some = at[i:i + most]
                    columns = [[int(part)], [int(ids[some[0]])], [len(some)], [ids[some].tobytes()], [w[some].tobytes()], [c[some].tobytes()]]
                    types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=[x.split()[0] for x in _PACKS.split(", ")])

    return run


def _joined(column: pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _clusters(packs: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The clusters of some packs in the order of their ids."""
    ids, w = _joined(packs["ids"], np.int64), _joined(packs["ws"])
    order = np.argsort(ids, kind="stable")
    return ids[order], w[order], _joined(packs["cs"]).reshape(len(ids), -1)[order] if len(ids) else np.empty((0, 0))


def _block(packs: pa.Table) -> pa.Table:
    """One row of the packs of a block, with its box and least weight."""
    ids, w, c = _clusters(packs)
    columns = [[packs["block"][0].as_py()], [ids.tobytes()], [w.tobytes()], [c.tobytes()], [c.min(axis=0)], [c.max(axis=0)], [float(w.min())]]
    types = [pa.int64(), *[pa.binary()] * 3, *[pa.list_(pa.float64())] * 2, pa.float64()]
    return pa.table([pa.array(x, t) for x, t in zip(columns, types)], names=[x.split()[0] for x in _BLOCKS.split(", ")])


_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def _rows(rows: list[dict]) -> pa.Table:
    """Rows of a round; arrays are bytes in binary columns."""
    fields = [x.split() for x in _ROUND.split(", ")]
    value = lambda x, kind: x.tobytes() if kind == "binary" and x is not None else x
    return pa.table([pa.array([value(r.get(name), kind) for r in rows], _TYPES[kind]) for name, kind in fields], names=[name for name, _ in fields])


def _array(row: dict, name: str, kind=np.float64, wide: int = 0) -> np.ndarray:
    flat = np.frombuffer(row[name], kind) if row[name] else np.empty(0, kind)
    return flat.reshape(wide, -1).copy() if wide else flat


def _held(row: dict) -> tuple:
    """ids, weights, centroids of a block's or a proposal's row."""
    ids = _array(row, "ids", np.int64)
    return ids, _array(row, "ws"), _array(row, "cs").reshape(len(ids), -1) if len(ids) else np.empty((0, 0))


def _state(row: dict, blocks: int) -> tuple:
    """ids, weights, centroids of a block, then a row a block: the nearest there (-1:
    not known) and its cost (not known: a bound)."""
    return *_held(row), _array(row, "nears", np.int64, blocks), _array(row, "costs", wide=blocks)


def _nearest(ids: np.ndarray, nears: np.ndarray, costs: np.ndarray) -> tuple:
    """Block, id and cost of each cluster's nearest of those known, and whether
    blocks where it is not known could have a nearer one, a row a block."""
    known = nears >= 0
    least = np.where(known, costs, np.inf).min(axis=0, initial=np.inf)
    tie = known & (costs == least)
    for part in (np.minimum(nears, ids), np.maximum(nears, ids)):
        part = np.where(tie, part, np.iinfo(np.int64).max)
        tie &= part == part.min(axis=0, initial=np.iinfo(np.int64).max)
    block = tie.argmax(axis=0)
    near = np.where(tie.any(axis=0), nears[block, np.arange(len(ids))], -1)
    return block, near, least, ~known & np.isfinite(costs) & (costs * (1 - 1e-9) <= least)


def _merges_row(merges: list) -> dict:
    parts = [np.concatenate(x) for x in zip(*merges)] if merges else [np.empty(0)] * 4
    return dict(zip(("left", "right", "height", "size"), parts))


def _learn(row: dict, ids: np.ndarray, nears: np.ndarray, costs: np.ndarray) -> None:
    """What a row says about the nearest of a block's clusters in another block."""
    if row["kind"] == _FLOOR:
        at = np.flatnonzero(costs > row["floor"])
        nears[at], costs[at] = -1, row["floor"]
        return
    near, cost = _array(row, "nears", np.int64), _array(row, "costs")
    if row["kind"] == _FOUND:
        at = _array(row, "bnears", np.int64)
        nears[at], costs[at] = near, cost
    else:
        _take(ids, nears, costs, near, cost)


def _take(ids: np.ndarray, nears: np.ndarray, costs: np.ndarray, near: np.ndarray, cost: np.ndarray) -> None:
    """Others that are nearer than the nearest so far, or than its bound."""
    low, high = np.minimum(ids, near), np.maximum(ids, near)
    old_low, old_high = np.minimum(ids, nears), np.maximum(ids, nears)
    sooner = (nears < 0) | (low < old_low) | ((low == old_low) & (high < old_high))
    at = np.flatnonzero((near >= 0) & ((cost < costs) | ((cost == costs) & sooner)))
    nears[at], costs[at] = near[at], cost[at]


def _merge(rows: pa.Table, blocks: int, joined: int) -> pa.Table:
    """The blocks that become one (``joined`` of them) and what was found for them in
    others: the merges inside, the clusters left and those that propose to merge
    with their nearest in another block (larger ids with all that is theirs)."""
    parts = sorted((r for r in rows.to_pylist() if r["kind"] == _STATE), key=lambda r: r["block"])
    found = sorted((r for r in rows.to_pylist() if r["kind"] in (_FOUND, _GREW, _FLOOR)), key=lambda r: -r["kind"])
    states, wide = [], -(-blocks // joined)
    for row in parts:
        state = _state(row, blocks)
        for f in found:
            if f["block"] == row["block"]:
                _learn(f, state[0], state[3][f["n"]], state[4][f["n"]])
        states.append(state)
    dim = max(s[2].shape[1] for s in states)
    ids, w = (np.concatenate([s[i] for s in states]) for i in (0, 1))
    c = np.concatenate([s[2].reshape(-1, dim) for s in states])
    nears, costs = (np.concatenate([s[i] for s in states], axis=1) for i in (3, 4))
    block = parts[0]["block"] // joined
    if joined > 1:
        order = np.argsort(ids, kind="stable")
        ids, w, c, nears, costs = ids[order], w[order], c[order], nears[:, order], costs[:, order]
        groups = [slice(i * joined, (i + 1) * joined) for i in range(wide)]
        some = [_joined_columns(ids, nears[g], costs[g]) for g in groups]
        nears, costs = (np.array([x[i] for x in some]).reshape(wide, len(ids)) for i in (0, 1))
        at = np.flatnonzero(nears[block] >= 0)  # the others' nearest may have changed meanwhile
        place = np.minimum(np.searchsorted(ids, nears[block, at]), len(ids) - 1)
        wrong = (ids[place] != nears[block, at]) | (merge_cost(w[at], c[at], w[place], c[place]) != costs[block, at])
        nears[block, at[wrong]] = -1
    near = nears[block]
    start = np.where(near >= 0, np.searchsorted(ids, near), -1), np.where(near >= 0, costs[block], np.inf)
    others = np.arange(wide) != block
    places, w, c, new, out, near, cost, merges = agglomerate(ids, w, c, costs[others].T, start)
    ids, nears, costs = ids[places], nears[:, places], np.empty((wide, len(places)))
    nears[:, new] = -1
    costs[others], costs[block], nears[block] = out.T, cost, near
    of, near, cost, open_ = _nearest(ids, nears, costs)
    state = {"kind": _STATE, "block": block, "n": len(ids), "ids": ids, "ws": w, "cs": c, "nears": nears, "costs": costs,
             "floor": float(cost[near >= 0].max(initial=0))}
    tell = []
    sure = (near >= 0) & ~open_.any(axis=0)
    for other in range(wide):
        for larger in (False, True):
            at = np.flatnonzero(sure & (of == other) & ((ids > near) == larger))
            if len(at):
                own = {"ws": w[at], "cs": c[at], "costs": costs[:, at]} if larger else {}
                tell.append({"kind": _LARGER if larger else _SMALLER, "block": other, "n": len(at), "ids": ids[at], "bnears": near[at], "bcosts": cost[at], **own})
    return _rows([state | _merges_row(merges), *tell])


def _joined_columns(ids: np.ndarray, nears: np.ndarray, costs: np.ndarray) -> tuple:
    """The rows of some blocks as one: not known where one that is not known could have a nearer one."""
    _, near, cost, open_ = _nearest(ids, nears, costs)
    bound = np.where(nears >= 0, np.inf, costs).min(axis=0, initial=np.inf)
    lost = (near < 0) | open_.any(axis=0)
    return np.where(lost, -1, near), np.where(lost, np.minimum(bound, cost), cost)


def _cross(rows: pa.Table, blocks: int, boxes: dict | None, most: dict | None, afresh: bool) -> pa.Table:
    """A block and the proposals to it: merges with clusters of other blocks that are each
    other's nearest, and what has to be searched where. ``boxes``: those of all blocks, at first;
    ``most``: the highest cost of a nearest one in each. Those that grew are compared with a block unless all there have nearer ones."""
    rows = rows.to_pylist()
    row = next(r for r in rows if r["kind"] in (None, _STATE))
    block = row["block"]
    if boxes is not None:
        ids, w, c = _held(row)
        nears, costs = np.full((blocks, len(ids)), -1), np.full((blocks, len(ids)), np.inf)
        for other, (low, high, least) in boxes.items():
            gap = np.maximum(np.maximum(low - c, c - high), 0)
            costs[other] = (gap * gap).sum(axis=1) * (w * least / (w + least)) * (1 - 1e-9)
    else:
        ids, w, c, nears, costs = _state(row, blocks)
    merges, grew = [], np.zeros(len(ids), bool)
    if len(ids):
        _, near, cost, open_ = _nearest(ids, nears, costs)
        near = np.where(open_.any(axis=0), -1, near)  # those did not propose
        w, c, scale = w.copy(), c.copy(), float(np.sqrt((c * c).sum(axis=1).max()))
        gone = np.zeros(len(ids), bool)
        for r in rows:
            if r["kind"] not in (_SMALLER, _LARGER):
                continue
            (other, v, e), wish, price = _held(r) if r["kind"] == _LARGER else (_array(r, "ids", np.int64), None, None), _array(r, "bnears", np.int64), _array(r, "bcosts")
            a = np.minimum(np.searchsorted(ids, wish), len(ids) - 1)
            b = np.flatnonzero((ids[a] == wish) & (near[a] == other) & (cost[a] == price))
            a = a[b]
            if r["kind"] == _SMALLER:
                gone[a] = True
                continue
            v, e, theirs = v[b], e[b], _array(r, "costs", wide=blocks)[:, b]
            total = w[a] + v
            merges.append((ids[a], other[b], np.sqrt(2 * price[b]), np.rint(total).astype(np.int64)))
            costs[:, a] = _grown(costs[:, a].T, theirs.T, w[a], v, price[b], max(scale, float(np.sqrt((e * e).sum(axis=1).max(initial=0))))).T
            c[a], w[a], grew[a] = (c[a] * w[a, None] + e * v[:, None]) / total[:, None], total, True
        changed = ids[gone | grew]
        nears[:, grew | afresh] = -1
        nears[block, np.isin(nears[block], changed)] = -1
        ids, w, c, nears, costs, grew = ids[~gone], w[~gone], c[~gone], nears[:, ~gone], costs[:, ~gone], grew[~gone]
        lost = np.flatnonzero(nears[block] < 0)
        best = _Best(ids[lost])
        _compare((ids[lost], w[lost], c[lost]), (ids, w, c), best, None, own=lost)
        nears[block, lost], costs[block, lost] = best.near, best.cost
        rest = ~grew
        best, near, cost = _Best(ids[rest]), nears[block, rest], costs[block, rest]
        _compare((ids[grew], w[grew], c[grew]), (ids[rest], w[rest], c[rest]), None, best)
        _take(best.ids, near, cost, best.near, best.cost)
        nears[block, rest], costs[block, rest] = near, cost
    of, near, cost, open_ = _nearest(ids, nears, costs)
    if most is not None:
        open_[:, grew] |= np.isfinite(costs[:, grew]) & (costs[:, grew] * (1 - 1e-9) <= np.array([[most.get(i, 0.0)] for i in range(blocks)]))
    needs = open_.astype(np.uint8) * _SEARCH
    at = np.flatnonzero((near >= 0) & (of != block))
    needs[of[at], at] = _VERIFY
    needs[block] = 0
    floors = np.where(grew & (needs == 0), costs, np.inf).min(axis=1, initial=np.inf)  # of merges across blocks the others' bounds know nothing
    floors[block] = np.inf
    return _rows([{"kind": _STATE, "block": block, "n": len(ids), "ids": ids, "ws": w, "cs": c, "nears": nears, "costs": costs, "needs": needs, "grew": grew,
                   "bnears": near, "bcosts": cost, "wants": np.flatnonzero(needs.any(axis=1)), "floors": floors} | _merges_row(merges)])


def _search(rows: pa.Table, blocks: int, groups: int) -> pa.Table:
    """Blocks of two groups: for the clusters of each that need it the nearest in the
    others. One whose nearest is as it was needs no search."""
    a, b = rows["a"][0].as_py(), rows["b"][0].as_py()
    held, found = {}, []
    for r in rows.to_pylist():
        held[r["block"]] = *_held(r), _array(r, "needs", np.uint8, blocks), _array(r, "bnears", np.int64), _array(r, "bcosts"), _array(r, "grew", bool)

    def asked(one: int, other: int) -> np.ndarray:
        (_, w, c, needs, near, cost, _), (names, v, e, *_) = held[one], held[other]
        ask = needs[other] == _SEARCH
        at = np.flatnonzero(needs[other] == _VERIFY)
        if len(at) and len(names):
            place = np.minimum(np.searchsorted(names, near[at]), len(names) - 1)
            ask[at] = (names[place] != near[at]) | (merge_cost(w[at], c[at], v[place], e[place]) != cost[at])
        else:
            ask[at] = True
        return ask

    for one in sorted(held):
        for other in sorted(held):
            if one >= other or sorted((one % groups, other % groups)) != [a, b]:
                continue
            sides, asks, grew = [held[x][:3] for x in (one, other)], [asked(one, other), asked(other, one)], [held[x][-1] for x in (one, other)]
            some = lambda i, m: tuple(x[m] for x in sides[i])
            best, fresh = [_Best(side[0]) for side in sides], [_Best(side[0]) for side in sides]
            for i in (0, 1):  # both ways: the others learn of those that grew
                m = asks[i] & grew[i]
                own = _Best(sides[i][0][m])
                _compare(some(i, m), sides[1 - i], own, fresh[1 - i])
                best[i].near[m], best[i].cost[m] = own.near, own.cost
            rest = [ask & ~g for ask, g in zip(asks, grew)]
            pair = [_Best(side[0][m]) for side, m in zip(sides, rest)]
            _compare(some(0, rest[0]), some(1, rest[1]), *pair)
            for i in (0, 1):
                _compare(some(i, rest[i]), some(1 - i, ~rest[1 - i]), pair[i], None)
                best[i].near[rest[i]], best[i].cost[rest[i]] = pair[i].near, pair[i].cost
            for i, (block, beside) in enumerate(((one, other), (other, one))):
                at = np.flatnonzero(asks[i])
                if len(at):
                    found.append({"kind": _FOUND, "block": block, "n": beside, "bnears": at, "nears": best[i].near[at], "costs": best[i].cost[at]})
                if (asks[1 - i] & grew[1 - i]).any():
                    found.append({"kind": _GREW, "block": block, "n": beside, "nears": fresh[i].near, "costs": fresh[i].cost})
    return _rows(found)


def _finish(packs: pa.Table) -> pa.Table:
    """The remaining merges of the clusters of one block."""
    ids, w, c = _clusters(packs)
    merges = []
    while True:  # again where equal costs went in a circle
        places, w, c, *_, more = agglomerate(ids, w, c, np.full(len(ids), np.inf))
        merges, ids = merges + more, ids[places]
        if len(ids) < 2 or not more:
            break
    parts = list(zip(*merges)) if merges else [[np.empty(0, t)] for t in (np.int64, np.int64, float, np.int64)]
    return pa.table([pa.array(np.concatenate(x)) for x in parts], names=["left", "right", "height", "size"])


def _depth(n: int, block: int) -> int:
    return int(np.ceil(np.log2(n / (0.8 * block))))


def _fitted(clusters: DataFrame, depth: int) -> list:
    sample = clusters.orderBy(F.xxhash64("id")).limit(SAMPLE).select("c").toArrow()["c"].combine_chunks()
    return _cuts(sample.flatten().to_numpy().reshape(len(sample), -1), depth)


def _dealt(clusters: DataFrame, n: int, block: int) -> tuple[DataFrame, dict]:
    """The clusters in blocks of near ones, one row a block, numbered along the tree; a leaf
    that the sample made too small is dealt over several. With the box and least weight of each."""
    depth = max(1, _depth(n, block))
    nodes = _fitted(clusters, depth)
    packs = checkpoint_parquet(clusters.select("id", "w", "c").mapInArrow(_packed(nodes, depth, max(1, block // 8)), _PACKS), "ward-packs")
    parts = packs.groupBy("part").agg(F.ceil(F.sum("n") / block).alias("k")).orderBy("part").collect()  # one row a leaf
    firsts = np.cumsum([0, *[int(r.k) for r in parts]])
    numbers = packs.sparkSession.createDataFrame([(r.part, int(first), int(r.k)) for r, first in zip(parts, firsts)], "part int, before bigint, k bigint")
    block_of = F.col("before") + F.pmod(F.xxhash64("first"), "k")
    dealt = packs.join(F.broadcast(numbers), "part").select(block_of.alias("block"), "ids", "ws", "cs")
    blocks = checkpoint_parquet(dealt.groupBy("block").applyInArrow(_block, _BLOCKS), "ward-blocks")
    boxes = {r.block: (np.array(r.low), np.array(r.high), r.least) for r in blocks.select("block", "low", "high", "least").collect()}  # one row a block
    return blocks, boxes


def _crossed(rows: DataFrame, blocks: int, boxes: dict | None = None, most: dict | None = None, afresh: bool = False) -> DataFrame:
    """The blocks after the merges across them, with what has to be searched."""
    return checkpoint_parquet(rows.groupBy("block").applyInArrow(lambda t: _cross(t, blocks, boxes, most, afresh), _ROUND), "ward-crossed")


def _round(state: DataFrame, blocks: int, groups: int, joined: int) -> DataFrame:
    """What the blocks need is searched in the others, by pairs of groups of blocks
    that are held at once; then merges inside. ``joined`` blocks become one."""
    of = lambda block: F.col(block) % groups
    ends = state.select("block", F.explode("wants").alias("other")).withColumn("other", F.col("other").cast("bigint"))
    ends = ends.select(F.least(of("block"), of("other")).alias("a"), F.greatest(of("block"), of("other")).alias("b"), F.explode(F.array("block", "other")).alias("block")).distinct()
    held = state.join(F.broadcast(ends), "block").select("a", "b", "block", "ids", "ws", "cs", "needs", "grew", "bnears", "bcosts")  # names of blocks only are broadcast
    found = held.repartition(4 * groups * groups, "a", "b").groupBy("a", "b").applyInArrow(lambda t: _search(t, blocks, groups), _ROUND)
    own = state.select(*[c if c in ("kind", "block", "n", "ids", "ws", "cs", "nears", "costs") else F.lit(None).cast(kind).alias(c) for c, kind in _columns(_ROUND)])
    floors = state.select(F.col("block").alias("n"), F.posexplode("floors").alias("block", "floor")).where(F.col("floor") < float("inf"))
    floors = floors.select(F.lit(_FLOOR).alias("kind"), F.col("block").cast("bigint").alias("block"), "n", "floor")
    rows = own.unionByName(found).unionByName(floors, allowMissingColumns=True).withColumn("into", F.floor(F.col("block") / joined))
    return checkpoint_parquet(rows.groupBy("into").applyInArrow(lambda t: _merge(t.drop_columns(["into"]), blocks, joined), _ROUND), "ward-merged")


def _columns(schema: str) -> list:
    return [x.split() for x in schema.split(", ")]


def _told(rows: DataFrame) -> DataFrame:
    """The merges that the rows of a round tell."""
    one = rows.where(F.size("left") > 0).select(F.explode(F.arrays_zip("left", "right", "height", "size")).alias("m"))
    return one.select("m.left", "m.right", "m.height", "m.size")


def _left(rows: DataFrame) -> tuple[int, dict]:
    """The number of clusters left and the highest cost of a nearest one of each block, where told."""
    of = rows.where(F.col("kind") == _STATE).select("block", "n", "floor").collect()  # one row a block
    return sum(r.n for r in of), {r.block: r.floor for r in of if r.floor is not None}


def _rounds(clusters: DataFrame, n: int, block: int, d: int) -> tuple[DataFrame, list]:
    """Rounds until two blocks' size holds all clusters; the blocks then and the merges."""
    rows, boxes = _dealt(clusters, n, block)
    blocks, merges, idle = max(boxes) + 1, [], 0
    rows = _crossed(rows.select(*[c if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in _columns(_ROUND)]), blocks, boxes)
    while True:
        joined = 2 if blocks > 2 and n < 0.4 * blocks * block else 1
        groups = min(blocks, max(_GROUPS, -(-n * max(d, 1) // _HELD)))
        rows = _round(rows, blocks, groups, joined)
        blocks = -(-blocks // joined)
        merges.append(_told(rows))
        left, most = _left(rows)
        if left > 2 * block:
            rows = _crossed(rows, blocks, None, most, idle == _IDLE)
            merges.append(_told(rows))
            left, _ = _left(rows)
        if left <= 2 * block:
            return rows.where(F.col("kind") == _STATE), merges
        idle = idle + 1 if left == n else 0
        if idle > _IDLE + 2:
            raise ValueError("no two clusters are each other's nearest")
        n = left


def distinct_points(df: DataFrame, features: str, id_col: str) -> DataFrame:
    """(id, w, c): each distinct vector with its smallest id and its number of
    rows. Rows without an id or a vector, or with a component that is null or not
    finite, take no part; one id must not have two vectors."""
    from pyspark.ml.functions import vector_to_array

    c = F.col(features) if dict(df.dtypes)[features].startswith("array") else vector_to_array(F.col(features))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), c.cast("array<double>").alias("c"))
    rows = rows.where(F.col("id").isNotNull() & F.col("c").isNotNull() & (F.size("c") > 0) & F.forall("c", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    return rows.groupBy(F.transform("c", lambda x: x + 0.0).alias("c")).agg(F.min("id").alias("id"), F.count(F.lit(1)).cast("double").alias("w")).select("id", "w", "c")


def ward_merges(df: DataFrame, features: str = "features", id_col: str = "id", block: int = BLOCK) -> DataFrame:
    """The whole hierarchy of the distinct vectors: (left, right, height, size), one
    row a merge, a cluster named by its smallest id and ``right`` going into
    ``left``; height as in a Ward linkage (the distance of two single points).
    Equal rows are one point of their number; equal costs go by ids. No point or
    one gives no merges. The result does not depend on ``block``."""
    return merges_of(checkpoint_parquet(distinct_points(df, features, id_col), "ward-clusters"), block)


def merges_of(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """The same of the written table of ``distinct_points``."""
    spark, clusters = points.sparkSession, points
    n, least, most = clusters.agg(F.count(F.lit(1)), F.min(F.size("c")), F.max(F.size("c"))).first()
    if not n:
        return spark.createDataFrame([], MERGES)
    if least != most:
        raise ValueError("vectors of different lengths")
    block, rounds = max(1, min(block, _WIDE // most)), []
    packs = clusters.mapInArrow(_packed([], 0, max(1, block)), _PACKS)
    if n > 2 * block:
        packs, rounds = _rounds(clusters, n, block, most)
    out = packs.select(F.lit(0).alias("part"), "ids", "ws", "cs").groupBy("part").applyInArrow(_finish, MERGES)
    for merges in rounds:
        out = out.unionByName(merges)
    return checkpoint_parquet(out, "ward-hierarchy")


def cut(merges: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(id, root) of the points of a hierarchy cut at ``k`` clusters: all merges
    but the k - 1 highest hold; root is the smallest id of the cluster. Paths to
    the root are halved until none changes, each step a join."""
    top = merges.orderBy(F.desc("height"), F.desc("left"), F.desc("right")).limit(max(k - 1, 0)).select("right")  # k - 1 rows
    held = merges.join(F.broadcast(top), "right", "left_anti").select(F.col("right").alias("id"), F.col("left").alias("root"))
    now = checkpoint_parquet(points.select("id").join(held, "id", "left").select("id", F.coalesce("root", "id").alias("root")), "ward-cut")
    while True:
        up = now.select(F.col("id").alias("root"), F.col("root").alias("above"))
        after = checkpoint_parquet(now.join(up, "root").select("id", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "ward-cut")
        if after.where("moved").isEmpty():
            return after.select("id", "root")
        now = after.select("id", "root")


def ward_labels(df: DataFrame, merges: DataFrame, k: int, features: str = "features", id_col: str = "id", out: str = "cluster_ward", points: DataFrame | None = None) -> DataFrame:
    """(id, label) of every row: its cluster after the cut, numbered from 0 by the
    smallest id; rows that take no part have none. Each distinct vector is
    looked up once, by the hash of its row's vector; ``points``: the table of them
    where it is written already."""
    points = distinct_points(df, features, id_col) if points is None else points
    roots = cut(merges, points, k)
    number = roots.select("root").distinct().withColumn(out, (F.row_number().over(Window.orderBy("root")) - 1).cast("int"))  # k rows
    of_vector = points.join(roots, "id").join(F.broadcast(number), "root").select("c", out)
    from pyspark.ml.functions import vector_to_array
    c = F.col(features) if dict(df.dtypes)[features].startswith("array") else vector_to_array(F.col(features))
    keyed = df.select(id_col, F.when(F.col(id_col).isNotNull(), F.transform(c.cast("array<double>"), lambda x: x + 0.0)).alias("c"))
    return keyed.join(of_vector, "c", "left").select(id_col, out)
