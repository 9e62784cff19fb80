"""Ward hierarchy: the merge table against greedy merging, the cut, awkward rows."""

import numpy as np
import pytest

from sentinela.operators.hierarchy import cut, distinct_points, ward_labels, ward_merges


def greedy(points, weights=None):
    """One merge at a time, each the pair with the smallest rise of the sum of squares."""
    n = len(points)
    c, w, size = points.astype(float).copy(), np.ones(n) if weights is None else np.array(weights, float), {}
    alive, out = np.ones(n, bool), []
    square = ((c[:, None] - c[None]) ** 2).sum(-1)
    cost = w[:, None] * w[None] / (w[:, None] + w[None]) * square
    np.fill_diagonal(cost, np.inf)
    for _ in range(n - 1):
        a, b = sorted(divmod(int(cost.argmin()), n))
        out.append((a, b, np.sqrt(2 * cost[a, b]), int(w[a] + w[b])))
        c[a], w[a], alive[b] = (c[a] * w[a] + c[b] * w[b]) / (w[a] + w[b]), w[a] + w[b], False
        own = np.where(alive, w[a] * w / (w[a] + w) * ((c[a] - c) ** 2).sum(-1), np.inf)
        own[a] = np.inf
        cost[a], cost[:, a], cost[b], cost[:, b] = own, own, np.inf, np.inf
    return out


def table(spark, points, ids=None):
    rows = [(int(i), [float(x) for x in p]) for i, p in zip(ids if ids is not None else range(len(points)), points)]
    return spark.createDataFrame(rows, "id bigint, features array<double>")


def merged(df):
    return sorted((r.left, r.right, pytest.approx(r.height, rel=1e-9), r["size"]) for r in df.collect())


@pytest.mark.parametrize("dim, spread", [(3, 1.0), (10, 6.0)])
def test_merge_table_equals_greedy_on_1000_points(spark, dim, spread):
    rng = np.random.default_rng(dim)
    points = rng.normal(size=(1000, dim)) + spread * rng.integers(0, 3, size=(1000, 1))
    want = sorted(greedy(points))
    got = ward_merges(table(spark, points).repartition(4), block=200)  # rounds over blocks, then the last block
    assert [(a, b, n) for a, b, _, n in merged(got)] == [(a, b, n) for a, b, _, n in want]
    heights = {(r.left, r.right): r.height for r in got.collect()}
    assert all(heights[a, b] == pytest.approx(h, rel=1e-9) for a, b, h, _ in want)


def test_block_size_does_not_matter_and_cut(spark):
    rng = np.random.default_rng(4)
    points = np.round(rng.normal(size=(150, 2)), 6)
    df = table(spark, points, ids=rng.permutation(150) * 7)
    tables = [ward_merges(df, block=size) for size in (20, 64, 1000)]
    rows = [sorted((r.left, r.right, r.height, r["size"]) for r in t.collect()) for t in tables]
    assert [[x[:2] + x[3:] for x in r] for r in rows[1:]] == [[x[:2] + x[3:] for x in rows[0]]] * 2
    for k in (1, 2, 5, 150, 200):
        held = sorted(rows[0], key=lambda r: (r[2], r[0], r[1]))[:max(150 - k, 0)]
        root = {r.id: r.id for r in df.collect()}
        for left, right, _, _ in held:
            root = {i: root[left] if r == root[right] else r for i, r in root.items()}
        found = {r.id: r.root for r in cut(tables[0], distinct_points(df, "features", "id"), k).collect()}
        groups = lambda m: sorted(sorted(i for i in m if m[i] == r) for r in set(m.values()))
        assert groups(found) == groups(root) and len(set(found.values())) == min(k, 150)
        assert all(r == min(i for i in found if found[i] == r) for r in found.values())


def test_equal_null_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(6, 2))
    rows = [(i, list(map(float, points[i % 6]))) for i in range(40)] + [(100, None), (101, [1.0, None]), (102, [float("nan"), 0.0]), (None, [0.0, 0.0]), (103, [])]
    df = spark.createDataFrame(rows, "id bigint, features array<double>")
    weights = [sum(i % 6 == j for i in range(40)) for j in range(6)]
    assert [(a, b, n) for a, b, _, n in merged(ward_merges(df))] == [(a, b, n) for a, b, _, n in sorted(greedy(points, weights))]
    labels = {r.id: r.cluster_ward for r in ward_labels(df, ward_merges(df), 3).collect()}
    assert {labels[i] for i in (100, 101, 102, 103, None)} == {None}
    assert all(labels[i] == labels[i % 6] for i in range(40)) and {labels[i] for i in range(6)} == {0, 1, 2} and labels[0] == 0
    assert ward_merges(df.where("false")).collect() == [] and ward_merges(df.where("id = 3")).collect() == []
    one = ward_labels(df.where("id = 3"), ward_merges(df.where("id = 3")), 4).collect()
    assert [(r.id, r.cluster_ward) for r in one] == [(3, 0)]


def test_rounds_over_blocks_cover_far_offsets_heavy_points_and_ties(spark):
    rng = np.random.default_rng(6)
    grid = np.array([(x, y) for x in range(8) for y in range(8)], float)
    points = np.vstack([1e6 + rng.normal(size=(120, 5)), 1e6 + 40 * rng.normal(size=(40, 5)), 1e6 + np.pad(grid, ((0, 0), (0, 3)))])
    points = points + rng.uniform(0, 1e-4, size=points.shape)  # nearly tied, far from zero
    weights = rng.integers(1, 6, len(points))
    ids = np.repeat(np.arange(len(points)), weights)
    rows = [(int(i) * 10 + int(k), [float(x) for x in points[i]]) for i, k in zip(ids, np.concatenate([np.arange(w) for w in weights]))]
    got = ward_merges(spark.createDataFrame(rows, "id bigint, features array<double>").repartition(7), block=30)
    assert [(a // 10, b // 10, n) for a, b, _, n in merged(got)] == [(a, b, n) for a, b, _, n in sorted(greedy(points, weights))]


def test_a_block_of_thousands_merges_in_seconds():
    import time

    from sentinela.operators.hierarchy import agglomerate

    points = np.random.default_rng(7).normal(size=(4000, 64))
    begun = time.process_time()
    merges = agglomerate(np.arange(4000), np.ones(4000), points, np.full(4000, np.inf))[-1]
    assert sum(len(m[0]) for m in merges) == 3999 and time.process_time() - begun < 60


def test_single_precision_finds_the_nearest_of_double():
    """Candidates from single precision, double where groups are far apart: the least costs are those of all pairs."""
    from sentinela.operators import hierarchy as h

    rng = np.random.default_rng(8)
    near = rng.normal(size=(700, 12))
    far = rng.normal(size=(700, 12)) + 1e5 * rng.integers(0, 2, size=(700, 1))  # single precision tells nothing inside a group
    huge = 1e200 * rng.normal(size=(300, 4))
    for points, kind in ((near, [np.float32]), (far, [np.float32, np.float64]), (huge, [np.float64]), (np.zeros((50, 3)), [np.float64])):
        ids, w, used = np.arange(len(points)), rng.integers(1, 4, len(points)).astype(float), []
        products = h._products

        def watched(a, b, kind, used=used, products=products):
            used.append(kind)
            return products(a, b, kind)

        a, b = slice(0, len(points) // 2), slice(len(points) // 2, None)
        rows, columns = h._Best(ids[a]), h._Best(ids[b])
        h._products = watched
        try:
            h._compare((ids[a], w[a], points[a]), (ids[b], w[b], points[b]), rows, columns)
        finally:
            h._products = products
        with np.errstate(all="ignore"):
            cost = w[a][:, None] * w[b] / (w[a][:, None] + w[b]) * ((points[a][:, None] - points[b]) ** 2).sum(-1)
        assert used == kind
        if np.isfinite(cost).all():
            assert np.allclose(rows.cost, cost.min(axis=1), rtol=1e-12) and np.allclose(columns.cost, cost.min(axis=0), rtol=1e-12)
            assert (rows.near == ids[b][cost.argmin(axis=1)]).all() and (columns.near == ids[a][cost.argmin(axis=0)]).all()


def test_ward_clusters_reads_the_points_once_and_finishes_at_two_blocks(spark, monkeypatch):
    from sentinela.operators import cluster, hierarchy as h

    points = np.random.default_rng(9).normal(size=(300, 6))
    calls, rounds = [], []
    distinct, one = h.distinct_points, h._round
    for module in (h, cluster):
        monkeypatch.setattr(module, "distinct_points", lambda *a: calls.append(1) or distinct(*a), raising=False)
    monkeypatch.setattr(h, "_round", lambda *a: rounds.append(1) or one(*a))
    got = {r.id: r.cluster_ward for r in cluster.ward_clusters(table(spark, points), 4).collect()}
    assert len(calls) == 1 and not rounds and set(got.values()) == {0, 1, 2, 3}
    assert len(merged(ward_merges(table(spark, points), block=150))) == 299 and not rounds  # two blocks' size
    assert len(merged(ward_merges(table(spark, points), block=100))) == 299 and rounds


def test_bounds_outside_grow_with_a_merge():
    """Two clusters with outside costs of 1 make one whose outside costs are 7/6 at least."""
    from sentinela.operators.hierarchy import agglomerate

    points = np.array([[0.0, 0.0], [1.0, 0.0], [0.5, np.sqrt(1.1 * 1.5)]])  # the third costs 1.1 with the pair
    merges = agglomerate(np.arange(3), np.ones(3), points, np.array([1.0, 1.0, 10.0]))[-1]
    assert [(m[0][0], m[1][0], m[3][0]) for m in merges] == [(0, 1, 2), (0, 2, 3)]


def test_rounds_search_only_what_the_last_merges_left_open(spark, monkeypatch):
    from sentinela.operators import hierarchy as h

    points = np.random.default_rng(11).normal(size=(900, 8))
    asked, one = [], h._crossed

    def watched(*a):
        rows = one(*a)
        for r in rows.select("ids", "needs").collect():
            asked.append((len(r.ids) // 8, int((np.frombuffer(r.needs, np.uint8) == h._SEARCH).sum())))
        asked.append(None)
        return rows

    monkeypatch.setattr(h, "_crossed", watched)
    got = merged(ward_merges(table(spark, points), block=100))
    assert [(a, b, n) for a, b, _, n in got] == [(a, b, n) for a, b, _, n in sorted(greedy(points))]
    rounds, last = [], []
    for x in asked:
        if x is None:
            rounds.append((sum(n for n, _ in last), sum(k for _, k in last) / max(len(last), 1)))
            last = []
        else:
            last.append(x)
    assert len(rounds) > 2 and rounds[0][1] > 0
    first, later = rounds[0], rounds[1:]
    per = lambda r: r[1] / max(r[0], 1)  # noqa: E731  (searches a cluster and block)
    assert sum(map(per, later)) / len(later) < 0.6 * per(first)


def test_a_cluster_grown_across_blocks_is_known_to_all():
    """A merge across blocks can come nearer to a third cluster than its old block was: the others' bounds follow."""
    from sentinela.operators import hierarchy as h

    rng = np.random.default_rng(12)
    points = rng.normal(size=(240, 6))
    block_of = np.arange(240) % 4
    boxes = {b: (points[block_of == b].min(axis=0), points[block_of == b].max(axis=0), 1.0) for b in range(4)}
    plain = lambda r: {k: np.frombuffer(v, np.uint8) if isinstance(v, bytes) else v for k, v in r.items()}
    tables = lambda rows: [h._rows([plain(r) for r in rows if r["block"] == b]) for b in range(4)]
    rows = [{"block": b, "n": 60, "ids": np.flatnonzero(block_of == b), "ws": np.ones(60), "cs": points[block_of == b]} for b in range(4)]
    rows, most = [r for t in tables(rows) for r in h._cross(t, 4, boxes, None, False).to_pylist()], None
    for _ in range(4):
        pair = h._rows([plain(r) for r in rows])
        pair = pair.append_column("a", [[0] * 4]).append_column("b", [[0] * 4])
        found = h._search(pair, 4, 1).to_pylist()
        found += [{"kind": h._FLOOR, "block": t, "n": r["block"], "floor": f} for r in rows for t, f in enumerate(r["floors"]) if np.isfinite(f)]
        after = [r for t in tables(rows + found) for r in h._merge(t, 4, 1).to_pylist()]
        states = [h._state(r, 4) for r in sorted((r for r in after if r["kind"] == h._STATE), key=lambda r: r["block"])]
        for ids, w, c, nears, costs in states:
            for b, (others, v, e, *_) in enumerate(states):
                cost = w[:, None] * v / (w[:, None] + v) * ((c[:, None] - e) ** 2).sum(-1)
                cost[ids[:, None] == others] = np.inf
                assert (costs[b] * (1 - 1e-9) <= cost.min(axis=1)).all()
        most = {r["block"]: r["floor"] for r in after if r["kind"] == h._STATE}
        rows = [r for t in tables(after) for r in h._cross(t, 4, None, most, False).to_pylist()]
    assert sum(r["n"] for r in rows) < 160 and any(r["left"] for r in rows)


def test_lists_of_nearest_ones_save_searches(monkeypatch):
    """A block keeps some of the nearest of each cluster: the same merges from fewer costs."""
    from sentinela.operators import hierarchy as h

    points = np.random.default_rng(13).normal(size=(5000, 16))
    costs, one = [], h._scan
    monkeypatch.setattr(h, "_scan", lambda a, b, *rest: costs.append(len(a[0]) * len(b[0])) or one(a, b, *rest))

    def run():
        costs.clear()
        merges = h.agglomerate(np.arange(5000), np.ones(5000), points, np.full(5000, np.inf))[-1]
        return sorted(zip(*(np.concatenate([m[i] for m in merges]).tolist() for i in range(4)))), sum(costs)

    got, few = run()
    monkeypatch.setattr(h, "_LONG", 1 << 40)
    assert (got, len(got)) == (run()[0], 4999) and few < 0.8 * sum(costs)
