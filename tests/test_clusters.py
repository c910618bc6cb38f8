"""Clusters from spanning trees against a plain traversal, and plots worked out by hand."""

import numpy as np

from relvane.operators import clusters, models


def by_tree(x, block):
    """The steps of the operator on one key: points, trees of each two blocks, merged, traversed."""
    keys, first = {}, {}
    for n, v in enumerate(map(tuple, x)):
        keys.setdefault(v, []).append(n)
    members = {m[0]: m for m in keys.values()}
    ids = sorted(members)
    blocks = max(1, -(-len(ids) // block))
    edges = []
    for lo in range(blocks):
        for hi in range(lo, blocks):
            own = [p for p in ids if p * 7 % blocks in (lo, hi)]
            if len(own) > 1:
                i, j, d = clusters.spanning(x[own])
                edges += zip(np.array(own)[i].tolist(), np.array(own)[j].tolist(), d.tolist())
    i, j, d = (np.array(c) for c in zip(*edges)) if edges else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    keep = clusters.merged(i, j, d)
    assert len(keep) == len(ids) - 1
    return clusters.traversed(ids, members, i[keep].tolist(), j[keep].tolist(), d[keep].tolist())


def test_the_tree_is_visited_as_the_points_are():
    for seed in range(500):
        r = np.random.default_rng(seed)
        n = int(r.integers(2, 40))
        x = r.normal(0, 1, (n, int(r.integers(1, 5))))
        for _ in range(int(r.integers(0, 6))):  # equal vectors
            x[r.integers(0, n)] = x[r.integers(0, n)]
        order, reach, before = models.visiting_order(x)
        got = by_tree(x, int(r.choice([3, 7, 100])))
        assert got[0] == order and np.allclose(got[1], reach) and got[2] == before
        labels = np.empty(n, int)
        labels[got[0]] = clusters.labelled(*got, 0.05)
        assert labels.tolist() == models.labels_of(x).tolist()


def test_plots_by_hand():
    """Points on a line, with the visit and its distances in the comment."""
    cases = [
        ([0, 1, 2, 10, 11, 12], [0, 0, 0, 1, 1, 1]),  # inf 1 1 8 1 1: two valleys on both sides of 8
        ([0, 1, 2, 50], [0, 0, 0, 0]),  # inf 1 1 48: the slope up from the valley goes on to the end, so all are in
        ([0, 5, 10, 15], [0, 0, 0, 0]),  # inf 5 5 5: one valley to the end
        ([0, 100], [0, 0]),  # inf 100: down and up again
        ([7], [-1]),
        ([3, 3, 3, 90, 90], [0, 0, 0, 1, 1]),  # inf 0 0 87 0
    ]
    for x, want in cases:
        x = np.array(x, float)[:, None]
        assert models.labels_of(x).tolist() == want, x.ravel()
        order, reach, before = by_tree(x, 2)
        labels = np.empty(len(x), int)
        labels[order] = clusters.labelled(order, reach, before, 0.05)
        assert labels.tolist() == want


def test_operator_with_keys_and_blocks(spark):
    r = np.random.default_rng(2)
    rows = []
    for key, n in (("a", 90), ("b", 1), ("c", 2), ("d", 61)):
        x = np.concatenate([r.normal(c, 0.1, (n // 3 + 1, 3)) for c in (0, 4, 9)])[:n]
        x[-1] = x[0]
        rows += [(key, 3 * k + 1, v.tolist()) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, asset long, vec array<double>").repartition(3)
    for block in (2048, 20):
        got = {(x.k, x.asset): x.label for x in clusters.cluster(df, ["k"], block=block).collect()}
        assert len(got) == len(rows)
        for key in "abcd":
            own = sorted((a, v) for k, a, v in rows if k == key)
            assert [got[key, a] for a, _ in own] == models.labels_of(np.array([v for _, v in own])).tolist()
    assert clusters.cluster(df.where("false"), ["k"]).collect() == []
