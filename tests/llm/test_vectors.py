import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from relvane.llm import embeddings, topk

from .brute import components


def rows(seed=1, d=16):
    r = np.random.default_rng(seed)
    out = []
    for i in range(300):
        v = r.standard_normal(d)
        out.append((i, (v / np.linalg.norm(v)).tolist()))
    for i in range(300, 420):  # near copies, and 40 equal vectors
        v = np.array(out[i % 7][1]) + (0 if i < 340 else 0.03) * r.standard_normal(d)
        out.append((i, (v if i >= 340 else np.array(out[3][1])).tolist()))
    out += [(500, None), (501, [0.0] * d), (502, [1.0] * (d - 1) + [math.nan]), (503, [None] + [1.0] * (d - 1)), (504, [math.inf] * d), (505, []), (None, [1.0] * d), (520, [0.5] * (d // 2)), (540, [2.0] * d)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in out]


def frame(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumns({"label": F.lit(1), "q": F.lit("x"), "v": F.lit(2), "rep": F.lit(3)}).repartition(3)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def best(data, k=20):
    """By row: each query row has a list of its own, of all rows but itself."""
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in data if i is not None and usable(v)]
    out = []
    for n, (i, a) in enumerate(good):
        if i % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), j) for m, (j, b) in enumerate(good) if m != n)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(scores)]
    return sorted(out)


def test_top_k_as_by_brute_force(spark):
    data = rows()
    for kwargs in ({}, {"rows": 50, "queries": 7, "lists": 3}, {"k": 1000}):
        got = topk.top_k(frame(spark, data), **kwargs)
        assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
        assert sorted(map(tuple, got.collect())) == best(data, kwargs.get("k", 20))


def test_top_k_of_rows_that_share_an_id(spark):
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [3.0, 3.0]), (2, [0.5, 0.5]), (20, [1.0, 1.0]), (20, [-1.0, 2.0]), (3, [3.0, 3.0])]
    got = sorted(map(tuple, topk.top_k(frame(spark, data)).collect()))
    assert got == best(data) and (0, 1, 1, 64 * 192) in got


def test_top_k_of_few_rows(spark):
    assert topk.top_k(frame(spark, [])).collect() == []
    assert topk.top_k(frame(spark, [(0, [1.0])])).collect() == []
    big = [(0, [1.0, 1e7]), (1, [1.0, 1e7]), (1, [1.0, 1e7])]
    assert sorted(map(tuple, topk.top_k(frame(spark, big)).collect())) == [(0, n, 1, 4096 + (64 * 10**7) ** 2) for n in (1, 2)]


def test_the_cutoff_spares_work():
    g = np.random.default_rng(2)
    a, b = g.integers(-64, 64, (20, 16)), g.integers(-64, 64, (4000, 16)) // g.choice([1, 4, 8], (4000, 1))
    parts = topk.slices(a, b, 2)
    score = a @ b.T
    tau = np.sort(score, axis=1)[:, -20].astype(float)
    i, j = topk.sufficient(parts, tau, np.ones(score.shape, bool))
    found = np.zeros(score.shape, bool)
    found[i, j] = True
    assert found[score >= tau[:, None]].all() and found.mean() < 0.2


def linked(data):
    ok = [(i, np.array(v, float)) for i, v in data if i is not None and usable(v) and any(v)]
    d = max(len(v) for _, v in ok)
    x = np.array([np.pad(v, (0, d - len(v))) for _, v in ok])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -1)
    ids = [i for i, _ in ok]
    pairs = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(s >= 0.9))]
    return dict(zip(ids, (s >= 0.9).sum(1).tolist())), components(ids, pairs)


@pytest.mark.parametrize("members,visitors", [(1024, 2048), (5, 9)])
def test_near_duplicates_as_by_brute_force(spark, members, visitors):
    data = rows()
    n, root = linked(data)
    got = embeddings.near_duplicates(frame(spark, data), centroids=8, recall=1.0, members=members, visitors=visitors).collect()
    assert len(got) == len(data)
    for r in got:
        assert (r.n_links, r.component_id) == (n.get(r.vec_id, 0), root.get(r.vec_id, r.vec_id)), r
        assert r.kept == (r.vec_id == r.component_id)


def test_near_duplicates_of_rows_that_share_an_id(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    got = embeddings.near_duplicates(frame(spark, [(1, a), (1, b), (2, [1.0, 0.01, 0.0]), (3, a), (3, a)])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (1, 3, 1), (2, 3, 1), (3, 3, 1), (3, 3, 1)]


def test_recall_of_the_index(spark, sf_dir):
    r = random.Random(0)
    data = [(x.vec_id, x.embedding) for x in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    g = np.random.default_rng(0)
    for i in range(len(data)):
        v, side = np.array(data[i][1]), g.standard_normal(64)
        side -= side @ v * v
        c = r.uniform(0.9, 1)
        data.append((1000 + i, (c * v + math.sqrt(1 - c * c) * side / np.linalg.norm(side)).tolist()))
    n, _ = linked([(i, [float(np.float32(x)) for x in v]) for i, v in data])
    got = {x.vec_id: x.n_links for x in embeddings.near_duplicates(frame(spark, data)).collect()}
    assert all(got[i] <= n[i] for i in n) and sum(got.values()) >= 0.95 * sum(n.values())


@pytest.mark.parametrize("centroids,kind", [(64, "gauss"), (144, "gauss"), (512, "gauss"), (144, "clustered")])
def test_recall_on_vectors_that_the_codebooks_have_not_seen(centroids, kind):
    g, d = np.random.default_rng(3), 64
    centres = g.standard_normal((40, d))

    def drawn(n):
        x = g.standard_normal((n, d)) * (0.5 if kind == "clustered" else 1) + (centres[g.integers(0, 40, n)] if kind == "clustered" else 0)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    index = embeddings.Index(drawn(embeddings.EACH * centroids), 0.9, centroids, embeddings.RECALL)
    for lo, hi in ((0.9, 0.92), (0.9, 1.0)):
        x = drawn(600)
        side = g.standard_normal(x.shape)
        side -= (side * x).sum(1, keepdims=True) * x
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        c = g.uniform(lo, hi, (len(x), 1))
        y = c * x + np.sqrt(1 - c * c) * side
        found = np.minimum(index.rank(x, index.cells(y)), index.rank(y, index.cells(x))) < index.n
        assert found.mean() >= 0.95
    near = index.visits(x[:5], min(index.n, 300))
    for v, row in zip(x[:5], near):
        a, b = (embeddings.distances(h[None, :], book)[0] for h, book in zip((v[: d // 2], v[d // 2 :]), index.books))
        assert sorted(row.tolist()) == sorted((a[:, None] + b[None, :]).ravel().argsort(kind="stable")[: len(row)].tolist())


def test_query_on_a_table_with_planted_copies(spark, sf_dir, tmp_path):
    g = np.random.default_rng(4)
    data = [(x.vec_id, x.embedding) for x in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    for i in range(300):
        v, side = np.array(data[i % 60][1]), g.standard_normal(64)
        side -= side @ v / (v @ v) * v
        c = 1.0 if i % 3 == 0 else g.uniform(0.9, 1)
        data.append((5000 + i, (c * v + math.sqrt(1 - c * c) * np.linalg.norm(v) * side / np.linalg.norm(side)).tolist()))
    spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("label", F.lit(0)).write.parquet(f"{tmp_path}/embeddings.parquet")
    n, root = linked([(i, [float(np.float32(x)) for x in v]) for i, v in data])
    got = embeddings.op9_embeddings(spark, str(tmp_path)).collect()
    assert len(got) == len(data) and sum(n.values()) > 1000
    assert all(r.n_links <= n[r.vec_id] for r in got) and sum(r.n_links for r in got) >= 0.98 * sum(n.values())
    assert sum(r.component_id != root[r.vec_id] for r in got) <= 0.02 * len(got)


def test_near_duplicates_of_nothing(spark):
    assert embeddings.near_duplicates(frame(spark, [])).collect() == []
    assert [tuple(r) for r in embeddings.near_duplicates(frame(spark, [(4, None)])).collect()] == [(4, 0, 4, True)]


def test_queries(spark, sf_dir):
    assert topk.op2_topk(spark, sf_dir).count() == 25 * 20
    assert embeddings.op9_embeddings(spark, sf_dir).count() == 500
