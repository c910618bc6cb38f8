"""Density clusters of assets by their loadings, from the minimum spanning tree of each key.

With two points a core, the order in which density clustering visits the points is the traversal of a minimum spanning tree, and a point's
reachability the length of the edge that leads to it. So a tree is all that the last step needs:

1. Assets of equal vectors become one point.
2. The points of a key are dealt into blocks, and each two blocks meet in a group of their own, which keeps the minimum spanning tree of its
   points. An edge of the whole tree is one of the tree of every part that holds it, so no edge is lost.
3. What is left, a few edges a point and block, is merged to one tree, in parts where there are many blocks.
4. The tree is traversed and cut into clusters: one task a key, which holds its points and n - 1 edges.

A group holds two blocks and no matrix of distances. Points at exactly equal distances other than 0 may be visited in another order than by asset.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import kept
from .models import steep_clusters, visiting_order

#: Points of a block, and cells of blocks whose trees are merged at once.
BLOCK, CELLS = 2048, 64


def spanning(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, length) of the edges of a minimum spanning tree of points."""
    order, reach, before = visiting_order(x)
    return np.array(before[1:], int), np.array(order[1:], int), np.asarray(reach[1:])


def merged(i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of the edges of a minimum spanning forest among the edges given, shortest first (Kruskal)."""
    lo, hi = np.minimum(i, j), np.maximum(i, j)
    order = np.lexsort((hi, lo, length))
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while (u := root.get(v, v)) != v:
            root[v] = root.get(u, u)
            v = u
        return v

    keep = []
    for e, a, b in zip(order.tolist(), lo[order].tolist(), hi[order].tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(e)
    return np.array(keep, int)


def traversed(points: list[int], members: dict[int, list[int]], i: list[int], j: list[int], length: list[float]) -> tuple[list[int], np.ndarray, list[int]]:
    """(assets in the order of the visit, reachability, predecessors) from the smallest point on, always to the nearest point, ties to the smallest.

    The other members of a point follow it at distance 0.
    """
    ways: dict[int, list[tuple[float, int]]] = {p: [] for p in points}
    for a, b, d in zip(i, j, length):
        ways[a].append((d, b))
        ways[b].append((d, a))
    order, reach, before, seen = [], [], [], set()
    heap = [(np.inf, min(points), -1)] if points else []
    while heap:
        d, p, last = heapq.heappop(heap)
        if p in seen:
            continue
        seen.add(p)
        for n, asset in enumerate(members[p]):
            order.append(asset), reach.append(0.0 if n else d), before.append(p if n else last)
        for e, q in ways[p]:
            if q not in seen:
                heapq.heappush(heap, (e, q, p))
    return order, np.array(reach), before


def labelled(order: list[int], reach: np.ndarray, before: list[int], xi: float, least: int = 2) -> list[int]:
    """Labels from 0 in the order of the visit, -1 for noise; of clusters that share an asset the first counts."""
    out, label, at = [-1] * len(order), 0, {a: n for n, a in enumerate(order)}
    if len(order) < 2:
        return out
    for s, e in steep_clusters(reach, [*range(len(order))], [at.get(b, -1) for b in before], xi, least):
        if all(out[n] == -1 for n in range(s, e + 1)):
            out[s : e + 1] = [label] * (e + 1 - s)
            label += 1
    return out


def tree(points: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """(keys, i, j, length): few edges of each key's points (keys, asset, vec), the minimum spanning tree among them."""
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.select(*keys).schema)
    counts = points.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = points.join(counts, keys).withColumn("own", F.pmod(F.xxhash64("asset"), F.col("blocks")).cast("int")).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = dealt.select(*keys, "asset", "vec", F.least("own", "met").alias("lo"), F.greatest("own", "met").alias("hi"))

    def local(group):
        import pyarrow as pa

        group = group.sort_by("asset")
        x = np.stack(group["vec"].to_numpy()) if len(group) else np.zeros((0, 1))
        i, j, length = spanning(x) if len(x) > 1 else (np.zeros(0, int),) * 2 + (np.zeros(0),)
        asset = group["asset"].to_numpy()
        return pa.table([*[pa.array([group[k][0].as_py()] * len(i), group.schema.field(k).type) for k in keys], group["lo"].combine_chunks().take(pa.array(np.zeros(len(i), int))), group["hi"].combine_chunks().take(pa.array(np.zeros(len(i), int))), asset[i], asset[j], length], [*keys, "lo", "hi", "i", "j", "length"])

    edges = cells.groupBy(*keys, "lo", "hi").applyInArrow(local, f"{types}, lo int, hi int, i long, j long, length double")

    def fewer(group):
        return group.take(merged(group["i"].to_numpy(), group["j"].to_numpy(), group["length"].to_numpy()))

    part = F.pmod(F.xxhash64("lo", "hi"), F.greatest(F.lit(1), F.ceil(F.col("blocks") * (F.col("blocks") + 1) / 2 / CELLS))).cast("int")
    parts = edges.join(counts, keys).where("blocks > 1").withColumn("lo", part).drop("blocks")
    parts = parts.groupBy(*keys, "lo").applyInArrow(fewer, f"{types}, lo int, hi int, i long, j long, length double")
    single = edges.join(counts, keys).where("blocks = 1").drop("blocks")
    return single.unionByName(parts).select(*keys, "i", "j", "length")


def cluster(vectors: DataFrame, keys: list[str], xi: float = 0.05, block: int = BLOCK) -> DataFrame:
    """(keys, asset, label) of vectors (keys, asset, vec): density clusters with two points a core, for all keys in one job. A key's one asset is noise."""
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.select(*keys).schema)
    points = kept(vectors.groupBy(*keys, "vec").agg(F.min("asset").alias("asset"), F.array_sort(F.collect_list("asset")).alias("members")))
    edges = kept(tree(points.select(*keys, "asset", "vec"), keys, block))

    def last(edges, points):
        import pyarrow as pa

        ids = points["asset"].to_pylist()
        members = dict(zip(ids, points["members"].to_pylist()))
        i, j, length = (edges[c].to_numpy() for c in ("i", "j", "length")) if len(edges) else (np.zeros(0, int),) * 2 + (np.zeros(0),)
        keep = merged(i, j, length)
        order, reach, before = traversed(ids, members, i[keep].tolist(), j[keep].tolist(), length[keep].tolist())
        head = [pa.array([points[k][0].as_py()] * len(order), points.schema.field(k).type) for k in keys]
        return pa.table([*head, pa.array(order, pa.int64()), pa.array(labelled(order, reach, before, xi), pa.int32())], [*keys, "asset", "label"])

    named = points.select(*keys, "asset", "members")
    return edges.groupBy(*keys).cogroup(named.groupBy(*keys)).applyInArrow(last, f"{types}, asset long, label int")
