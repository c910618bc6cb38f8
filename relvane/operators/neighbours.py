"""Distance to the nearest other point of a key, exact, by pivots and the triangle inequality.

About CELLS of a key's points are pivots (fewer of small keys), and each point is in the cell of its nearest one. A point first meets its own cell, which bounds
its distance from above by b. A cell whose pivot is d away and whose members lie within r of it holds nothing nearer than d - r, so
only cells with d - r <= b are visited. Cells and their visitors meet in pieces of bounded size.

In many dimensions the bounds rule out little, and a point then visits every cell of its key. So there are few cells, and pieces grow with their key, PIECE to
LARGEST rows: up to CELLS * LARGEST points a key, what is written and shuffled is in proportion to the points.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import kept

#: Points of a piece: at least and, where a key has more than CELLS pieces, at most; rows of a piece that are compared at once.
PIECE, LARGEST, CELLS, STEP = 4096, 65536, 16, 512


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0))


def pieces(n, piece: int, most: int = CELLS // 2):
    """How many pieces n rows are: of `piece` rows, or `most` pieces of more rows, up to LARGEST / PIECE times as many."""
    return F.least(F.ceil(n / piece), F.greatest(F.lit(most), F.ceil(n / (piece * (LARGEST // PIECE))))).cast("int")


def vectors_of(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def nearest(vectors: DataFrame, keys: list[str], piece: int = PIECE) -> DataFrame:
    """(keys, asset, dist) for each row of vectors (keys, asset, vec) that has another one in its key; rows without a key or vector are left out."""
    points = vectors.dropna(subset=[*keys, "asset", "vec"]).select(*keys, F.col("asset").cast("long").alias("asset"), F.col("vec").cast("array<double>").alias("vec"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.select(*keys).schema)
    share = F.pmod(F.xxhash64("asset"), F.lit(1 << 30))
    counts = points.groupBy(*keys).agg(F.count("*").alias("n"), F.min(share).alias("least"))
    points = kept(points.join(counts.where("n > 1"), keys).withColumn("pivot", (share < (1 << 30) / F.greatest(F.sqrt("n"), F.col("n") / F.greatest(F.lit(CELLS), F.col("n") / LARGEST))) | (share == F.col("least"))).withColumn("pieces", F.ceil(F.col("n") / piece)).withColumn("piece", F.pmod(F.xxhash64(F.lit(1), "asset"), F.col("pieces")).cast("int")))
    pivots = points.where("pivot").select(*keys, "pieces", F.col("asset").alias("cell"), F.col("vec").alias("at"))

    def spread(pivots):
        """A copy of the pivots for each piece of their key's points."""
        return pivots.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces").cast("int") - 1))).drop("pieces").groupBy(*keys, "piece")

    def head(group, times):
        import pyarrow as pa

        return {k: group[k].combine_chunks().take(pa.array(np.zeros(times, int))) for k in keys}

    def settle(group, pivots):
        import pyarrow as pa

        if not len(group):
            return pa.table({**head(pivots, 0), "asset": pa.array([], pa.int64()), "vec": pa.array([], pa.list_(pa.float64())), "cell": pa.array([], pa.int64()), "off": pa.array([], pa.float64())})
        d = apart(vectors_of(group["vec"]), vectors_of(pivots["at"]))
        own = d.argmin(1)
        return pa.table({**head(group, len(group)), "asset": group["asset"], "vec": group["vec"], "cell": pivots["cell"].to_numpy()[own], "off": d[np.arange(len(d)), own]})

    placed = kept(points.select(*keys, "piece", "asset", "vec").groupBy(*keys, "piece").cogroup(spread(pivots)).applyInArrow(settle, f"{types}, asset long, vec array<double>, cell long, off double"))
    sizes = kept(placed.groupBy(*keys, "cell").agg(F.max("off").alias("radius"), pieces(F.count("*"), piece).alias("mine")))

    def compare(visitors, members):
        import pyarrow as pa

        if not len(visitors) or not len(members):
            return pa.table({**head(visitors, 0), "asset": pa.array([], pa.int64()), "dist": pa.array([], pa.float64())})
        x, y, a, b = vectors_of(visitors["v_vec"]), vectors_of(members["vec"]), visitors["v_asset"].to_numpy(), members["asset"].to_numpy()
        j, found = np.zeros(len(x), int), np.zeros(len(x), bool)
        for s in range(0, len(x), STEP):
            for t in range(0, len(y), 16 * STEP):
                d = apart(x[s : s + STEP], y[t : t + 16 * STEP])
                d[a[s : s + STEP, None] == b[None, t : t + 16 * STEP]] = np.inf
                k = d.argmin(1)
                least = d[np.arange(len(d)), k]
                if t:
                    better = least < best
                else:
                    better, best = np.ones(len(d), bool), np.full(len(d), np.inf)
                j[s : s + STEP][better], best = (t + k)[better], np.minimum(best, least)
            found[s : s + STEP] = np.isfinite(best)
        ok = np.flatnonzero(found)
        return pa.table({**head(visitors, len(ok)), "asset": a[ok], "dist": np.sqrt(((x[ok] - y[j[ok]]) ** 2).sum(1))})

    def met(visitors):
        """The least distance of each visitor (keys, asset, vec, cell) to the other members of the cell it visits."""
        come = visitors.groupBy(*keys, "cell").agg(pieces(F.count("*"), piece).alias("theirs"))
        both = sizes.join(come, [*keys, "cell"])
        part = lambda n: F.pmod(F.xxhash64(F.lit(2), "asset"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = visitors.join(both, [*keys, "cell"]).select(*keys, "cell", part("theirs").alias("i"), every("mine").alias("j"), F.col("asset").alias("v_asset"), F.col("vec").alias("v_vec"))
        right = placed.join(both, [*keys, "cell"]).select(*[F.col(c).alias(f"m_{c}") for c in (*keys, "cell")], every("theirs").alias("m_i"), part("mine").alias("m_j"), "asset", "vec")
        at = [*keys, "cell", "i", "j"]
        return left.groupBy(*at).cogroup(right.groupBy(*[f"m_{c}" for c in at])).applyInArrow(compare, f"{types}, asset long, dist double").groupBy(*keys, "asset").agg(F.min("dist").alias("dist"))

    bound = kept(placed.select(*keys, "asset", "vec", "cell").transform(met))
    bounded = placed.join(bound, [*keys, "asset"], "left").join(counts.select(*keys, F.ceil(F.col("n") / piece).alias("pieces")), keys).withColumn("piece", F.pmod(F.xxhash64(F.lit(1), "asset"), F.col("pieces")).cast("int"))
    cells = pivots.join(sizes.select(*keys, "cell", "radius"), [*keys, "cell"])

    def choose(group, cells):
        import pyarrow as pa

        if not len(group):
            return pa.table({**head(cells, 0), "asset": pa.array([], pa.int64()), "vec": pa.array([], pa.list_(pa.float64())), "cell": pa.array([], pa.int64())})
        d = apart(vectors_of(group["vec"]), vectors_of(cells["at"]))
        most = np.nan_to_num(group["dist"].to_numpy(zero_copy_only=False).astype(float), nan=np.inf)[:, None]
        near = (d - cells["radius"].to_numpy()[None, :] <= most * (1 + 1e-9) + 1e-7) & (group["cell"].to_numpy()[:, None] != cells["cell"].to_numpy()[None, :])
        i, j = np.nonzero(near)
        return pa.table({**head(group, len(i)), "asset": group["asset"].to_numpy()[i], "vec": group["vec"].combine_chunks().take(pa.array(i)), "cell": cells["cell"].to_numpy()[j]})

    visits = bounded.select(*keys, "piece", "asset", "vec", "cell", "dist").groupBy(*keys, "piece").cogroup(spread(cells)).applyInArrow(choose, f"{types}, asset long, vec array<double>, cell long")
    return bound.unionByName(kept(visits).transform(met)).groupBy(*keys, "asset").agg(F.min("dist").alias("dist"))
