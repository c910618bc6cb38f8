"""Embedding near-dedup by an inverted multi-index (operator 9; Babenko and Lempitsky, 2012).

Independent codebooks on the two halves of the vectors, of length 1 each, form a grid of cells; every vector is in the cell of its
nearest two centroids. Multi-sequence traversal visits the cells nearest to a vector, in order of the sum of the
distances of the halves, as many as reach the target recall; what it finds there is verified by the exact cosine.

The codebooks grow with the table, so that a cell keeps about as many members, and the bounded sample that they are fitted on with them. The number
of visits is fitted on vectors held out of it, with neighbours planted just above the threshold, so the recall holds for vectors that
the codebooks haven't seen and does not depend on how many near copies a sample happens to hold. Equal vectors are one vector with a count, and go by a number of their own, not by vec_id. Vectors
travel in the type they came in and are compared in double precision. A cell's members and visitors meet in chunks of
bounded size, which return counts and a spanning star, no pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, discard, stash, table
from .components import connected_components
from .lines import chain_last
from .simhash import unite
from .topk import finite

COSINE, SAMPLE, RECALL, MEMBERS, VISITORS = 0.9, 4096, 0.98, 1024, 2048
#: Vectors of the sample for each centroid, at least, and below which no visits can be fitted; held-out vectors, at most; and the part of the
#: cosines from the threshold to 1 in which neighbours are planted.
EACH, FEW, HELD, HARD = 86, 16, 2048, 0.2
#: Centroids of a half: as many as give about PER_CELL vectors a cell of the grid, between these bounds (a sample can't fit more).
PER_CELL, LEAST, MOST = 48, 16, 512


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (book * book).sum(1)[None, :] - 2 * x @ book.T, 0)


def codebook(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k-means centroids; an empty cluster keeps its place."""
    r = np.random.default_rng(0)
    book = x[r.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = distances(x, book).argmin(1)
        n = np.bincount(at, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, at, x)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


class Index:
    """Codebooks of the halves of vectors of `d` components, and the number of cells to visit.

    A quarter of the sample takes no part in the codebooks; the number of visits is what it needs to find neighbours planted near the threshold,
    where they are hardest to find. A sample too small for that has all cells of its small grid visited.
    """

    def __init__(self, sample: np.ndarray, cosine: float, centroids: int, recall: float):
        self.d = sample.shape[1]
        self.h = self.d // 2
        x, known = (sample, sample) if len(sample) < FEW * centroids else (sample[::4][:HELD], np.delete(sample, np.s_[::4], 0))
        self.books = [codebook(known[:, : self.h], centroids), codebook(known[:, self.h :], centroids)]
        self.n = len(self.books[0]) * len(self.books[1])
        if len(sample) < FEW * centroids:
            return
        r = np.random.default_rng(1)
        side = r.standard_normal(x.shape)
        side -= (side * x).sum(1, keepdims=True) * x
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
        c = r.uniform(cosine, cosine + HARD * (1 - cosine), (len(x), 1))
        y = c * x + np.sqrt(1 - c * c) * side
        ranks = np.minimum(self.rank(x, self.cells(y)), self.rank(y, self.cells(x)))
        self.n = min(self.n, int(np.quantile(ranks, recall, method="higher")) + 1)

    def rank(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How many cells come before the given one of each row."""
        d = [distances(x[:, : self.h], self.books[0]), distances(x[:, self.h :], self.books[1])]
        k = np.arange(len(x))
        own = d[0][k, cell // len(self.books[1])] + d[1][k, cell % len(self.books[1])]
        return np.array([np.searchsorted(np.sort(b), o - a).sum() for a, b, o in zip(*d, own)], np.int64)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return distances(x[:, : self.h], self.books[0]).argmin(1) * len(self.books[1]) + distances(x[:, self.h :], self.books[1]).argmin(1)

    def visits(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest cells of each row, nearest first: of the sorted lists of both halves, entries i and j (from 1)
        with i * j <= n are all that a traversal can reach in n steps."""
        d = [distances(x[:, : self.h], self.books[0]), distances(x[:, self.h :], self.books[1])]
        order = [y.argsort(1, kind="stable") for y in d]
        near = [np.take_along_axis(y, o, 1) for y, o in zip(d, order)]
        k, m = len(self.books[0]), len(self.books[1])
        i, j = (z.ravel() for z in np.meshgrid(np.arange(k), np.arange(m), indexing="ij"))
        ok = (i + 1) * (j + 1) <= n
        i, j = i[ok], j[ok]
        first = (near[0][:, i] + near[1][:, j]).argsort(1, kind="stable")[:, :n]
        return order[0][np.arange(len(x))[:, None], i[first]] * m + order[1][np.arange(len(x))[:, None], j[first]]


def unit(flat: np.ndarray, offsets: np.ndarray, d: int) -> np.ndarray:
    """Vectors of length 1 and d components, shorter ones padded with zeros."""
    size = np.diff(offsets)
    out = np.zeros((len(size), d))
    out[np.arange(d)[None, :] < size[:, None]] = flat
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def fit(reps: DataFrame, cosine: float, centroids: int | None, sample: int, recall: float) -> Index | None:
    """The index, from about `sample` vectors whose hashes are least; None for an empty table."""
    n, d = reps.agg(F.count("*"), F.max(F.size("v"))).first()
    if d is None:
        return None
    centroids = centroids or int(min(MOST, max(LEAST, (n / PER_CELL) ** 0.5)))
    cells, sample = 1 << 30, max(sample, EACH * centroids)  # at most EACH * MOST vectors
    least = F.pmod(F.xxhash64(F.lit(5), "rep"), F.lit(cells)) < int(min(1.0, sample / n) * cells) + cells // n
    rows = reps.where(least).orderBy(F.xxhash64(F.lit(5), "rep"), "rep").limit(sample).select("v").collect()  # about `sample` vectors, at most
    flat, offsets = np.concatenate([np.asarray(r.v, float) for r in rows]), np.r_[0, np.cumsum([len(r.v) for r in rows])]
    return Index(unit(flat, offsets, d), cosine, centroids, recall)


def groups(batches, keys: list[str]):
    """Tables of rows of one key each; the rows come sorted by the keys."""
    import pyarrow as pa

    rest = None
    for batch in chain_last(batches):
        now = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if now is None:
            return
        key = np.stack([now.column(c).to_numpy().astype(np.int64) for c in keys])
        at = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1]
        ends = np.r_[at[1:], len(now)]
        last = len(at) if batch is None else len(at) - 1
        for s, e in zip(at[:last].tolist(), ends[:last].tolist()):
            yield now.slice(s, e - s).combine_chunks()
        rest = now.slice(at[-1])


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, centroids: int | None = None, sample: int = SAMPLE, recall: float = RECALL, members: int = MEMBERS, visitors: int = VISITORS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of vectors.

    Vectors that are null, zero or hold null or non-finite components, and rows without vec_id, link with nothing. Shorter
    vectors count as padded with zeros. Rows that share a vec_id are vectors of their own with one name.
    """
    v = F.when(F.col("vec_id").isNotNull() & finite("embedding") & F.exists("embedding", lambda x: x != 0), F.col("embedding"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.withColumns({f"h{k}": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(k), "v")) for k in (1, 2)})
    reps = rows.where(F.col("v").isNotNull()).groupBy("h1", "h2").agg(F.min("v").alias("v"), F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    reps = stash(reps.withColumn("rep", F.monotonically_increasing_id()))  # numbers that stay, as they are written
    index = fit(reps, cosine, centroids, sample, recall)
    if index is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    shared = rows.sparkSession.sparkContext.broadcast(index)  # two codebooks of fixed size

    def place(batches):
        import pyarrow as pa

        ix = shared.value
        for batch in batches:
            step = max(16, min(2048, (1 << 22) // max(1, ix.n)))
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                col = part.column("v")
                x = unit(col.flatten().to_numpy(zero_copy_only=False), np.asarray(col.offsets) - col.offsets[0].as_py(), ix.d)
                seen = ix.visits(x, ix.n).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("copies"), pa.array(ix.cells(x).astype(np.int32)), pa.FixedSizeListArray.from_arrays(pa.array(seen.ravel()), seen.shape[1]).cast(pa.list_(pa.int32())), col], ["rep", "copies", "cell", "probes", "v"])

    kind = reps.schema["v"].dataType.simpleString()
    placed = stash(reps.select("rep", "copies", "v").mapInArrow(place, f"rep long, copies long, cell int, probes array<int>, v {kind}"))
    own = placed.select(F.col("cell").alias("at"), F.lit(0).alias("side"), "rep", "copies", "cell", "probes", "v")
    come = placed.select(F.explode("probes").alias("at"), F.lit(1).alias("side"), "rep", "copies", "cell", F.array().cast("array<int>").alias("probes"), "v")
    count = lambda df, n, name: df.groupBy("at").agg(F.ceil(F.count("*") / n).cast("int").alias(name))
    sizes = F.broadcast(count(own, members, "m").join(count(come, visitors, "w"), "at"))  # a row for each cell of the grid at most

    def chunks(df, mine, other, pick):
        x = df.join(sizes, "at").withColumn("x", F.pmod(F.xxhash64(F.lit(3), "rep"), F.col(mine)).cast("int")).withColumn("y", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return x.select("at", F.col(pick[0]).alias("i"), F.col(pick[1]).alias("j"), "side", "rep", "copies", "cell", "probes", "v")

    met = chunks(own, "m", "w", "xy").unionByName(chunks(come, "w", "m", "yx"))
    keys = ["at", "i", "j"]

    def compare(batches):
        import pyarrow as pa

        ix = shared.value
        for t in groups(batches, keys):
            side = t.column("side").to_numpy()
            ids, copies, cells = (t.column(c).to_numpy() for c in ("rep", "copies", "cell"))
            col = t.column("v").chunk(0)
            x = unit(col.flatten().to_numpy(zero_copy_only=False), np.asarray(col.offsets) - col.offsets[0].as_py(), ix.d)
            m, w = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(m) or not len(w):
                continue
            linked = (x[w] @ x[m].T >= cosine) & (ids[w][:, None] != ids[m][None, :])
            a, b = np.nonzero(linked)
            if not len(a):
                continue
            p = t.column("probes").chunk(0)
            size = np.diff(np.asarray(p.offsets))
            grid = len(ix.books[0]) * len(ix.books[1])
            sees = np.repeat(np.arange(len(ids)), size) * grid + p.flatten().to_numpy()
            alone = ~np.isin(m[b] * grid + cells[w[a]], sees)  # the member doesn't visit the visitor's cell: this is where it learns of it
            n = np.bincount(w[a], copies[m[b]], len(ids)) + np.bincount(m[b[alone]], copies[w[a[alone]]], len(ids))
            same = {}
            first = np.array([same.setdefault(k, i) for i, k in enumerate(ids.tolist())])  # a vector that visits its own cell is here twice
            root = unite(first.copy(), w[a], m[b])
            out = np.flatnonzero((n > 0) | (root != np.arange(len(ids))))
            yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(n[out].astype(np.int64)), pa.array(ids[root[out]])], ["rep", "n", "to"])

    found = stash(met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "rep long, n long, to long"))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = connected_components(found, "rep", "to")
    named = reps.drop("v").join(links, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rep"))
    named = cut(named.select("h1", "h2", "root", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    ids = cut(named.groupBy("root").agg(F.min("least").alias("component_id")))
    named = named.join(ids, "root").select("h1", "h2", "n_links", "component_id")
    out = rows.select("vec_id", "h1", "h2").join(named, ["h1", "h2"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    discard(placed, found)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
