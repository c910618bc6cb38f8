"""Exact top-k search by three phases with a uniform threshold (operator 2; after Cao and Wang, 2004).

A vector's coordinates fall into `lists` slices, and a slice's inner product is a list's score: a row's score is the sum over the
lists. Rows and queries are dealt into blocks, and each block of rows meets each block of queries.

1. A block gathers the local scores of the first list and completes those of its leaders. It sends, for each query, the k best of
   these: scores of different rows, so the k-th best of all blocks is a safe cutoff.
2. The cutoff of each query goes to all blocks. A row whose score reaches it has a list score of at least cutoff / lists, the
   uniform threshold. By the product of the lengths only rows of some length can have that in a list: a list is
   gathered for these alone, and the entries that reach the threshold are sufficient.
3. Only these entries are resolved: their scores are added up exactly, those that reach the cutoff are sent, and the first k of each query stay.

No step gathers a query's rows: a block sends at most k scores in phase 1 and what reaches the cutoff in phase 3.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import bucket, cut, table

K, LISTS, ROWS, QUERIES, EVERY = 20, 2, 8192, 4096, 20
#: Queries that are scored at once, and entries that are resolved at once.
PART, PAIRS = 256, 1 << 16


def finite(c: str):
    return F.col(c).isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(row, vec_id, q): a number of the row, and floor(scale * component). Rows without an id, and vectors that are null or hold null or non-finite
    components, are left out."""
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & finite("embedding")).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """One row for each block of about `size` rows: (name, list of its rows)."""
    n = max(1, -(-rows.count() // size))
    return rows.groupBy(bucket(F.col("row"), n=n).alias(f"{name}_block")).agg(F.collect_list(F.struct(*rows.columns)).alias(name)), n


def matrix(column, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, ids, vectors) of row k of a column of blocks; short vectors are padded with zeros."""
    block = column.slice(k, 1).flatten()
    q = block.field("q")
    size = np.diff(q.offsets.to_numpy())
    flat = q.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat
    return block.field("row").to_numpy(), block.field("vec_id").to_numpy(), out


def slices(a: np.ndarray, b: np.ndarray, lists: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows of a and b by slice of the coordinates, as numbers whose inner products are exact."""
    d = max(a.shape[1], b.shape[1], 1)
    a, b = (np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (a, b))
    if int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * d < 2**53:
        a, b = a.astype(np.float64), b.astype(np.float64)  # exact, and faster
    at = [d * i // lists for i in range(lists + 1)]
    return [(a[:, s:e], b[:, s:e]) for s, e in zip(at, at[1:])]


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


def totals(parts: list[tuple[np.ndarray, np.ndarray]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scores of the pairs of rows i and j over all lists."""
    out = np.zeros(len(i), np.int64)
    for s in range(0, len(i), PAIRS):
        x, y = i[s : s + PAIRS], j[s : s + PAIRS]
        out[s : s + PAIRS] = sum((a[x] * b[y]).sum(1) for a, b in parts)
    return out


def sufficient(parts: list[tuple[np.ndarray, np.ndarray]], tau: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that reach tau / lists in some list, among them all whose scores reach tau."""
    enough = np.zeros(allowed.shape, bool)
    for a, b in parts:
        least = (tau / len(parts))[:, None]
        la, lb = lengths(a), lengths(b)
        order = np.argsort(-lb)
        # lengths from which a query's threshold is out of reach; a little more than it takes, as they are rounded
        most = (la[:, None] * lb[order][None, :] * (1 + 1e-9) + 1e-6 >= least).sum(1).max(initial=0)
        some = order[:most]
        enough[:, some] |= a @ b[some].T >= least
    return np.nonzero(enough & allowed)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, lists: int = LISTS, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by `every`, its k rows of the highest score.

    Ties go to the smaller vec_id. Rows that share a vec_id are rows of their own: each is a query with a list of its own, and a candidate of all
    rows but itself. Vectors of other lengths count as padded with zeros.
    """
    q = cut(quantised(vectors))
    asked = q.where(F.col("vec_id") % every == 0)
    rb, _ = blocks(q, rows, "r")
    rb = cut(rb)

    def meet(asked: DataFrame, work, shape: str) -> DataFrame:
        qb, n = blocks(asked, queries, "a")
        pairs = rb.withColumn("a_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(qb, "a_block").select("r", "a")

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                for i in range(batch.num_rows):
                    rows, ids, v = matrix(batch.column("r"), i)
                    own, own_ids, a = matrix(batch.column("a"), i)
                    block = batch.column("a").slice(i, 1).flatten()
                    tau = block.field("tau").to_numpy(zero_copy_only=False) if "tau" in names else np.zeros(len(own))
                    for s in range(0, len(own), PART):
                        x, y = (own[s : s + PART], own_ids[s : s + PART]), slices(a[s : s + PART], v, lists)
                        out = work(x, ids, y, x[0][:, None] != rows[None, :], np.nan_to_num(tau[s : s + PART].astype(np.float64), nan=-np.inf))
                        yield pa.RecordBatch.from_arrays([pa.array(z) for z in out], [f"c{j}" for j in range(len(out))])

        names = asked.columns
        return pairs.mapInArrow(run, shape)

    def lead(own, ids, parts, allowed, tau):
        a, b = parts[0]
        first = np.where(allowed, a @ b.T, -np.inf if a.dtype == np.float64 else np.iinfo(np.int64).min)
        j = np.argpartition(-first.astype(np.float64), min(k, len(ids)) - 1, axis=1)[:, :k]
        i = np.repeat(np.arange(len(own[0])), j.shape[1])
        j = j.ravel()
        i, j = i[allowed[i, j]], j[allowed[i, j]]
        return own[0][i], totals(parts, i, j)

    def collect(own, ids, parts, allowed, tau):
        i, j = sufficient(parts, tau, allowed)
        exact = totals(parts, i, j)
        keep = exact >= tau[i]
        return own[0][i[keep]], own[1][i[keep]], ids[j[keep]], exact[keep]

    sent = meet(asked, lead, "query long, score long")
    best = sent.withColumn("n", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score")))).where(F.col("n") <= k)
    cutoffs = best.where(F.col("n") == k).select(F.col("query").alias("row"), F.col("score").alias("tau"))
    asked = cut(asked.join(cutoffs, "row", "left").select("row", "vec_id", "q", "tau"))
    found = meet(asked, collect, "query long, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
with q as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as double)) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id as vec_id, cast(list_dot_product(a.q, b.q) as bigint) as score from q a join q b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""
