"""Hard-negative mining (operator 13) by slot-decomposed selection.

An anchor's positives are its best rows of the same label. A positive of score s asks for the best rows of other labels with
scores in [s low / high, s]: windows that overlap. Their upper limits, the scores of the positives, split all scores into disjoint
slots: a row lies in slot c if c of the limits reach its score.

1. Rows and anchors are dealt into blocks, and each block of rows meets each block of anchors once, as a group of a cogroup. A
   group sends, for each anchor, its best rows of the same label, and the best of all groups are the positives.
2. The blocks meet again, now with the limits. A group is a combiner: of each slot it sends the first k rows.
3. The first k of each slot are all that any window needs: window i is answered by slots i, i + 1, ... in descending order, a suffix
   of the slots, of which the first k rows that reach the lower limit are taken. Rows below it end the suffix, so k before
   the limit are enough.

A group holds a block of each side; no anchor's rows meet anywhere but as the first few of each group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import bucket, stash, table
from .topk import finite

K, POSITIVES, SCALE, LOW, HIGH, EVERY = 5, 5, 256, 80, 100, 100
#: Rows and anchors of a block, and scores that a group computes at once.
ROWS, ANCHORS, SCORES = 16384, 16384, 1 << 21


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, q): floor(scale * component), of the rows that take part."""
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding")
    return vectors.where(ok).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), q.alias("q"))


def matrix(column, d: int) -> np.ndarray:
    """The rows of an Arrow column of lists, padded with zeros to d columns."""
    column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), d), np.int64)
    out[np.arange(d)[None, :] < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def width(column) -> int:
    return int(np.diff(column.combine_chunks().offsets.to_numpy()).max(initial=0))


def first(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """The places of the first k of each anchor and slot: the highest scores, ties to the smaller id."""
    order = np.lexsort((vec, -score, slot, anchor))
    a, s = anchor[order], slot[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])] if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


def leading(scores: np.ndarray, allowed: np.ndarray, vec: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first k allowed scores of each line. The columns must be in the order of their ids, so that ties go to the first."""
    none = np.iinfo(np.int64).min
    s = np.where(allowed, scores, none)
    if s.shape[1] > k:
        least = np.partition(s, -k, axis=1)[:, -k][:, None]
        above, level = s > least, s == least
        allowed = allowed & (above | (level & (level.cumsum(1) <= k - above.sum(1)[:, None])))
    return np.nonzero(allowed)


def meeting(rows: DataFrame, anchors: DataFrame, work, size: int, asked: int) -> DataFrame:
    """(anchor, slot, vec_id, score) that work sends for each block of rows with each block of anchors."""
    n = max(1, -(-rows.count() // size))
    m = max(1, -(-anchors.count() // asked))
    left = rows.withColumn("r", bucket(F.col("row"), n=n)).withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    right = anchors.select(*[F.col(c).alias(f"_{c}") for c in anchors.columns], bucket(F.col("row"), n=m).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("r"))  # names of their own, as both sides may be one table

    def run(left, right):
        import pyarrow as pa

        right = right.rename_columns([c.removeprefix("_") for c in right.column_names])
        out = [(np.zeros(0, np.int64),) * 4]
        if len(left) and len(right):
            left = left.sort_by([("vec_id", "ascending"), ("row", "ascending")])
            d = max(width(left["q"]), width(right["q"]), 1)
            x, y = matrix(left["q"], d), matrix(right["q"], d)
            exact = int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0)) * d < 2**53
            x = (x.astype(np.float64) if exact else x).T  # exact as doubles, and faster
            columns = {c: left[c].to_numpy() for c in ("row", "vec_id", "label")}
            step = max(1, SCORES // max(1, len(left)))
            for s in range(0, len(right), step):
                part = right.slice(s, step)
                scores = (y[s : s + step].astype(x.dtype) @ x).astype(np.int64)
                out.append(work(scores, columns, part))
        return pa.table([np.concatenate(x) for x in zip(*out)], ["anchor", "slot", "vec_id", "score"])

    return left.groupBy("a", "r").cogroup(right.groupBy("a", "r")).applyInArrow(run, "anchor long, slot long, vec_id long, score long")


def hard_negatives(vectors: DataFrame, k: int = K, positives: int = POSITIVES, every: int = EVERY, low: int = LOW, high: int = HIGH, scale: int = SCALE, size: int = ROWS, asked: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of a table (vec_id, label, embedding).

    Anchors are the rows whose vec_id is divisible by `every`; a row's score is its inner product with the anchor, both floored after scaling. Of
    each anchor's first `positives` other rows of its label, the first k rows of other labels with low * positive_score <= high *
    negative_score <= high * positive_score. Ties go to the smaller vec_id. A negative positive_score has an empty window.

    Rows without id or label, and vectors that are null or hold null or non-finite components, take no part. Rows that share an id are rows
    of their own, as anchors too; a row is never its own positive. Shorter vectors count as padded with zeros. Scores times
    `high` must fit in 64 bits.
    """
    rows = stash(usable(vectors, scale))
    anchors = rows.where(F.col("vec_id") % every == 0)

    def lead(scores, columns, part):
        same = columns["label"][None, :] == part["label"].to_numpy()[:, None]
        other = columns["row"][None, :] != part["row"].to_numpy()[:, None]
        i, j = leading(scores, same & other, columns["vec_id"], positives)
        return part["row"].to_numpy()[i], np.zeros(len(i), np.int64), columns["vec_id"][j], scores[i, j]

    best = W.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    sent = meeting(rows, anchors, lead, size, asked)
    chosen = stash(sent.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives).select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    limits = chosen.groupBy("anchor").agg(F.reverse(F.array_sort(F.collect_list("positive_score"))).alias("limits"))  # at most `positives`
    limited = stash(anchors.join(limits, F.col("row") == F.col("anchor")).drop("anchor"))

    def combine(scores, columns, part):
        own = part["limits"].combine_chunks()
        count = np.diff(own.offsets.to_numpy())
        limit = np.full((len(part), max(1, count.max(initial=0))), np.iinfo(np.int64).min)
        limit[np.arange(limit.shape[1])[None, :] < count[:, None]] = own.flatten().to_numpy()
        lowest = np.take_along_axis(limit, np.maximum(count - 1, 0)[:, None], 1)
        other = columns["label"][None, :] != part["label"].to_numpy()[:, None]
        i, j = np.nonzero(other & (scores <= limit[:, :1]) & (high * scores >= low * np.minimum(lowest, limit[:, :1])))
        s = scores[i, j]
        slot = (limit[i] >= s[:, None]).sum(1)
        least = limit[i, slot - 1]  # the lowest limit of the windows that slot belongs to
        near = high * s >= low * least
        i, j, s, slot = i[near], j[near], s[near], slot[near]
        keep = first(i, slot, s, columns["vec_id"][j], k)
        return part["row"].to_numpy()[i[keep]], slot[keep].astype(np.int64), columns["vec_id"][j[keep]], s[keep]

    best = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    sent = meeting(rows, limited, combine, size, asked).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    slots = sent.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id", "slot"))).alias("slots"))  # at most k a slot
    suffix = F.slice(F.filter("slots", lambda x: x["slot"] >= F.col("place")), 1, k)
    window = F.filter(suffix, lambda x: -x["less"] * high >= F.col("positive_score") * low)
    found = chosen.join(slots, "anchor").select("anchor", "positive_id", "positive_score", F.posexplode(window).alias("rank", "x"))
    ids = limited.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(ids, "anchor").select("anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("negative_id"), "positive_score", (-F.col("x.less")).alias("negative_score"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of rows whose vec_id is divisible by 7 are moved on by one of ten first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


OP13_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as q from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.q, b.q) as bigint) as score from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select * from (select anchor_id, vec_id as positive_id, score as positive_score, row_number() over (partition by anchor_id order by score desc, vec_id) as place from s where same) t where place <= 5),
n as (select anchor_id, positive_id, s.vec_id as negative_id, positive_score, score as negative_score, row_number() over (partition by anchor_id, positive_id order by score desc, s.vec_id) as rank
  from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""
