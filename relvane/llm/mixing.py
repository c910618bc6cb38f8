"""Mixing sources to target weights (operator 3); DataFrame functions only.

Slot i of the schedule gets the golden-ratio point frac(i / phi), in 31-bit integer arithmetic, and the
cumulative target weights map the point to a source: a low-discrepancy sequence, so any stretch of the schedule
holds each source in about its share. The r-th slot of a source takes block r of that source: its documents in
a shuffled order, as one stream of words, cut into blocks of `block` words. A source's slots past its target are left
empty, slots that it lacks follow at the end, and its last block stops at the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD, cut, free, ranked, table

#: The weights of sources in order of code points, repeated; share of all words to take; most times a word is taken.
WEIGHTS, SHARE, EPOCHS, BLOCK, SEED = (5, 2, 1), 1.5, 2, 2048, "mix"
#: Tables of a row for each source are broadcast up to so many sources.
SOURCES = 100_000
#: The schedule's points are multiples of 1 / MODULUS; GOLDEN is MODULUS / phi to the next odd number.
MODULUS, GOLDEN, CELLS = 2**31, 1327217885, 1024


def sizes(docs: DataFrame) -> DataFrame:
    """docs' doc_id and source with size, the number of words (null text: 0), and a hash of the text."""
    return docs.select(F.xxhash64(F.col("text").cast("string")).alias("hash"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, weight, target): one row for each source, so sums of sources meet here and no documents.

    Targets share `share` of all words by weight; none is above `epochs` times its source's size, the excess going
    to the others by weight: target = min(cap, level * weight). With sources in order of cap / weight, the
    level is the first (budget - caps before) / (weights from here on) that is below the source's own ratio.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * float(epochs)
    order = W.orderBy("ratio", F.col("source").asc_nulls_last())
    by = by.withColumn("cap", cap).withColumn("ratio", cap / F.col("weight"))
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by = by.withColumn("left", F.sum("source_size").over(whole) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    by = by.withColumn("here", F.col("left") / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    level = F.min(F.when(F.col("here") <= F.col("ratio"), F.struct("ratio", "here"))).over(whole)["here"]
    by = by.withColumn("level", level)
    return by.select("source", "source_size", "weight", F.round(F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))), 6).alias("target"))


def few(sources: DataFrame) -> DataFrame:
    """A table of a row for each source, marked for a broadcast if it is small."""
    return F.broadcast(sources) if sources.count() <= SOURCES else sources


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source, rank): the order of the mix; a source has as many ranks as blocks of words up to its target."""
    spark = targets.sparkSession
    goal = F.round("target").cast("long")
    t = targets.select("source", goal.alias("goal"), F.ceil(goal / block).cast("long").alias("need"))
    every = W.orderBy(F.col("source").asc_nulls_last())
    t = t.withColumn("to", F.sum("goal").over(every.rowsBetween(W.unboundedPreceding, 0))).withColumn("all", F.sum("goal").over(W.partitionBy()))
    t = t.withColumn("lo", (F.col("to") - F.col("goal")) / F.col("all") * MODULUS).withColumn("hi", F.col("to") / F.col("all") * MODULUS)
    t = cut(t.where(F.col("need") > 0))
    n = t.agg(F.sum("need")).first()[0] or 0
    cell = MODULUS // CELLS
    spans = t.select("source", "lo", "hi", "need", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor(F.col("hi") / cell))).alias("cell"))
    slots = spark.range(n).select(F.col("id").alias("slot"), (F.col("id") % MODULUS * GOLDEN % MODULUS).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") / cell)).join(spans, "cell").where((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
    slots = slots.select("slot", "source", "need", F.floor(F.col("slot") / 65536).alias("bucket"))
    slots = ranked(slots, ["source"], ["slot"], "rank").select("slot", "source", "need", "rank")
    had = slots.groupBy("source").agg(F.count("*").alias("had")).select(F.col("source").alias("_s"), "had")
    lacks = t.join(had, t["source"].eqNullSafe(F.col("_s")), "left").where(F.coalesce("had", F.lit(0)) < F.col("need"))
    lacks = lacks.select(F.lit(n).alias("slot"), "source", F.explode(F.sequence(F.coalesce("had", F.lit(0)), F.col("need") - 1)).alias("rank"))
    return slots.where(F.col("rank") < F.col("need")).select("slot", "source", "rank").unionByName(lacks)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block: int = BLOCK, seed: str = SEED) -> DataFrame:
    """The mix: (slot, source, rank, doc_id, hash, size, source_size, target, row, epoch, first, words), a row for each piece
    of a document in a block: `words` words from word `first` of the text on. slot is the block's place in the mix.

    Documents that the mix leaves out have one row with null slot and 0 words, as have those without words.
    Rows that share a doc_id are documents of their own; `row` tells them apart. A null source is a source. Two runs agree.
    """
    rows = sizes(docs).withColumn("key", F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"))))
    rows = cut(rows.withColumn("bucket", F.conv(F.substring("key", 1, 3), 16, 10).cast("int")))
    targets = cut(source_targets(rows, weights, share, epochs))
    order = ["key", F.col("doc_id").asc_nulls_first(), "size", "hash"]
    rows = ranked(ranked(rows, ["source"], order, "start", F.col("size")), ["source"], order, "row")
    t = few(targets.withColumnRenamed("source", "_s"))
    rows = rows.join(t, rows["source"].eqNullSafe(F.col("_s"))).withColumn("goal", F.round("target").cast("long"))
    at = F.col("epoch") * F.col("source_size") + F.col("start")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn("from", at).withColumn("to", F.least("goal", F.col("from") + F.col("size")))
    rows = rows.withColumn("rank", F.explode(F.when(F.col("to") > F.col("from"), F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))).when(F.col("epoch") == 0, F.array(F.lit(None).cast("long"))).otherwise(F.array().cast("array<bigint>"))))
    low, high = F.greatest("from", F.col("rank") * block), F.least("to", (F.col("rank") + 1) * block)
    rows = rows.select("doc_id", "hash", "source", "size", "source_size", "target", "row", "epoch", "rank", (low - F.col("from")).alias("first"), (high - low).alias("words"))
    s = schedule(targets, block).select("slot", F.col("source").alias("_s"), F.col("rank").alias("_r"))
    rows = rows.join(s, rows["source"].eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r")), "left")
    taken = F.when(F.col("slot").isNotNull(), F.col("words")).otherwise(0)
    return rows.select("slot", "source", "rank", "doc_id", "hash", "size", "source_size", "target", "row", "epoch", "first", taken.cast("long").alias("words"))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """docs with each document once for each time that the mix takes any of its words, in the order of the slots; all columns stay.

    A copy stands where its first block stands. Documents without words and rows without a doc_id stay once, in front. Rows that share a
    doc_id are documents of their own; those that share source and text too are taken alike.
    """
    names = docs.columns
    ident, source, text, slots, ident2, source2, text2, slot = free(names, "id", "origin", "hash", "slots", "id2", "origin2", "hash2", "slot")
    keys = [F.col("doc_id").alias(ident2), F.col("source").alias(source2), F.col("hash").alias(text2)]
    copies = mix(docs, **params).groupBy("doc_id", "source", "hash", "row", "epoch").agg(F.min("slot").alias("slot"), F.sum("words").alias("words"), F.max("size").alias("size"))
    copies = copies.where((F.col("words") > 0) | (F.col("size") == 0) & (F.col("epoch") == 0) | (F.col("epoch") == 0))
    taken = copies.groupBy("doc_id", "source", "hash", "row").agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.when(F.col("words") > 0, F.col("slot")))).alias("slots"))
    taken = taken.groupBy(*keys).agg(F.min_by(F.when(F.col("size") > 0, F.col("slots")), "row").alias(slots)).where(F.col(ident2).isNotNull())
    own = docs.withColumns({ident: F.col("doc_id").cast("long"), source: F.col("source").cast("string"), text: F.xxhash64(F.col("text").cast("string"))})
    own = own.join(taken, (F.col(ident) == F.col(ident2)) & F.col(source).eqNullSafe(F.col(source2)) & (F.col(text) == F.col(text2)), "left")
    own = own.withColumn(slot, F.explode(F.coalesce(slots, F.array(F.lit(-1).cast("long")))))
    return own.repartitionByRange(slot).sortWithinPartitions(slot, ident, text).select(*names)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(table(spark, sf_dir, "documents"))
    rows = rows.groupBy("source", "row", "doc_id", "size", "source_size", "target").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot")


OP3_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size, md5(concat_ws('|', 'mix', cast(doc_id as varchar))) as k from documents),
by_source as (
  select source, sum(size) as source_size, [5.0::double, 2.0::double, 1.0::double][1 + cast((row_number() over (order by source nulls last) - 1) % 3 as integer)] as weight from sized group by source),
caps as (select *, source_size * 2.0::double as cap, source_size * 2.0::double / weight as ratio from by_source),
lefts as (
  select *, cast(sum(source_size) over () * 1.5::double - coalesce(sum(cap) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0) as double)
    / (sum(weight) over () - coalesce(sum(weight) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0)) as here from caps),
targets as (
  select source, cast(source_size as bigint) as source_size, round(least(cap, coalesce((select arg_min(here, ratio) from lefts where here <= ratio) * weight, cap)), 6) as target from lefts),
goals as (select source, source_size, target, cast(round(target) as bigint) as goal, cast(ceil(round(target) / 2048) as bigint) as need from targets),
spans as (
  select *, (sum(goal) over w - goal) / sum(goal) over () * 2147483648 as lo, sum(goal) over w / sum(goal) over () * 2147483648 as hi from goals where goal > 0
  window w as (order by source nulls last rows unbounded preceding)),
points as (select i as slot, i % 2147483648 * 1327217885 % 2147483648 as point from (select unnest(range((select cast(coalesce(sum(need), 0) as bigint) from spans))) as i) t),
drawn as (select slot, source, need, row_number() over (partition by source order by slot) - 1 as rank from points join spans on point >= lo and point < hi),
slots as (
  select slot, source, rank from drawn where rank < need
  union all
  select (select count(*) from points), s.source, unnest(range(coalesce(had, 0), need)) from spans s left join (select source, count(*) as had from drawn group by 1) d on s.source is not distinct from d.source),
starts as (
  select *, cast(coalesce(sum(size) over (partition by source order by k, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0) as bigint) as start from sized),
pieces as (
  select s.doc_id, s.source, s.k, size, source_size, target, e * source_size + start as lo, least(goal, e * source_size + start + size) as hi
  from starts s join goals g on s.source is not distinct from g.source cross join (values (0), (1)) v(e)),
ranks as (select *, unnest(case when hi > lo then range(lo // 2048, (hi - 1) // 2048 + 1) else [null] end) as rank from pieces)
select r.doc_id, cast(size as bigint) as size, source_size, target,
  cast(sum(case when hi > lo then least(hi, (r.rank + 1) * 2048) - greatest(lo, r.rank * 2048) else 0 end) as bigint) as taken, min(slot) as first_slot, max(slot) as last_slot
from ranks r left join slots s on r.source is not distinct from s.source and r.rank = s.rank
group by r.doc_id, r.source, r.k, size, source_size, target
"""
