"""Sharding by longest processing time (operator 6).

Documents with equal texts form a group that stays together. Groups, largest first, go to the least-loaded shard
through a heap. Groups of one size are interchangeable, so the heap works on (size, number of groups): there are at
most sqrt(2 * bytes) different sizes, however many groups there are.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket, cut, ranked, table

SHARDS = 16


def deal(loads: list[int], size: int, count: int) -> list[int]:
    """Groups of `size` that each shard gets when `count` of them go, one by one, to the least-loaded shard; loads are updated."""
    got = [0] * len(loads)
    if count > 4 * len(loads):  # all below a level are filled up to it at once
        low, high = min(loads), max(loads) + size * count
        below = lambda level: sum(max(0, -((x - level) // size)) for x in loads)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if below(mid) <= count else (low, mid - 1)
        got = [max(0, -((x - low) // size)) for x in loads]
    heap = [(x + size * g, i) for i, (x, g) in enumerate(zip(loads, got))]
    heapq.heapify(heap)
    for _ in range(count - sum(got)):
        load, i = heap[0]
        got[i] += 1
        heapq.heapreplace(heap, (load + size, i))
    for i, g in enumerate(got):
        loads[i] += size * g
    return got


def longest_first(classes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(bytes, ends): of the groups of a size, those with ranks from ends[i - 1] to ends[i] - 1 go to shard i."""

    def run(batches):
        import pyarrow as pa

        loads = [0] * shards
        for batch in batches:
            ends = []
            for size, count in zip(batch.column("bytes").to_pylist(), batch.column("n").to_pylist()):
                total, row = 0, []
                for g in deal(loads, size, count):
                    total += g
                    row.append(total)
                ends.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("bytes"), pa.array(ends, pa.list_(pa.int64()))], ["bytes", "ends"])

    one = classes.select("bytes", "n").repartition(1).sortWithinPartitions(F.desc("bytes"))
    return one.mapInArrow(run, "bytes long, ends array<long>")


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs, under the law "bytes".

    size is the UTF-8 length of the text and 1; a null text has length 0 and no checksum, and all null texts are a group.
    slot numbers a shard's documents from 0. Rows that share a doc_id are documents of their own. Other columns are left aside.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.coalesce(F.md5(text), F.lit("null")).alias("key"))
    rows = cut(rows)
    groups = cut(rows.groupBy("key").agg(F.sum("size").alias("bytes")))
    dealt = longest_first(groups.groupBy("bytes").agg(F.count("*").alias("n")), shards).withColumnRenamed("bytes", "_bytes")
    placed = ranked(groups.withColumn("bucket", bucket(F.col("key"))), ["bytes"], ["key"], "rank").join(dealt, F.col("bytes") == F.col("_bytes"))
    placed = cut(placed.select(F.col("key").alias("_key"), F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard")))
    out = rows.join(placed, rows["key"] == placed["_key"]).withColumn("bucket", bucket(F.col("doc_id"), F.col("key"), n=4096))
    out = ranked(out, ["shard"], [F.col("doc_id").asc_nulls_first(), "key"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
