import heapq
import zlib
from collections import Counter

from relvane.llm import sharding

from .brute import frame, odd_docs


def check(got, rows, shards=16):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for d, t in rows)
    assert {(r.law, r.grown_shard) for r in got} <= {("bytes", None)}
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(shards))
    groups = Counter()
    for _, t in rows:
        groups[t] += len((t or "").encode()) + 1
    heap = [(0, i) for i in range(shards)]
    for size in sorted(groups.values(), reverse=True):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
    loads = Counter({i: 0 for i in range(shards)})
    for r in got:
        loads[r.shard] += r.size
    assert sorted(loads.values()) == sorted(x for x, _ in heap)


def test_loads_as_by_a_plain_heap(spark):
    rows = odd_docs() + [(1000 + i, "same length %03d" % i) for i in range(300)]
    got = sharding.assign(frame(spark, rows, size=1, key="k", bucket=2, shard="s")).collect()
    check(got, rows)
    place = {}
    for r in got:
        place.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(x) == 1 for x in place.values())


def test_deal_equals_one_by_one():
    for loads, size, count in (([0] * 16, 7, 1000), ([5, 90, 3, 0], 4, 50), ([1, 2], 3, 1), ([10**12, 0, 5], 1, 77)):
        heap = [(x, i) for i, x in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(count):
            x, i = heap[0]
            heapq.heapreplace(heap, (x + size, i))
        own = list(loads)
        assert sum(sharding.deal(own, size, count)) == count
        assert sorted(own) == sorted(x for x, _ in heap)


def test_empty_table(spark):
    assert sharding.assign(frame(spark, [])).collect() == []


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(sharding.op6_sharding(spark, sf_dir).collect(), rows)
