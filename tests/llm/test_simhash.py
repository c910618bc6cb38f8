from itertools import combinations

import numpy as np
import xxhash

from relvane.llm import simhash

from .brute import components, frame, odd_docs, words


def slow_fingerprint(text):
    ws = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 4]).encode(), 42) for i in range(max(1, len(ws) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def expected(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    root = components(range(len(rows)), [(i, j) for i, j in combinations(range(len(rows)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(least.get(root[i], d), d)
    return sorted(((d, fps[i], least.get(root[i])) for i, (d, _) in enumerate(rows)), key=str)


def test_documents_link_as_by_brute_force(spark):
    rows = odd_docs()
    for limit in (simhash.LIMIT, 3):
        got = simhash.near_duplicates(frame(spark, rows, fp=1, a="x", node=2, source="s"), limit=limit).collect()
        assert sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got), key=str) == expected(rows)


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_keep_first_keeps_columns(spark):
    out = simhash.keep_first(frame(spark, odd_docs(), fp=1, source="s"))
    assert out.columns == ["doc_id", "text", "fp", "source"]
    ids = [r.doc_id for r in out.collect()]
    assert 80 in ids and not {81, 82, 83, 84} & set(ids) and len(ids) == len(set(ids))


def test_bit_sliced_pairs_equal_popcounts():
    r = np.random.default_rng(0)
    sizes = [1, 2, 3, 40, 64, 65, 130, 700]
    fps = np.concatenate([(r.integers(0, 2**63, dtype=np.uint64) ^ np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (n, 3), dtype=np.uint64), axis=1)) for n in sizes])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    for radius in (0, 2, 4, 7):
        got = {(i, j) for a, b in simhash.near_pairs(fps, starts, ends, radius) for i, j in zip(a.tolist(), b.tolist())}
        want = {(i, j) for s, e in zip(starts.tolist(), ends.tolist()) for i, j in combinations(range(s, e), 2) if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
        assert got == want


def test_query(spark, sf_dir):
    got = simhash.op1_simhash(spark, sf_dir).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=str) == expected(rows)
