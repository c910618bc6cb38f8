import math
import random

import numpy as np
from pyspark.sql import functions as F

from relvane.llm import negatives


def frame(spark, data):
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>")
    return df.withColumns({k: F.lit(1) for k in ("q", "row", "r", "a", "slot", "anchor")}).repartition(3)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain(data, every=100, k=5, positives=5, low=80, high=100, scale=256):
    good = [(i, c, [math.floor(scale * float(np.float32(x))) for x in v]) for i, c, v in data if i is not None and c is not None and usable(v)]
    out = []
    for n, (i, c, a) in enumerate(good):
        if i % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), j, d) for m, (j, d, b) in enumerate(good) if m != n]
        for s, j, d in sorted(x for x in scores if x[2] == c)[:positives]:
            found = sorted(x for x in scores if x[2] != c and low * -s <= high * -x[0] <= high * -s)[:k]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(found)]
    return sorted(out)


def rows(seed=1, n=300, d=8):
    r, g = random.Random(seed), np.random.default_rng(seed)
    centres = g.standard_normal((4, d))
    out = [(i, r.randrange(4), (centres[r.randrange(4)] + 0.4 * g.standard_normal(d)).tolist()) for i in range(n)]
    out += [(n + i, i % 3, [0.5] * d) for i in range(90)]  # equal vectors of several labels, so ties
    out += [(900 + i, 1, v) for i, v in enumerate([None, [math.nan] * d, [None] * d, [math.inf] * d, [], [0.0] * d, [1.0, 2.0], [0.5] * d])]
    out += [(None, 1, [0.5] * d), (1000, None, [0.5] * d), (1000, 1, [0.5] * d), (1000, 2, [0.5] * d), (1100, 7, [0.5] * d), (-100, 2, [-0.5] * d)]
    return out


def test_windows_by_brute_force(spark):
    data = rows()
    for kwargs in ({}, {"every": 20, "size": 64, "asked": 3}, {"k": 200, "positives": 2, "every": 50}, {"low": 100, "every": 10}, {"low": 0, "k": 1, "every": 30}):
        got = negatives.hard_negatives(frame(spark, data), **kwargs)
        assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
        wanted = plain(data, **{k: v for k, v in kwargs.items() if k not in ("size", "asked")})
        assert wanted and sorted(map(tuple, got.collect())) == wanted


def test_many_small_cases(spark):
    r = random.Random(9)
    for _ in range(6):
        data = [(100 * i if r.random() < 0.3 else i, r.randrange(2), [r.randrange(-3, 4) / 4 for _ in range(2)]) for i in range(40)]
        got = negatives.hard_negatives(frame(spark, data), size=r.choice([5, 1000]), asked=r.choice([2, 1000]))
        assert sorted(map(tuple, got.collect())) == plain(data)


def test_few_rows(spark):
    for data in ([], [(0, 1, [1.0])], [(0, 1, [1.0]), (1, 2, [1.0])], [(0, 1, [1.0]), (1, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [1.0])]):
        assert negatives.hard_negatives(frame(spark, data)).collect() == []
    data = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.9])]
    assert list(map(tuple, negatives.hard_negatives(frame(spark, data)).collect())) == plain(data) == [(0, 1, 1, 2, 65536, 58880)]


def test_slots_are_all_that_windows_need():
    r = np.random.default_rng(2)
    anchor, slot, score, vec = r.integers(0, 5, 400), r.integers(0, 4, 400), r.integers(0, 20, 400), r.permutation(400)
    keep = negatives.first(anchor, slot, score, vec, 3)
    for a in range(5):
        for s in range(4):
            group = sorted((-score[i], vec[i]) for i in range(400) if (anchor[i], slot[i]) == (a, s))
            assert sorted((-score[i], vec[i]) for i in keep if (anchor[i], slot[i]) == (a, s)) == group[:3]


def test_large_numbers_stay_exact(spark):
    data = [(0, 1, [2.0**20, 1.0]), (1, 1, [2.0**20, 3.0]), (2, 2, [2.0**20, 2.0]), (3, 2, [2.0**20, 4.0])]
    got = sorted(map(tuple, negatives.hard_negatives(frame(spark, data)).collect()))
    assert got == plain(data) and got[0][3] == 2
