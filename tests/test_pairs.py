import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from relvane.operators import pairs


def test_pairs_of_a_label_are_several_pieces_of_work(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 8)
    rows = [(0, i, 3) for i in range(90)] + [(0, 5, 3), (0, 200, -1), (0, 201, None), (0, None, 3), (0, 300, 4), (0, 301, 4)]
    got = pairs.combinations(spark.createDataFrame(rows, "k int, asset long, label int"), ["k"]).withColumn("part", F.spark_partition_id()).collect()
    want = [(0, label, a, b) for label in (3, 4) for a, b in itertools.combinations(sorted(x[1] for x in rows if x[2] == label and x[1] is not None), 2) if a < b]
    assert sorted((r.k, r.label, r.a, r.b) for r in got) == sorted(want)
    assert len({r.part for r in got if r.label == 3}) == 4


def test_distances_of_blocks_equal_those_of_pairs(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [("x", i, v) for i, v in enumerate(r.normal(0, 1, (70, 5)).astype(np.float32).tolist())]
    rows += [("x", 3, [1.0] * 5), ("x", 900, None), ("x", 901, [1.0, None, 1.0, 1.0, 1.0]), ("x", 902, [1.0]), ("x", None, [1.0]), (None, 1, [1.0]), ("y", 1, []), ("y", 2, []), ("y", 3, [float("nan")]), ("y", 4, [2.0]), ("z", 1, [0.0])]
    df = spark.createDataFrame(rows, "k string, asset long, vec array<float>")
    v = F.col("vec").cast("array<double>")
    both = df.select("k", F.col("asset").alias("a"), v.alias("u")).join(df.select("k", F.col("asset").alias("b"), v.alias("w")), "k").where("a < b")
    want = sorted(map(str, both.select("k", "a", "b", F.round(pairs.distance("u", "w"), 6).alias("dist")).collect()))
    for block in (pairs.BLOCK, 7):
        monkeypatch.setattr(pairs, "BLOCK", block)
        got = pairs.distances(df, ["k"], 6).withColumn("part", F.spark_partition_id()).collect()
        assert sorted(str(x).replace(f", part={x.part})", ")") for x in got) == want
    assert len({x.part for x in got if x.k == "x"}) == 4


def test_halves_are_rounded_as_spark_does(spark):
    x = [0.0, 1.0000005, 2.5e-7, 0.1234565, 123456.1234565, 7.0000015, math.inf, 3e12, 0.9999995, 1e-9]
    want = [r.y for r in spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x double").select("i", F.round("x", 6).alias("y")).orderBy("i").collect()]
    assert pairs.rounded(np.array(x), 6).tolist() == want and np.isnan(pairs.rounded(np.array([np.nan]), 6)[0])


def test_vectors_travel_a_few_times(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 2)
    seen, whole = [], pairs.dealt
    monkeypatch.setattr(pairs, "dealt", lambda df, *keys: seen.append(df.count()) or whole(df, *keys))
    for rows, times in (([(k, i) for k in range(10) for i in range(60)], 3), ([(0, i) for i in range(600)], 8)):
        df = spark.createDataFrame(rows, "k int, asset long").withColumn("vec", F.array(F.col("asset").cast("double")))
        got = pairs.distances(df, ["k"], 6)
        assert seen.pop() <= times * len(rows)
        assert got.count() == sum(n * (n - 1) // 2 for n in np.bincount([k for k, _ in rows]).tolist())
    monkeypatch.setattr(pairs, "COMPONENTS", 50)  # a block of wide vectors has few rows
    pairs.distances(df, ["k"], 6)
    assert seen.pop() > 10 * len(rows)
