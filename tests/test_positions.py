"""Positions of keys that are cut into pieces, against a loop over the rows."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from relvane.operators import pairs
from relvane.params import Trade

TRADES = [Trade(8, 1.0, 0.25, 3.0, 8), Trade(8, 1.0, 0.25, None, None), Trade(8, 0.5, 0.5, 2.0, 3), Trade(8, 2.0, -0.5, 1.0, 0)]


def plain(z, s):
    out, pos, hold = [], 0, 0
    for v in z:
        if v is None or math.isnan(v):
            pos, hold = 0, 0
        elif pos == 0:
            pos = -1 if v > s.enter else 1 if v < -s.enter else 0
            hold = abs(pos)
        elif v * pos > -s.leave or (s.stop is not None and v * pos < -abs(s.stop)) or (s.hold and hold >= s.hold):
            pos, hold = 0, 0
        else:
            hold += 1
        out.append(pos)
    return out


def drifting(r, n):
    """z that stays on one side for long, so that pieces are entered with a position."""
    out, v = [], 0.0
    for _ in range(n):
        v = 0.97 * v + r.gauss(0, 0.35)
        out.append(None if r.random() < 0.004 else v)
    return out


def test_series_in_step_are_walked_as_alone():
    r = random.Random(1)
    for s in TRADES:
        z = [drifting(r, r.choice([0, 1, 5, 60, 200])) for _ in range(40)]
        arrays = [np.array([math.nan if v is None else v for v in x], float) for x in z]
        got, _ = pairs.walked(arrays, np.zeros((40, 1), int), s, True)
        assert [g.tolist() for g in got] == [plain(x, s) for x in z]
        starts = np.array([0, *(x for h in range(1, (s.hold or 1) + 1) for x in (h, -h))])
        _, after = pairs.walked(arrays, np.tile(starts, (40, 1)), s, False)
        for k, x in enumerate(arrays):  # a map of states is the same in two parts
            cut = len(x) // 3
            _, a = pairs.walked([x[:cut]], starts[None, :], s, False)
            _, b = pairs.walked([x[cut:]], starts[None, :], s, False)
            at = {v: n for n, v in enumerate(starts.tolist())}
            assert after[k].tolist() == [b[0][at[v]] for v in a[0].tolist()]


def test_keys_in_many_pieces(spark):
    r = random.Random(2)
    series = {"long": drifting(r, 6000), "short": drifting(r, 20), "none": [None] * 5, "one": [3.0], **{f"k{i}": drifting(r, 30) for i in range(40)}}
    df = spark.createDataFrame([(k, i, v) for k, x in series.items() for i, v in enumerate(x)], "k string, dt int, z double").repartition(5)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for s in TRADES:
            got = {}
            for x in pairs.positions(df, ["k"], s).collect():
                got.setdefault(x.k, {})[x.dt] = (x.z, x.position)
            assert {k: [x[i] for i in range(len(x))] for k, x in got.items()} == {k: list(zip(x, plain(x, s))) for k, x in series.items()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert pairs.positions(df.where("false"), ["k"]).collect() == []
    assert pairs.positions(df.withColumn("dt", F.timestamp_seconds("dt")), ["k"]).count() == df.count()
