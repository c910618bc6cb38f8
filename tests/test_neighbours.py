import numpy as np

from relvane.operators import neighbours


def test_nearest_as_by_brute_force(spark):
    r = np.random.default_rng(1)
    parts = {"plane": r.normal(0, 1, (300, 2)), "blobs": r.normal(0, 0.1, (200, 3)) + 5 * r.integers(0, 4, (200, 1)), "far": r.normal(0, 1, (90, 24)), "same": np.ones((60, 2)), "two": r.normal(0, 1, (2, 2)), "one": np.zeros((1, 2))}
    parts["blobs"][7] = parts["blobs"][150]
    rows = [(k, 5 * i + 2, v.tolist()) for k, x in parts.items() for i, v in enumerate(x)] + [("two", 900, None), (None, 1, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "k string, asset long, vec array<double>").repartition(4)
    want = {}
    for k, x in parts.items():
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
        np.fill_diagonal(d, np.inf)
        want |= {(k, 5 * i + 2): v for i, v in enumerate(d.min(1)) if np.isfinite(v)}
    for piece in (1024, 17):
        got = {(x.k, x.asset): x.dist for x in neighbours.nearest(df, ["k"], piece).collect()}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert neighbours.nearest(df.where("false"), ["k"]).collect() == []


def test_no_point_travels_more_often_in_larger_keys(spark, tmp_path, monkeypatch):
    """In many dimensions every cell is visited; how often a point is written for it does not grow with its key."""
    r, copies = np.random.default_rng(2), []
    kept = neighbours.kept
    for n in (500, 4000):
        rows = []

        def counted(df):
            out = kept(df)
            rows.append(out.count())
            return out

        monkeypatch.setattr(neighbours, "kept", counted)
        df = spark.createDataFrame([(0, i, v) for i, v in enumerate(r.normal(0, 1, (n, 32)).tolist())], "k int, asset long, vec array<double>")
        assert neighbours.nearest(df, ["k"]).count() == n
        copies.append(sum(rows) / n)
    assert copies[1] < 1.5 * copies[0] and copies[1] < 40
