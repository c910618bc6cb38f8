import math

import numpy as np
from pyspark.sql import functions as F

from relvane.operators import models, pairs, panel
from relvane.params import Trade


def test_positions_golden(spark):
    z = [None, 2.5, 3.0, 1.0, 0.4, 2.1, 4.5, 2.2, -2.5, -0.6, -0.4]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(z)], "k string, dt int, z double")
    got = [r.position for r in pairs.positions(df, ["k"], Trade(60, 2, 0.5, 4, None)).orderBy("dt").collect()]
    assert got == [0, -1, -1, -1, 0, -1, 0, -1, 0, 0, 0]


def test_positions_max_hold(spark):
    df = spark.createDataFrame([("k", i, 2.5) for i in range(7)], "k string, dt int, z double")
    assert [r.position for r in pairs.positions(df, ["k"], Trade(60, 2, 0.5, None, 3)).orderBy("dt").collect()] == [-1, -1, -1, 0, -1, -1, -1]


def test_ols_golden(spark):
    df = spark.createDataFrame([("k", i, float(y), float(x)) for i, (x, y) in enumerate(zip([1, 2, 3, 4], [1, 3, 2, 5]))], "k string, dt int, asset1 double, asset2 double")
    r = pairs.ols(df, ["k"]).first()
    assert abs(r.beta - 1.1) < 1e-9 and abs(r.alpha) < 1e-9 and abs(r.r2 - 0.691429) < 1e-6 and abs(r.resid_std - 0.948683) < 1e-6


def test_pnl_and_rolling_goldens(spark):
    df = spark.createDataFrame([("k", 0, 1.0, 1), ("k", 1, 3.0, 1), ("k", 2, 2.0, 0)], "k string, dt int, spread double, position int")
    out = pairs.equity(pairs.pair_pnl(df, ["k"]), ["k"], ["dt"]).orderBy("dt").collect()
    assert [r.pnl for r in out] == [0, 2, -1] and [r.equity for r in out] == [1, 3, 2]
    z = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate([1, 3, 5])], "k string, dt int, v double")
    assert [r.z for r in panel.rolling_zscore(z, "v", "z", 2, ["k"]).orderBy("dt").collect()] == [None, 1, 1]


def test_cointegration_of_planted_and_independent_pairs(spark):
    r = np.random.default_rng(3)
    rows = []
    for i in range(40):
        x = r.standard_normal(300).cumsum()
        e = np.zeros(300)
        for t in range(1, 300):
            e[t] = 0.8 * e[t - 1] + r.standard_normal()
        rows.append((f"planted{i}", (2 * x + e).tolist(), x.tolist()))
        rows.append((f"walk{i}", r.standard_normal(300).cumsum().tolist(), x.tolist()))
    rows += [("same", rows[0][2], rows[0][2]), ("constant", [1.0] * 300, rows[0][2])]
    got = {x.name: x for x in models.cointegration(spark.createDataFrame(rows, "name string, y array<double>, x array<double>")).collect()}
    assert sum(got[f"planted{i}"].p_value < 0.05 for i in range(40)) >= 38
    assert sum(got[f"walk{i}"].p_value < 0.05 for i in range(40)) <= 8
    assert got["same"].t_stat == -math.inf and got["same"].p_value == 0 and "constant" not in got
    assert np.allclose([got["walk0"][c] for c in ("crit_1pct", "crit_5pct", "crit_10pct")], models.critical(300))


def test_pca_invariants(spark):
    r = np.random.default_rng(0)
    x = r.standard_normal((30, 5))
    df = spark.createDataFrame([("s", j, i, float(x[i, j])) for i in range(30) for j in range(5)], "sector string, asset long, dt int, z double")
    loadings, ratios, scores = models.pca(df, ["sector"])
    v = np.array([r.vec for r in loadings.orderBy("asset").collect()])
    assert np.allclose(v.T @ v, np.eye(5)) and abs(ratios.agg(F.sum("ratio")).first()[0] - 1) < 1e-9
    s, l, _ = models.components_of(x)
    assert np.allclose(s, (x - x.mean(0)) @ l)
    assert np.allclose([[r.value for r in scores.where(F.col("dt") == i).orderBy("pc").collect()] for i in (0, 7)], s[[0, 7]])


def test_pca_in_blocks_of_assets(spark):
    r = np.random.default_rng(7)
    parts = {"wide": r.standard_normal((12, 50)) * r.uniform(0.5, 3, 50), "tall": r.standard_normal((40, 6)), "one": r.standard_normal((9, 1)), "flat": np.ones((5, 3)), "short": r.standard_normal((1, 4))}
    df = spark.createDataFrame([(k, 3 * j + 1, i, float(x[i, j])) for k, x in parts.items() for i in range(x.shape[0]) for j in range(x.shape[1])], "sector string, asset long, dt int, z double").repartition(4)
    for block in (1024, 7):
        loadings, ratios, scores = models.pca(df, ["sector"], block=block)
        load = {k: np.array([x.vec for x in loadings.where(F.col("sector") == k).orderBy("asset").collect()]) for k in parts}
        ratio = {k: np.array([x.ratio for x in ratios.where(F.col("sector") == k).orderBy("pc").collect()]) for k in parts}
        score = {k: np.array([x.value for x in scores.where(F.col("sector") == k).orderBy("dt", "pc").collect()]) for k in parts}
        assert not len(load["short"]) and not len(ratio["short"]) and np.all(load["flat"] == 0)
        for k in ("wide", "tall", "one"):
            x = parts[k]
            s, want, e = models.components_of(x)
            some = e > 1e-9
            assert np.allclose(ratio[k], e, atol=1e-12) and load[k].shape == want.shape
            assert np.allclose(load[k][:, some], want[:, some], atol=1e-8)
            assert np.allclose(score[k].reshape(len(x), -1)[:, some], s[:, some], atol=1e-8)
    assert models.pca(df.where("false"), ["sector"])[0].collect() == []


def test_two_blocks_are_two_clusters():
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(0, 0.01, (6, 2)), r.normal(5, 0.01, (6, 2)), [[30, -30]]])
    labels = models.labels_of(x)
    assert set(labels[:6]) != set(labels[6:12]) and labels[12] == -1
    assert not set(labels[:6]) - {-1} & set(labels[6:12])
    assert models.labels_of(x[:1]).tolist() == [-1]


def test_edges(spark):
    df = spark.createDataFrame([("s", 1, 0, 0.0), ("s", 1, 1, 5.0), ("s", 1, 2, None), ("s", 1, 3, -1.0)], "sector string, asset long, dt int, price double")
    assert [r.r for r in panel.change(df, "price", "r").orderBy("dt").collect()] == [None, None, 0.0, -1.2]
    assert [r.lp is None for r in panel.log_price(df).orderBy("dt").collect()] == [True, False, True, True]
    assert panel.scaled(df).collect() == []
