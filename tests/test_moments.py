"""Statistics from running sums against the rows themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from relvane.operators import models, moments, panel
from relvane.plans import jobs, queries
from relvane.sources import tables


def walks(pairs=30, rows=260, seed=1):
    r = np.random.default_rng(seed)
    x, e = r.normal(0, 0.02, (pairs, rows)).cumsum(1) + 4.6, np.zeros((pairs, rows))
    for t in range(1, rows):
        e[:, t] = 0.8 * e[:, t - 1] + r.normal(0, 0.01, pairs)
    return x, np.where(np.arange(pairs)[:, None] % 2 == 0, 1.5 * x + e, r.normal(0, 0.02, (pairs, rows)).cumsum(1))


def regression(y, x, lags):
    """(t, residual sum of squares, rows) of the level in the change of the residual of y on x, by least squares on its rows."""
    a = np.column_stack([np.ones(len(x)), x])
    e = y - a @ np.linalg.lstsq(a, y, rcond=None)[0]
    d = np.diff(e)

    def fit(k, drop):
        left = d[drop:]
        right = np.column_stack([e[drop:-1], *(d[drop - i : len(d) - i] for i in range(1, k + 1))])
        beta, *_ = np.linalg.lstsq(right, left, rcond=None)
        ssr = ((left - right @ beta) ** 2).sum()
        return beta, right, ssr, len(left)

    if lags is None:
        most = max(0, min(math.ceil(12 * (len(y) / 100) ** 0.25), len(y) // 2 - 1))
        aic = []
        for k in range(most + 1):
            _, _, ssr, n = fit(k, most)
            aic.append(n * math.log(ssr / n) + 2 * (k + 1))
        lags = int(np.argmin(aic))
    beta, right, ssr, n = fit(lags, lags)
    return beta[0] / math.sqrt(ssr / (n - lags - 1) * np.linalg.inv(right.T @ right)[0, 0])


@pytest.mark.parametrize("lags", [None, 0, 1, 4])
def test_statistics_of_overlapping_windows(lags):
    x, y = walks()
    p = np.repeat(np.arange(30), 8)
    hi = np.tile(np.arange(100, 260, 20), 30)
    lo = hi - np.tile([99, 60, 45, 80], 60)
    got = moments.measured(x, y, np.full(30, 260), p, lo, hi, True, lags, models.direct_t)
    for w in range(len(p)):
        u, v = x[p[w], lo[w] : hi[w] + 1], y[p[w], lo[w] : hi[w] + 1]
        for d, (u, v) in ((1, (u, v)), (2, (v, u))):
            assert abs(got[f"t{d}"][w] - regression(u, v, lags)) < 1e-7
            beta, alpha = np.polyfit(v, u, 1)
            s = u - alpha - beta * v
            phi = np.polyfit(s[:-1], np.diff(s), 1)[0]
            want = (alpha, beta, 1 - (s @ s) / ((u - u.mean()) ** 2).sum(), s.std(ddof=1), s.std(ddof=1), np.diff(s).std(ddof=1), math.inf if phi >= 0 else -math.log(2) / phi)
            assert np.allclose([got[f"{c}{d}"][w] for c in moments.PARTS], want, rtol=1e-7, atol=1e-9)


def test_p_values_agree_with_rows():
    x, y = walks(60, 504, 2)
    n = np.full(60, 504)
    got = moments.measured(x, y, n, np.arange(60), np.zeros(60, int), n - 1, True, None, models.direct_t)
    for k in range(60):
        assert abs(models.p_value(got["t1"][k]) - models.engle_granger(x[k], y[k])[1]) < 1e-9


def test_windows_that_sums_cannot_serve():
    r = np.random.default_rng(3)
    x = r.normal(0, 1, (6, 80)).cumsum(1)
    y = np.stack([x[0], np.ones(80), 2 * x[2] + 1, x[3] + 1e-7 * r.normal(0, 1, 80), x[4] * 0, r.normal(0, 1, 80)])
    got = moments.measured(x, y, np.full(6, 80), np.arange(6), np.zeros(6, int), np.full(6, 79), True, None, models.direct_t)
    assert got["t1"][0] == -math.inf and got["t1"][2] == -math.inf and np.isnan(got["t1"][[1, 4]]).all()
    assert got["t1"][3] == -math.inf and abs(got["t1"][5] - regression(x[5], y[5], None)) < 1e-7
    assert np.isnan(got["beta1"][1]) and got["half_life1"][1] == math.inf
    for n in range(1, 45):
        got = moments.measured(x, y, np.full(6, 80), np.array([5]), np.array([3]), np.array([2 + n]), True, None, models.direct_t)
        want = models.direct_t(x[5, 3 : 3 + n], y[5, 3 : 3 + n])
        assert np.allclose(got["t1"][0], want, rtol=1e-7, equal_nan=True)


def test_common_rows_of_sparse_series(spark):
    r = np.random.default_rng(4)
    rows = [("s", a, i, float(4 + r.normal())) for a in range(4) for i in range(120) if r.random() < 0.8] + [("s", 9, 3, None), ("t", 1, 5, 1.0)]
    df = spark.createDataFrame(rows, "sector string, asset long, dt int, lp double").repartition(3)
    cal = panel.calendar(spark.range(120).select(F.col("id").cast("int").alias("dt")))
    arrays = moments.series(df, cal, ["sector"])
    spans = [("s", k, a, b, lo, lo + 69, 30, k * 10) for k, lo in enumerate((0, 20, 50)) for a in range(4) for b in range(a + 1, 4)] + [("s", 0, 0, 9, 0, 69, 1, 0), ("s", 0, 0, 1, 0, 3, 60, 0)]
    spans = spark.createDataFrame(spans, "sector string, day int, a long, b long, lo int, hi int, least int, more int")
    got = {(x.day, x.a, x.b): x for x in moments.windowed(spans, arrays, ["sector"]).collect()}
    values = {(a, i): v for s, a, i, v in rows if s == "s" and v is not None}
    assert len(got) == 18
    for (day, a, b), x in got.items():
        lo = (0, 20, 50)[day]
        both = [i for i in range(lo, lo + 70) if (a, i) in values and (b, i) in values]
        u, v = (np.array([values[z, i] for i in both]) for z in (a, b))
        assert x.n_obs == len(both) and x.more == day * 10
        assert abs(x.t1 - regression(u, v, None)) < 1e-7 and abs(x.t2 - regression(v, u, None)) < 1e-7
        assert abs(x.beta2 - np.polyfit(u, v, 1)[0]) < 1e-9 and abs(x.p1 - models.p_value(x.t1)) < 1e-12
    plan = moments.windowed(spans, arrays, ["sector"])
    assert moments.windowed(spans.where("false"), arrays, ["sector"]).collect() == [] and "t1" in plan.columns
    assert moments.windowed(spans, arrays.where("false"), ["sector"], test=False).collect() == []


def test_what_is_exchanged_does_not_grow_with_the_windows(spark):
    p = spark.range(200).select(F.lit("s").alias("sector"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("asset"), F.col("id").cast("int").alias("dt"), (F.rand(1) + 1).alias("price"))
    cal = tables.kept(panel.calendar(p))
    days = cal.where("ord >= 60").select(F.col("dt").alias("rebal_date"))
    cand = days.select(F.lit("s").alias("sector"), "rebal_date", F.lit(0).cast("long").alias("a"), F.lit(1).cast("long").alias("b"), F.lit(0).alias("cluster_id"), F.lit(1.0).alias("pca_distance"))
    plan = jobs.screen(p, cal, days, cand, 50, 40)
    assert plan.count() == 140
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert [text.count(x) for x in ("MapInArrow", "Window [", "Generate ")] == [1, 0, 0], text


def test_the_jobs_have_rows_at_the_smallest_scale(spark, sf_dir):
    got = queries.evaluated(spark, sf_dir)
    assert all(not got[k].isEmpty() for k in ("loadings", "labels", "candidates", "screened", "selected", "pair_pnl", "equity"))
    assert not queries.portfolio_candidates(spark, sf_dir).isEmpty()
