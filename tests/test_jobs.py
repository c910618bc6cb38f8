"""The jobs against plain pandas versions on a small walk, and options, artifacts and readers."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from relvane.operators import models, pairs, panel
from relvane.params import Fit, Pick, Trade
from relvane.plans import jobs
from relvane.sources import tables

FIT, PICK, TRADE = Fit(30, 60, 30), Pick(3, 0.3, (0.1, 60), 30), Trade(8, 1.0, 0.25, 3.0, 8)


@pytest.fixture(scope="module")
def walk(spark):
    """Prices of two sectors in blocks that move together; asset 7 is listed late."""
    r, rows = np.random.default_rng(5), []
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=i) for i in range(230)]
    for s in (0, 1):
        base = r.normal(0, 0.01, (len(days), 2)).cumsum(0)
        for a in range(6):
            own, e = base[:, a % 2] * (1 + 0.2 * (a // 2)), np.zeros(len(days))
            for t in range(1, len(days)):
                e[t] = 0.7 * e[t - 1] + r.normal(0, 0.004)
            for t, day in enumerate(days):
                if not (s == 1 and a == 1 and t < 100):
                    rows.append((str(s), 6 * s + a, day, float(100 * np.exp(own[t] + e[t]))))
    dates = [(days[i], days[min(i + 40, 229)]) for i in (59, 99, 139, 179)]
    df = spark.createDataFrame(rows, "sector string, asset long, dt date, price double").repartition(3)
    return df, spark.createDataFrame(dates, "rebal_date date, next_date date"), pd.DataFrame(rows, columns=["sector", "asset", "dt", "price"]), dates


def scale(x):
    x = x.sub(x.mean(axis=1), axis=0).ffill()
    x = (x / x.shift() - 1).replace([np.inf, -np.inf], np.nan).dropna()
    return (x - x.mean()) / x.std(ddof=0).replace(0, 1)


def clusters(x, passes, k=None, benchmark=None):
    x = x.loc[:, x.iloc[0].notna()]
    for _ in range(passes):
        x = scale(x)
    _, load, ratio = models.components_of(x.to_numpy())
    if benchmark is not None:
        k = next((i + 1 for i, c in enumerate(ratio.cumsum()) if c > benchmark), len(ratio))
    v = load[:, :k]
    z = (v - v.mean(0)) / np.where(v.std(0) == 0, 1, v.std(0))
    labels = models.labels_of(z)
    return [(a, b, v[i], v[j]) for (i, a), (j, b) in itertools.combinations(enumerate(x.columns), 2) if labels[i] == labels[j] != -1]


def line(y, x):
    beta = np.cov(y, x)[0, 1] / np.var(x, ddof=1)
    return y.mean() - beta * x.mean(), beta


def reversion(s):
    if len(s) < 4:
        return math.inf
    phi = line(np.diff(s), s[:-1])[1]
    return math.inf if phi >= 0 else -math.log(2) / phi


def screened(wide, day):
    out = []
    past, tests = wide.loc[:day].tail(FIT.components + 1), np.log(wide.loc[:day].tail(FIT.tests))
    if len(past) < FIT.components or len(tests) < FIT.tests:
        return out
    for a, b, va, vb in clusters(past, 2, 2):
        both = tests[[a, b]].dropna()
        if len(both) < FIT.overlap:
            continue
        y, x = both[a].to_numpy(), both[b].to_numpy()
        (t1, p1), (t2, p2) = models.engle_granger(y, x), models.engle_granger(x, y)
        if math.isnan(p1) or math.isnan(p2):
            continue
        if p1 > p2:
            y, x = x, y
        alpha, beta = line(y, x)
        s = y - alpha - beta * x
        out.append((a, b, min(p1, p2), p1 <= p2, beta, reversion(s), np.diff(s).std(ddof=1), float(np.linalg.norm(va - vb)), len(both)))
    return out


def positions(z):
    out, pos, hold = [], 0, 0
    for v in z:
        if math.isnan(v):
            pos, hold = 0, 0
        elif pos == 0:
            pos = -1 if v > TRADE.enter else 1 if v < -TRADE.enter else 0
            hold = abs(pos)
        elif v * pos > -TRADE.leave or v * pos < -TRADE.stop or hold >= TRADE.hold:
            pos, hold = 0, 0
        else:
            hold += 1
        out.append(pos)
    return np.array(out)


def test_rolling_equals_a_plain_version(spark, walk):
    df, dates, rows, plain_dates = walk
    got = jobs.rolling(df, dates, FIT, PICK, TRADE, k=2)
    seen, total, chosen = [], {}, []
    for sector, own in rows.groupby("sector"):
        wide = own.pivot(index="dt", columns="asset", values="price").sort_index()
        for day, until in plain_dates:
            table = screened(wide, day)
            seen += [(sector, day, *x[:2], round(x[2], 9), round(x[4], 9), x[8]) for x in table]
            ok = [x for x in table if x[2] <= PICK.p and PICK.half_life[0] <= x[5] <= PICK.half_life[1]]
            score = lambda x: -math.log10(x[2]) - 0.02 * x[5] - 0.5 * x[6] + 0.1 / (1 + x[7])
            best = sorted(ok, key=lambda x: (-score(x), x[0], x[1]))[: PICK.most]
            chosen += [(sector, day, x[0], x[1]) for x in best]
            for x in best:
                ahead = np.log(wide.loc[day:until][[x[0], x[1]]]).dropna()
                if len(ahead) < TRADE.rows + 1:
                    continue
                s = ahead[x[0]] - x[4] * ahead[x[1]]
                roll = s.rolling(TRADE.rows, min_periods=1)
                z = (s - roll.mean()) / roll.std(ddof=0).where(lambda v: v > 1e-12)
                p = positions(z.round(9).to_numpy())
                pnl = np.r_[0, p[:-1]] * np.r_[0.0, np.diff(s)]
                for d, v in zip(ahead.index, pnl):
                    total.setdefault((sector, day, d), []).append(v)
    assert chosen and total
    assert sorted((r.sector, r.rebal_date, r.a, r.b, round(r.pval_min, 9), round(r.beta, 9), r.overlap_n) for r in got["screened"].collect()) == sorted(seen)
    assert sorted((r.sector, r.rebal_date, r.a, r.b) for r in got["selected"].collect()) == sorted(chosen)
    mean = {k: float(np.mean(v)) for k, v in total.items()}
    rows_ = got["equity"].collect()
    assert {(r.sector, r.rebal_date, r.dt) for r in rows_} == set(mean)
    for s in {k[0] for k in mean}:
        level, by = 1.0, {(r.dt, r.rebal_date): r for r in rows_ if r.sector == s}
        for d, day in sorted(by):
            level += mean[s, day, d]
            assert abs(by[d, day].equity - level) < 1e-9


def test_portfolio_follows_the_winning_order(spark, walk):
    df, dates, rows, plain_dates = walk
    got = {(r.sector, r.rebal_date, *sorted((r.permno1, r.permno2))): r for r in jobs.portfolio(df, dates, FIT, p_most=0.3).collect()}
    want = {}
    for sector, own in rows.groupby("sector"):
        wide = own.pivot(index="dt", columns="asset", values="price").sort_index()
        for day, _ in plain_dates:
            past, tests = wide.loc[:day].tail(FIT.components + 1), np.log(wide.loc[:day].tail(FIT.tests + 1))
            if len(tests) <= FIT.tests:
                continue
            for a, b, _, _ in clusters(past, 1, benchmark=0.5):
                both = tests[[a, b]]
                if both.isna().any().any():
                    continue
                y, x = both[a].to_numpy(), both[b].to_numpy()
                (_, p1), (_, p2) = models.engle_granger(y, x), models.engle_granger(x, y)
                if min(p1, p2) < 0.3:
                    first, second = (a, b) if p1 < p2 else (b, a)
                    history = np.log(wide[[first, second]]).dropna()
                    want[sector, day, a, b] = (first, second, line(history[first].to_numpy(), history[second].to_numpy())[1])
    assert set(got) == set(want) and any(w[0] > w[1] for w in want.values())
    for k, (first, second, beta) in want.items():
        assert (got[k].permno1, got[k].permno2) == (first, second) and abs(got[k].beta - beta) < 1e-9
    assert jobs.portfolio(df, dates, FIT, p_most=0.3, spread_window="coint").count() == len(want)


def test_options(spark, walk):
    df, dates, _, plain_dates = walk
    cal = panel.calendar(df)
    both = panel.forward(df, cal, dates).groupBy("rebal_date").agg(F.max("dt").alias("m")).collect()
    open_ = panel.forward(df, cal, dates, half_open=True).groupBy("rebal_date").agg(F.max("dt").alias("m")).collect()
    assert {r.rebal_date: r.m for r in both} == dict(plain_dates) and all(r.m < dict(plain_dates)[r.rebal_date] for r in open_)
    x = panel.scaled(df.where("sector = '0'"), demeaned="returns").groupBy("dt").agg(F.count("*").alias("n"))
    assert {r.n for r in x.collect()} == {6}
    ahead = panel.log_price(panel.forward(df, cal, dates)).where("sector = '0'").select("sector", "rebal_date", "asset", "dt", "lp")
    one = spark.createDataFrame([("0", plain_dates[0][0], 0, 2, 0.5, True)], "sector string, rebal_date date, a long, b long, beta double, swapped boolean")
    s = {r.dt: r.spread for r in pairs.forward_pnl(ahead, one, jobs.KEYS, TRADE).collect()}
    t = {r.dt: r.spread for r in pairs.forward_pnl(ahead, one.drop("swapped"), jobs.KEYS, TRADE).collect()}
    lp = {(r.asset, r.dt): r.lp for r in ahead.where(F.col("rebal_date") == plain_dates[0][0]).collect()}
    assert s and all(abs(s[d] - (lp[2, d] - 0.5 * lp[0, d])) < 1e-12 and abs(t[d] - (lp[0, d] - 0.5 * lp[2, d])) < 1e-12 for d in s)


def test_half_life_needs_three_rows(spark):
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate([1.0, 0.4, 0.3])] + [("l", i, v) for i, v in enumerate([1.0, 0.4, 0.3, 0.1])], "k string, dt int, spread double")
    got = {r.k: r.half_life for r in pairs.spread_stats(df, ["k"]).collect()}
    assert got["k"] == math.inf and 0 < got["l"] < math.inf


def test_dates_and_years_that_are_not_there(spark, walk, tmp_path):
    df, _, _, plain_dates = walk
    days = spark.createDataFrame([(plain_dates[0][0],), (dt.date(1999, 1, 1),)], "dt date")
    with pytest.raises(Exception, match="not a trading date"):
        panel.back_from(panel.calendar(df), days, 5).collect()
    assert panel.back_from(panel.calendar(df), days.limit(1), 5).collect()[0].back == plain_dates[0][0] - dt.timedelta(days=5)
    tables.write_by_year(df.withColumnsRenamed({"asset": "permno", "dt": "date"}), str(tmp_path / "y"))
    assert tables.read_quotes(spark, str(tmp_path / "y"), 2001, 2001).count() == df.count()
    with pytest.raises(FileNotFoundError):
        tables.read_quotes(spark, str(tmp_path / "y"), 2005, 2006)


def test_artifacts(spark, walk, tmp_path):
    df, dates, _, _ = walk
    got = jobs.rolling(df, dates, FIT, PICK, TRADE, k=2)
    keyed = {k: v for k, v in got.items() if {"sector", "rebal_date"} <= set(v.columns)}
    jobs.write_artifacts(keyed, str(tmp_path))
    assert set(keyed) == {"loadings", "labels", "candidates", "screened", "selected", "pair_pnl", "portfolio_pnl", "equity"}
    for name, x in keyed.items():
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == x.count() > 0
