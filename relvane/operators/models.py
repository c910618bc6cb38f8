"""Matrix steps: PCA by blocks of assets, the steps of density clustering, and cointegration by batches of pairs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.tables import kept
from . import moments
from .panel import zscore

#: Assets whose loadings are found at once.
ASSETS = 1024


def components_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, loadings by column, explained-variance ratios) of a dates x assets matrix; a component's largest loading is positive."""
    x = x - x.mean(0)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    sign = np.sign(vt[np.arange(len(vt)), np.abs(vt).argmax(1)])
    sign[sign == 0] = 1
    total = (s**2).sum()
    return u * s * sign, (vt * sign[:, None]).T, s**2 / total if total > 0 else np.zeros_like(s)


def gram_of(rows: list, t: int) -> np.ndarray:
    """Inner products of the dates, over assets less their means."""
    x = np.array(rows, float).reshape(-1, t)
    x = x - x.mean(1, keepdims=True)
    return x.T @ x


def axes_of(gram: np.ndarray, assets: int) -> tuple[np.ndarray, np.ndarray]:
    """(axes by row, squared singular values), largest first, as many as dates or assets."""
    w, u = np.linalg.eigh(gram)
    k = min(len(w), assets)
    return u[:, ::-1][:, :k].T, np.maximum(w[::-1][:k], 0)


def pca(scaled: DataFrame, keys: list[str], value: str = "z", block: int = ASSETS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(loadings, ratios, scores): (keys, asset, vec), (keys, pc, ratio, cum_ratio) and (keys, dt, pc, value), for all keys in one job.

    The rows of a key must hold each of its assets on each of its dates; a key with one date or none gives nothing. Assets are dealt into
    blocks: each sends the inner products of the dates over its assets, dates x dates numbers whatever the assets, whose sum has
    the components; blocks then find the loadings of their assets. A component's largest loading is positive; one without variance has loadings of 0.
    """
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scaled.select(*keys).schema)
    day = scaled.schema["dt"].dataType.simpleString()
    series = scaled.groupBy(*keys, "asset").agg(F.array_sort(F.collect_list(F.struct("dt", F.col(value).alias("v")))).alias("s"))
    n = F.ceil(F.count("*").over(W.partitionBy(*keys)) / block).cast("int")
    rows = kept(series.withColumn("blocks", n).select(*keys, "asset", F.pmod(F.xxhash64("asset"), F.col("blocks")).cast("int").alias("block"), F.transform("s", lambda r: r["dt"]).alias("dts"), F.transform("s", lambda r: r["v"]).alias("vals")).where(F.size("dts") > 1))

    def head(group, times=1):
        import pyarrow as pa

        return {k: group[k].combine_chunks().take(pa.array([0] * times)) for k in keys}

    def partial(group):
        import pyarrow as pa

        dts = group["dts"].combine_chunks().slice(0, 1)
        gram = gram_of(group["vals"].to_pylist(), len(dts[0]))
        return pa.table({**head(group), "dts": dts, "gram": [gram.ravel()], "assets": [len(group)], "block": group["block"].combine_chunks().slice(0, 1)})

    def whole(group):
        import pyarrow as pa

        t = len(group["dts"][0])
        axes, squares = axes_of(sum(np.array(g).reshape(t, t) for g in group["gram"].to_numpy()), sum(group["assets"].to_pylist()))
        total = squares.sum()
        return pa.table({**head(group), "dts": group["dts"].combine_chunks().slice(0, 1), "axes": [axes.ravel()], "squares": [squares], "ratios": [squares / total if total > 0 else squares], "blocks": pa.array([group["block"].to_pylist()], pa.list_(pa.int32()))})

    grams = rows.groupBy(*keys, "block").applyInArrow(partial, f"{types}, dts array<{day}>, gram array<double>, assets long, block int")
    fit = kept(grams.groupBy(*keys).applyInArrow(whole, f"{types}, dts array<{day}>, axes array<double>, squares array<double>, ratios array<double>, blocks array<int>"))

    def loaded(group, fit):
        import pyarrow as pa

        squares = np.array(fit["squares"][0].as_py())
        axes = np.array(fit["axes"][0].as_py()).reshape(len(squares), -1)
        x = np.stack(group["vals"].to_numpy())
        x = x - x.mean(1, keepdims=True)
        some = squares > 1e-12 * squares.sum()
        load = np.where(some, x @ axes.T / np.sqrt(np.where(some, squares, 1)), 0.0)
        peak = load[np.abs(load).argmax(0), np.arange(len(squares))]
        m = len(group)
        return pa.table({**head(group, m + 1), "asset": pa.array([*group["asset"].to_pylist(), None], pa.int64()), "vec": [*load, peak]})

    dealt = fit.select(*keys, "axes", "squares", F.explode("blocks").alias("block"))
    raw = kept(rows.select(*keys, "block", "asset", "vals").groupBy(*keys, "block").cogroup(dealt.groupBy(*keys, "block")).applyInArrow(loaded, f"{types}, asset long, vec array<double>"))
    # of each component the peak of all blocks; its sign turns the component
    peaks = raw.where(F.col("asset").isNull()).groupBy(*keys).agg(F.collect_list("vec").alias("p"))
    peaks = peaks.withColumn("sign", F.aggregate("p", F.array_repeat(F.lit(0.0), F.size(F.element_at("p", 1))), lambda s, v: F.zip_with(s, v, lambda x, y: F.when(F.abs(y) > F.abs(x), y).otherwise(x)))).select(*keys, F.transform("sign", lambda x: F.when(x < 0, -1.0).otherwise(1.0)).alias("sign"))
    loadings = raw.where(F.col("asset").isNotNull()).join(peaks, keys).select(*keys, "asset", F.zip_with("vec", "sign", lambda x, y: x * y).alias("vec"))
    pcs = fit.join(peaks, keys).select(*keys, "dts", F.posexplode(F.arrays_zip("squares", "ratios", "sign")).alias("pc", "x"), "axes")
    w = W.partitionBy(*keys).orderBy("pc")
    ratios = pcs.select(*keys, (F.col("pc") + 1).alias("pc"), F.col("x.ratios").alias("ratio")).withColumn("cum_ratio", F.sum("ratio").over(w.rowsBetween(W.unboundedPreceding, 0)))
    axis = F.slice("axes", F.col("pc") * F.size("dts") + 1, F.size("dts"))
    scores = pcs.select(*keys, (F.col("pc") + 1).alias("pc"), (F.sqrt("x.squares") * F.col("x.sign")).alias("size"), F.explode(F.arrays_zip("dts", axis.alias("axis"))).alias("y"))
    return loadings, ratios, scores.select(*keys, F.col("y.dts").alias("dt"), "pc", (F.col("y.axis") * F.col("size")).alias("value"))


def relevant(ratios: DataFrame, keys: list[str], benchmark: float = 0.5) -> DataFrame:
    """(keys, k): the first component whose cumulative ratio exceeds the benchmark, else all."""
    w = W.partitionBy(*keys).orderBy("pc").rowsBetween(W.unboundedPreceding, 0)
    c = ratios.withColumn("_c", F.sum("ratio").over(w))
    return c.groupBy(*keys).agg(F.coalesce(F.min(F.when(F.col("_c") > benchmark, F.col("pc"))), F.max("pc")).alias("k"))


def scaled_loadings(loadings: DataFrame, keys: list[str], k: int | None = None) -> DataFrame:
    """(keys, asset, vec): the first k loadings, each a z-score over the assets."""
    v = F.col("vec") if k is None else F.slice("vec", 1, k)
    x = zscore(loadings.select(*keys, "asset", F.posexplode(v).alias("pc", "x")), "x", "x", (*keys, "pc"))
    return x.groupBy(*keys, "asset").agg(F.transform(F.array_sort(F.collect_list(F.struct("pc", "x"))), lambda s: s["x"]).alias("vec"))


def visiting_order(x: np.ndarray) -> tuple[list[int], np.ndarray, list[int]]:
    """(order, reachability in that order, predecessors) for two points a core: the traversal of a minimum spanning tree from point 0.

    Distances are taken from one point at a time, so memory grows with the points, not with their pairs."""
    n = len(x)
    reach, before, left, order = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool), []
    for _ in range(n):
        i = int(np.where(left, reach, np.inf).argmin()) if np.isfinite(reach[left]).any() else int(np.flatnonzero(left)[0])
        order.append(i)
        left[i] = False
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        better = left & (d < reach)
        reach[better], before[better] = d[better], i
    return order, reach[order], before[order].tolist()


def steep_clusters(r: np.ndarray, order: list[int], before: list[int], xi: float, least: int) -> list[tuple[int, int]]:
    """Clusters [start, end] of a reachability plot between steep areas (Ankerst et al., 1999), inner ones first."""
    r = np.append(r, np.inf)
    n, keep = len(r) - 1, 1 - xi
    with np.errstate(invalid="ignore"):
        down, up = r[:-1] * keep >= r[1:], r[:-1] <= r[1:] * keep
    falls, rises = r[:-1] > r[1:], r[:-1] < r[1:]
    opened: list[dict] = []
    found: list[tuple[int, int]] = []
    at, peak = 0, 0.0

    def area(start: int, steep: np.ndarray, against: np.ndarray) -> int:
        end, flat, i = start, 0, start
        while i < n:
            if steep[i]:
                end, flat = i, 0
            elif against[i]:
                break
            else:
                flat += 1
                if flat > least:
                    break
            i += 1
        return end

    def still(mib: float) -> list[dict]:
        if np.isinf(mib):
            return []
        return [{**a, "mib": max(a["mib"], mib)} for a in opened if mib <= r[a["start"]] * keep]

    for i in np.flatnonzero(down | up):
        if i < at:
            continue
        peak = max(peak, r[at : i + 1].max())
        opened = still(peak)
        if down[i]:
            end = area(i, down, rises)
            opened.append({"start": int(i), "end": end, "mib": 0.0})
            at = end + 1
            peak = r[at]
            continue
        end_up = area(i, up, falls)
        at = end_up + 1
        peak = r[at]
        inner = []
        for a in opened:
            s, e = a["start"], end_up
            if r[e + 1] * keep < a["mib"]:
                continue
            if r[s] * keep >= r[e + 1]:
                while s < a["end"] and r[s + 1] > r[e + 1]:
                    s += 1
            elif r[e + 1] * keep >= r[s]:
                while e > i and r[e - 1] > r[s]:
                    e -= 1
            while s < e and not (r[s] > r[e] or before[e] in order[s:e]):
                e -= 1
            if s >= e or e - s + 1 < least or s > a["end"] or e < i:
                continue
            inner.append((s, e))
        found += inner[::-1]
    return found


def labels_of(x: np.ndarray, xi: float = 0.05, least: int = 2) -> np.ndarray:
    """Cluster labels from 0, -1 for noise, of points in their order."""
    if len(x) < 2:
        return np.full(len(x), -1)
    order, r, before = visiting_order(x)
    out, label = np.full(len(x), -1), 0
    for s, e in steep_clusters(r, order, before, xi, least):
        members = order[s : e + 1]
        if (out[members] == -1).all():
            out[members] = label
            label += 1
    return out


def cluster_counts(labels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, clusters): how many clusters, noise (-1) left out."""
    return labels.groupBy(*keys).agg(F.countDistinct(F.when(F.col("label") != -1, F.col("label"))).alias("clusters"))


def p_values(t: np.ndarray) -> np.ndarray:
    """Response surface for two series and a constant (MacKinnon, 1994); NaN stays NaN."""
    low, high = 2.92 + 1.5012 * t + 0.039796 * t * t, 2.1945 + 0.64695 * t - 0.29198 * t * t - 0.042377 * t**3
    with np.errstate(invalid="ignore"):
        z = np.where(t <= -2.62, low, high)
        phi = np.array([0.5 * math.erfc(v) for v in (-z / math.sqrt(2)).tolist()])  # exact in the tail
        return np.where(np.isnan(t), np.nan, np.where(t > 0.92, 1.0, np.where(t < -18.86, 0.0, phi)))


def p_value(t: float) -> float:
    return float(p_values(np.array([t]))[0])


#: 1 %, 5 % and 10 % critical values for m = n - 1 of n observations: c + a / m + b / m^2 (MacKinnon, 2010). Fixed values.
CRITICAL = {"crit_1pct": (-3.89644, -10.9519, -22.527), "crit_5pct": (-3.33613, -6.1101, -6.823), "crit_10pct": (-3.04445, -4.2412, -2.720)}


def critical(n: int) -> tuple[float, float, float]:
    m = n - 1
    return tuple(a + b / m + c / m**2 for a, b, c in CRITICAL.values())


def design(e: np.ndarray, lags: int, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """(changes, [level before, `lags` changes before]), the first `drop` rows left out."""
    d = np.diff(e)
    return d[drop:], np.column_stack([e[drop:-1], *(d[drop - k : len(d) - k] for k in range(1, lags + 1))])


def best_lags(e: np.ndarray, most: int) -> int:
    """The number of lags of the least AIC on a common sample: the models are nested, so one decomposition gives all their residual sums."""
    y, x = design(e, most, most)
    q, r = np.linalg.qr(x)
    if np.abs(np.diag(r)).min() <= 1e-12 * np.abs(np.diag(r)).max():
        raise np.linalg.LinAlgError("collinear lags")
    ssr = y @ y - np.cumsum((q.T @ y) ** 2)
    return int((len(y) * np.log(ssr / len(y)) + 2 * np.arange(1, most + 2)).argmin())


def t_of_level(e: np.ndarray, lags: int) -> float:
    """The t statistic of the level before in a regression of the change."""
    y, x = design(e, lags, lags)
    q, rr = np.linalg.qr(x)
    beta = np.linalg.solve(rr, q.T @ y)
    ssr = float(((y - x @ beta) ** 2).sum())
    inv = np.linalg.inv(rr)
    return float(beta[0] / math.sqrt(ssr / (len(y) - x.shape[1]) * (inv[0] @ inv[0])))


def direct_t(y: np.ndarray, x: np.ndarray, lags: int | None = None) -> float:
    """The statistic of the residual of y on x from the rows themselves, lags chosen by AIC on a common sample unless given; NaN where it can't be had."""
    n = len(y)
    if n < 10 or not (np.isfinite(y).all() and np.isfinite(x).all()):
        return math.nan
    if (y == y[0]).all() or (x == x[0]).all():
        return math.nan
    xc, yc = x - x.mean(), y - y.mean()
    vx, vy = float(xc @ xc), float(yc @ yc)
    e = yc - xc * (float(xc @ yc) / vx)
    if 1 - float(e @ e) / vy >= 1 - 100 * math.sqrt(np.finfo(float).eps):
        return -math.inf
    most = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 1))
    try:
        return t_of_level(e, best_lags(e, most) if lags is None else lags)
    except (np.linalg.LinAlgError, ValueError, ZeroDivisionError):
        return math.nan


def engle_granger(y: np.ndarray, x: np.ndarray) -> tuple[float, float]:
    """(t, p) of the residual's unit-root test of one pair, from its rows."""
    t = direct_t(y, x)
    return t, p_value(t)


def cointegration(pairs: DataFrame, y: str = "y", x: str = "x", tie_first: bool = True) -> DataFrame:
    """pairs with t_stat, p_value, first (the direction y on x won), n_obs and critical values, from arrays y and x.

    Both directions are tested and the lower p wins. Pairs of which a direction fails are left out. A batch of rows at once, no shuffle.
    """

    @F.pandas_udf("t1 double, p1 double, t2 double, p2 double, n int")
    def test(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        n = np.array([len(x) for x in a], int)
        u, v = np.zeros((2, len(n), int(n.max(initial=0))))
        inside = np.arange(u.shape[1])[None, :] < n[:, None]
        if inside.any():
            u[inside], v[inside] = np.concatenate(a.to_list()), np.concatenate(b.to_list())
        bad = ~(np.isfinite(u) & np.isfinite(v)).all(1) | (n < 1)
        p = np.flatnonzero(~bad)
        got = moments.measured(np.where(bad[:, None], 0, u), np.where(bad[:, None], 0, v), n, p, np.zeros(len(p), int), n[p] - 1, True, None, direct_t)
        t = {d: np.full(len(n), np.nan) for d in (1, 2)}
        for d in t:
            t[d][p] = got[f"t{d}"]
        return pd.DataFrame({"t1": t[1], "p1": p_values(t[1]), "t2": t[2], "p2": p_values(t[2]), "n": n})

    s = pairs.withColumn("_t", test(y, x)).where(~F.isnan("_t.p1") & ~F.isnan("_t.p2") & F.col("_t.p1").isNotNull() & F.col("_t.p2").isNotNull())
    first = F.col("_t.p1") <= F.col("_t.p2") if tie_first else F.col("_t.p1") < F.col("_t.p2")
    s = s.withColumn("first", first).withColumn("t_stat", F.when(F.col("first"), F.col("_t.t1")).otherwise(F.col("_t.t2"))).withColumn("p_value", F.when(F.col("first"), F.col("_t.p1")).otherwise(F.col("_t.p2")))
    m = (F.col("_t.n") - 1).cast("double")
    return s.withColumns({k: F.lit(a) + F.lit(b) / m + F.lit(c) / (m * m) for k, (a, b, c) in CRITICAL.items()}).withColumn("n_obs", F.col("_t.n")).drop("_t", y, x)
