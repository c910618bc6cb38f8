"""Regressions and unit-root tests of many pairs over many windows, from running sums.

A pair's common rows are laid out once, as two arrays. Running sums of x, y, and of the products of their values h rows apart, for
each h up to the lags of the test, then give every window's cross moments as a difference of two places, whatever the length
of the window and however windows overlap. Both directions of the regression, the spread's deviations and half-life, the choice of lags and the
statistic follow from these moments, for all windows of a batch at once.

Sums lose digits where a residual is tiny against its series. Such windows, and those that are too short for their lags, are
computed from the rows themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Share of a series' sum of squares below which differences of sums are not trusted.
THIN = 1e-5
#: Running sums, as doubles, that a batch may hold.
ROOM = 1 << 23
PARTS = ("alpha", "beta", "r2", "resid_std", "sigma", "change_sigma", "half_life")


def most_lags(n):
    """The largest number of lags for n rows (Schwert, 1989)."""
    n = np.asarray(n)
    return np.maximum(0, np.minimum(np.ceil(12 * (n / 100) ** 0.25), n // 2 - 1)).astype(int)


class Running:
    """Running sums of series x and y, (pairs, rows) each, and of products of values up to `far` rows apart."""

    def __init__(self, x: np.ndarray, y: np.ndarray, far: int):
        self.x, self.y = x, y
        self.sx, self.sy = self.along(x), self.along(y)
        self.xx, self.yy, self.both = [], [], []
        for h in range(min(far, x.shape[1] - 1) + 1 if x.shape[1] else 1):
            a, b, u, v = x[:, h:], y[:, h:], x[:, : x.shape[1] - h], y[:, : x.shape[1] - h]
            self.xx.append(self.along(a * u, h))
            self.yy.append(self.along(b * v, h))
            self.both.append(self.along(a * v + b * u, h))

    @staticmethod
    def along(v: np.ndarray, ahead: int = 0) -> np.ndarray:
        return np.concatenate([np.zeros((len(v), 1 + ahead)), v.cumsum(1)], 1)

    @staticmethod
    def between(s: np.ndarray, p, lo, hi) -> np.ndarray:
        """Sums over rows lo to hi, both included, of pairs p."""
        return s[p, hi + 1] - s[p, lo]

    def lines(self, p, lo, hi) -> dict[str, np.ndarray]:
        """Centred moments of the windows."""
        n = (hi - lo + 1).astype(float)
        sx, sy = self.between(self.sx, p, lo, hi), self.between(self.sy, p, lo, hi)
        xx, yy, xy = (self.between(s[0], p, lo, hi) for s in (self.xx, self.yy, self.both))
        return {"n": n, "mx": sx / n, "my": sy / n, "vx": xx - sx * sx / n, "vy": yy - sy * sy / n, "vxy": xy / 2 - sx * sy / n, "xx": xx, "yy": yy}

    def residual(self, p, lo, hi, k: int, cx, cy, c) -> np.ndarray:
        """(windows, k + 2, k + 2): sums of e[t - i] e[t - j] of e = cx x + cy y + c, over the rows t that have k + 1 rows of the window before them."""
        w = k + 2
        out = np.empty((len(p), w, w))
        first = lo + k + 1
        p, cx, cy = p[:, None], cx[:, None], cy[:, None]
        i = np.arange(w)
        hi_i, lo_i = hi[:, None] - i, first[:, None] - i
        e = cx * self.between(self.sx, p, lo_i, hi_i) + cy * self.between(self.sy, p, lo_i, hi_i)
        for h in range(w):
            a, b = lo_i[:, : w - h], hi_i[:, : w - h]
            g = cx * cx * self.between(self.xx[h], p, a, b) + cy * cy * self.between(self.yy[h], p, a, b) + cx * cy * self.between(self.both[h], p, a, b)
            out[:, i[: w - h], i[h:]] = g
            out[:, i[h:], i[: w - h]] = g
        c = c[:, None, None]
        return out + c * (e[:, :, None] + e[:, None, :]) + c * c * (hi - first + 1)[:, None, None]


def turned(g: np.ndarray, level_last: bool) -> np.ndarray:
    """Moments of [change, level before, changes before], or with the level last, from those of e[t], e[t - 1], ..."""
    w = g.shape[1]
    m = np.eye(w) - np.eye(w, k=1)
    m[w - 1] = 0
    m[w - 1, 1 if w > 1 else 0] = 1  # the level
    order = [*range(w)] if level_last else [0, w - 1, *range(1, w - 1)]
    return (m @ g @ m.T)[:, order][:, :, order]


def eliminated(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(residual sums of squares after each regressor, its pivots, its moments with what is left of the response); the response stands first."""
    a = a.copy()
    q = a.shape[1] - 1
    rest, pivot, cross = (np.empty((len(a), q)) for _ in range(3))
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(1, q + 1):
            pivot[:, c - 1], cross[:, c - 1] = a[:, c, c], a[:, c, 0]
            row = a[:, c, :].copy()
            a -= row[:, :, None] * (row / row[:, c][:, None])[:, None, :]
            rest[:, c - 1] = a[:, 0, 0]
    return rest, pivot, cross


def unit_root(r: Running, p, lo, hi, cx, cy, c, lags: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(t, sure) of the lagged level of e = cx x + cy y + c in its change; lags by AIC on a common sample unless given. Not sure: too few rows, or digits lost."""
    t, sure = np.full(len(p), np.nan), np.zeros(len(p), bool)
    n = hi - lo + 1
    most = most_lags(n) if lags is None else np.full(len(p), lags)
    best = most.copy()
    enough = n - 1 - most >= most + 4
    for m in np.unique(most[enough]) if lags is None else ():
        at = np.flatnonzero(enough & (most == m))
        a = turned(r.residual(p[at], lo[at], hi[at], m, cx[at], cy[at], c[at]), False)
        rest, pivot, _ = eliminated(a)
        rows = (n[at] - 1 - m)[:, None]
        ok = (pivot > THIN * np.einsum("wii->wi", a)[:, 1:]).all(1) & (rest > THIN * a[:, :1, 0]).all(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            best[at] = np.nan_to_num(rows * np.log(rest / rows) + 2 * np.arange(1, m + 2), nan=np.inf).argmin(1)
        enough[at[~ok]] = False
    for k in np.unique(best[enough]):
        at = np.flatnonzero(enough & (best == k))
        a = turned(r.residual(p[at], lo[at], hi[at], k, cx[at], cy[at], c[at]), True)
        rest, pivot, cross = eliminated(a)
        sure[at] = (pivot > THIN * np.einsum("wii->wi", a)[:, 1:]).all(1) & (rest[:, -1] > THIN * a[:, 0, 0])
        with np.errstate(divide="ignore", invalid="ignore"):
            t[at] = cross[:, -1] / np.sqrt(pivot[:, -1] * rest[:, -1] / (n[at] - 1 - k - (k + 1)))
    return t, sure


def fitted(r: Running, p, lo, hi) -> dict[str, np.ndarray]:
    """Both directions (1: x on y as laid out, 2: the other) of each window: PARTS, as name + direction, and `thin`, where sums lose too many digits."""
    z = r.lines(p, lo, hi)
    out, n = {"thin": np.zeros(len(p), bool)}, z["n"]
    with np.errstate(divide="ignore", invalid="ignore"):
        for d, (mu, mv, vu, vv, uu, vs) in {1: (z["mx"], z["my"], z["vx"], z["vy"], z["xx"], z["yy"]), 2: (z["my"], z["mx"], z["vy"], z["vx"], z["yy"], z["xx"])}.items():
            flat = vv <= 1e-12 * vs
            beta = np.where(flat, np.nan, z["vxy"] / vv)
            alpha = mu - beta * mv
            left = np.maximum(vu - beta * z["vxy"], 0)
            out["thin"] |= flat | (vu <= 1e-12 * uu) | (left < THIN * vu) | (left < 1e-9 * uu)
            cx, cy = (np.ones_like(beta), -beta) if d == 1 else (-beta, np.ones_like(beta))
            e = lambda at: cx * r.x[p, at] + cy * r.y[p, at] - alpha  # noqa: B023, E731
            several = n > 1
            g = np.zeros((len(p), 2, 2))
            if several.any():
                s = several
                g[s] = r.residual(p[s], lo[s], hi[s], 0, cx[s], cy[s], -alpha[s])
            steps, total, before = n - 1, e(hi) - e(lo), -e(hi)
            dd, dl, ll = g[:, 0, 0] - 2 * g[:, 0, 1] + g[:, 1, 1], g[:, 0, 1] - g[:, 1, 1], g[:, 1, 1]
            spread = ll - before * before / steps
            phi = np.where(spread > 1e-12 * ll, (dl - total * before / steps) / spread, np.nan)
            two = lambda v, k: np.where(k > 1, np.sqrt(np.maximum(v, 0) / (k - 1)), np.nan)
            out |= {f"alpha{d}": alpha, f"beta{d}": beta, f"r2{d}": np.where(vu <= 1e-12 * uu, np.nan, 1 - left / vu), f"resid_std{d}": two(left, n), f"sigma{d}": two(left, n), f"change_sigma{d}": two(dd - total * total / steps, steps)}
            out[f"half_life{d}"] = np.where((phi < 0) & (steps >= 3), -math.log(2) / phi, np.inf)
            out[f"c{d}"] = np.stack([cx, cy, -alpha])
    return out


def laid_out(ords: list[np.ndarray], values: list[np.ndarray], rows: list[np.ndarray], pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(x, y, how many common rows before each place, the first place): two series a pair in sparse form, brought to their common rows, zeros behind."""
    base = min((int(o.min()) for o in ords if len(o)), default=0)
    wide = max((int(o.max()) for o in ords if len(o)), default=base - 1) - base + 1
    dense = np.full((2, pairs, wide), np.nan)
    for k in range(2):
        dense[k, rows[k], ords[k] - base] = values[k]
    ok = np.isfinite(dense).all(0)
    order = np.argsort(~ok, axis=1, kind="stable")
    x, y = (np.where(np.take_along_axis(ok, order, 1), np.take_along_axis(v, order, 1), 0.0) for v in dense)
    before = np.concatenate([np.zeros((pairs, 1), np.int64), ok.cumsum(1)], 1)
    return x, y, before, base


def centred(v: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(series less their means over the first `count` rows, the means)."""
    mean = v.sum(1) / np.maximum(count, 1)
    return np.where(np.arange(v.shape[1])[None, :] < count[:, None], v - mean[:, None], 0.0), mean


def measured(x: np.ndarray, y: np.ndarray, count: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray, test: bool, lags: int | None, direct: Callable) -> dict[str, np.ndarray]:
    """PARTS of both directions of each window lo to hi of pair p and, with test, t1, t2; `direct` tests the windows of which the sums can't be sure."""
    x, mx = centred(x, count)
    y, my = centred(y, count)
    far = (int(most_lags(max(1, int((hi - lo + 1).max(initial=1))))) if lags is None else lags) + 1 if test else 1
    r = Running(x, y, far)
    out = fitted(r, p, lo, hi)
    for d in (1, 2) if test else ():
        t, sure = np.full(len(p), np.nan), np.zeros(len(p), bool)
        s = np.flatnonzero(~out["thin"])
        t[s], sure[s] = unit_root(r, p[s], lo[s], hi[s], *out[f"c{d}"][:, s], lags)
        for w in np.flatnonzero(~sure):
            u, v = x[p[w], lo[w] : hi[w] + 1], y[p[w], lo[w] : hi[w] + 1]
            t[w] = direct(u, v, lags) if d == 1 else direct(v, u, lags)
        out[f"t{d}"] = t
    # back from centred series
    out["alpha1"] = out["alpha1"] + mx[p] - out["beta1"] * my[p]
    out["alpha2"] = out["alpha2"] + my[p] - out["beta2"] * mx[p]
    return {k: v for k, v in out.items() if k != "thin" and k[0] != "c" or k.startswith("change")}


def series(panel: DataFrame, cal: DataFrame, keys: list[str], value: str = "lp") -> DataFrame:
    """(keys, asset, ords, vals): a panel's series as arrays, in the order of the calendar (dt, ord); a row an asset. Missing values are left out."""
    rows = panel.where(F.col(value).isNotNull()).join(cal.select("dt", "ord"), "dt").groupBy(*keys, "asset").agg(F.array_sort(F.collect_list(F.struct("ord", F.col(value).alias("v")))).alias("s"))
    return rows.select(*keys, "asset", F.transform("s", lambda r: r["ord"].cast("int")).alias("ords"), F.transform("s", lambda r: r["v"]).alias("vals"))


def windowed(spans: DataFrame, arrays: DataFrame, keys: list[str], test: bool = True, lags: int | None = None) -> DataFrame:
    """spans (keys, a, b, lo, hi, least, ...) with n_obs, PARTS of both directions (1: a on b, 2: b on a) and, with test, t1, p1, t2, p2.

    A span is a window of calendar rows lo to hi of a pair; spans with fewer than `least` common rows are left out. What is exchanged is a
    row for each pair, which holds its spans, and twice the arrays of an asset: it doesn't grow with the overlap of windows. lags: their
    number, else chosen by AIC.
    """
    from .models import direct_t, p_values  # here, as models imports this module; executors get the functions by value

    other = [c for c in spans.columns if c not in (*keys, "a", "b")]
    rows = spans.groupBy(*keys, "a", "b").agg(F.collect_list(F.struct(*other)).alias("spans"))
    for side in "ab":
        rows = rows.join(arrays.select(*keys, F.col("asset").alias(side), F.col("ords").alias(f"o{side}"), F.col("vals").alias(f"v{side}")), [*keys, side])
    carried = [c for c in other if c not in ("lo", "hi", "least")]
    numbers = [f"{x}{d}" for d in (1, 2) for x in PARTS] + (["t1", "t2", "p1", "p2"] if test else [])
    shape = T.StructType([*[rows.schema[c] for c in (*keys, "a", "b")], *[spans.schema[c] for c in carried], T.StructField("n_obs", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in numbers]])

    def run(batches):
        import pyarrow as pa

        def offsets(column):
            return column.offsets.to_numpy() - column.offsets[0].as_py()

        for whole in batches:
            rows = [len(v) for v in (whole.column("va"), whole.column("vb"))]
            length = max([1, *(int(np.diff(offsets(whole.column(c))).max(initial=1)) for c in ("va", "vb"))])
            step = max(1, ROOM // (length * 3 * (int(most_lags(length)) + 3)))
            for s in range(0, whole.num_rows, step):
                batch = whole.slice(s, step)
                spans = batch.column("spans")
                parent = np.repeat(np.arange(batch.num_rows), np.diff(offsets(spans)))
                flat = spans.flatten()
                lo, hi, least = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "hi", "least"))
                lists = [batch.column(c) for c in ("oa", "ob", "va", "vb")]
                rows = [np.repeat(np.arange(batch.num_rows), np.diff(offsets(c))) for c in lists[:2]]
                x, y, before, base = laid_out([c.flatten().to_numpy() for c in lists[:2]], [c.flatten().to_numpy() for c in lists[2:]], rows, batch.num_rows)
                wide = before.shape[1] - 1
                first = before[parent, np.clip(lo - base, 0, wide)]
                last = before[parent, np.clip(hi - base + 1, 0, wide)] - 1
                keep = np.flatnonzero(last - first + 1 >= np.maximum(least, 1))
                p, n = parent[keep], (last - first + 1)[keep]
                got = measured(x, y, before[:, -1], p, first[keep], last[keep], test, lags, direct_t)
                if test:
                    got |= {f"p{d}": p_values(got[f"t{d}"]) for d in (1, 2)}
                take = pa.array(p)
                columns = [batch.column(c).take(take) for c in (*keys, "a", "b")] + [flat.field(c).take(pa.array(keep)) for c in carried]
                columns += [pa.array(n.astype(np.int32))] + [pa.array(got[c], mask=np.isnan(got[c])) for c in numbers]
                yield pa.RecordBatch.from_arrays(columns, names=shape.fieldNames())

    return rows.mapInArrow(run, shape)


def winning(df: DataFrame, tie_first: bool) -> DataFrame:
    """Adds first (direction 1 won, by the lower p), t_stat, p_value and PARTS of the winning direction; rows of which a direction failed are left out."""
    df = df.where(F.col("p1").isNotNull() & F.col("p2").isNotNull())
    df = df.withColumn("first", F.col("p1") <= F.col("p2") if tie_first else F.col("p1") < F.col("p2"))
    return directed(df, {"t": "t_stat", "p": "p_value"}).drop("t1", "t2", "p1", "p2")


def directed(df: DataFrame, more: dict[str, str] | None = None) -> DataFrame:
    """PARTS (and more) of direction 1 where `first` is true, else of 2."""
    names = {**{x: x for x in PARTS}, **(more or {})}
    picked = {name: F.when(F.col("first"), F.col(f"{x}1")).otherwise(F.col(f"{x}2")) for x, name in names.items()}
    return df.withColumns(picked).drop(*[f"{x}{d}" for x in PARTS for d in (1, 2)])
