"""Pairs: candidates, aligned series, hedge regressions, spreads, positions and results."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..params import Pick, Trade
from ..sources.tables import kept
from .neighbours import LARGEST, PIECE
from .quotes import finite

#: Rows of z that are walked through in step, series times rows.
ROOM = 1 << 22
#: Assets of a block, whose pairs with another block are one row's work, and distances that are worked out at once.
BLOCK, CELLS = PIECE, 1 << 16
#: Tiles for each core, about, that the pairs of all keys are dealt into, and components of the vectors of a block.
TILES, COMPONENTS = 2, 1 << 22


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by hash of the keys over all shuffle partitions, however few bytes it has: each of its rows is much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def combinations(labels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, a, b), a < b, of assets with one label; noise (-1) pairs with nothing.

    Assets of a label are dealt into blocks, and a block meets another in one place, so a label is as many pieces of work as it has pairs of blocks.
    """
    on = [*keys, "label"]
    x = labels.where(F.col("label") != -1).select(*on, "asset")
    n = x.groupBy(*on).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_n"))
    x = x.join(n, on).withColumn("_p", F.pmod(F.xxhash64(F.lit(1), "asset"), "_n").cast("int"))
    at = [*on, "_i", "_j"]
    left = x.select(*on, F.col("_p").alias("_i"), F.explode(F.sequence("_p", F.col("_n") - 1)).alias("_j"), F.col("asset").alias("_a"))
    right = x.select(*on, F.explode(F.sequence(F.lit(0), "_p")).alias("_i"), F.col("_p").alias("_j"), F.col("asset").alias("_b"))
    both = dealt(left, *at).join(dealt(right, *at), at).where("(_i < _j and _a <> _b) or _a < _b")
    return both.select(*on, F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """x to so many digits, halves up as Spark's round() has them: near a half the decimal number decides."""
    scaled = x * 10.0**digits
    low = np.floor(scaled)
    out = (low + (scaled - low >= 0.5)) / 10.0**digits
    for k in np.flatnonzero((np.abs(scaled - low - 0.5) < 1e-4) | ~(np.abs(scaled) < 1e11)).tolist():
        out[k] = float(Decimal(repr(float(x[k]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) if np.isfinite(x[k]) and abs(x[k]) < 1e15 else x[k]
    return out


def tiles_of(batches, keys: list[str]):
    """Tables of the rows of one tile each; the rows come sorted by the keys."""
    import pyarrow as pa
    import pyarrow.compute as pc

    rest: list = []
    for batch in batches:
        now = pa.Table.from_batches([batch])
        n = len(now)
        if not n:
            continue
        new = np.zeros(n, bool)
        new[0] = bool(rest) and any(now.column(k)[0].as_py() != rest[0].column(k)[0].as_py() for k in keys)
        for k in keys:
            new[1:] |= pc.not_equal(now.column(k).slice(1), now.column(k).slice(0, n - 1)).to_numpy()
        at = [0, *np.flatnonzero(new).tolist(), n]
        for s, e in zip(at, at[1:]):
            if new[s] and rest:
                yield pa.concat_tables(rest)
                rest = []
            if e > s:
                rest.append(now.slice(s, e - s))
    if rest:
        yield pa.concat_tables(rest)


def matrix(column) -> tuple[np.ndarray, np.ndarray]:
    """(vectors as columns, padded by zeros; their lengths, -1 where a vector is null or holds a null)."""
    import pyarrow.compute as pc

    column = column.combine_chunks()
    size = pc.list_value_length(column).fill_null(0).to_numpy().astype(int)
    flat, row = column.flatten(), np.repeat(np.arange(len(size)), size)
    out = np.zeros((int(size.max(initial=0)), len(size)))
    out[np.arange(len(row)) - np.repeat(size.cumsum() - size, size), row] = flat.fill_null(0).to_numpy().astype(float)
    size[column.is_null().to_numpy(zero_copy_only=False)] = -1
    size[row[flat.is_null().to_numpy(zero_copy_only=False)]] = -1
    return out, size


def distances(vectors: DataFrame, keys: list[str], digits: int) -> DataFrame:
    """(keys, a, b, dist), a < b, for all pairs of rows (keys, asset, vec) of a key; dist, to so many digits, is null where a vector or component is, or lengths differ.

    A row travels once for each block of its key. Blocks have BLOCK rows at least and LARGEST rows or COMPONENTS components at most, and in between a key has as few as give all
    cores TILES tiles each, a key by its share of the pairs: what is shuffled is a few copies of the rows, whatever their number. Tiles of two blocks are
    worked out in parts of CELLS distances, each the sum over the components in their order, as SQL adds them.
    """
    x = vectors.dropna(subset=[*keys, "asset"]).select(*keys, F.col("asset").cast("long").alias("asset"), "vec")
    count = x.groupBy(*keys).agg(F.count("*").alias("_rows"))
    size = x.groupBy(*keys).agg(F.count("*").alias("_rows"), F.max(F.size("vec")).alias("_size"))
    tiles = TILES * vectors.sparkSession.sparkContext.defaultParallelism * F.col("_rows").cast("double") ** 2 / F.col("_all")
    least = F.ceil(F.col("_rows") / F.least(F.lit(LARGEST), F.floor(COMPONENTS / F.greatest(F.lit(1), "_size")) + 1))
    blocks = F.greatest(least, F.least(F.ceil(F.col("_rows") / BLOCK), F.ceil((F.sqrt(8 * tiles + 1) - 1) / 2))).cast("int")
    n = kept(size.crossJoin(count.agg(F.sum(F.col("_rows").cast("double") ** 2).alias("_all"))).select(*keys, blocks.alias("_n")))  # of a known size, so vectors aren't shuffled to meet it
    x = x.join(n, keys).withColumn("_p", F.pmod(F.xxhash64(F.lit(1), "asset"), "_n").cast("int")).withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = [*keys, "_i", "_j"]
    x = dealt(x.select(*keys, F.least("_p", "_q").alias("_i"), F.greatest("_p", "_q").alias("_j"), "_p", "asset", "vec"), *at).sortWithinPartitions(*at)

    def run(batches):
        import pyarrow as pa

        for tile in tiles_of(batches, at):
            i, j, p = tile.column("_i")[0].as_py(), tile.column("_j")[0].as_py(), tile.column("_p").to_numpy()
            asset, (v, size) = tile.column("asset").to_numpy(), matrix(tile.column("vec"))
            left, right = np.flatnonzero(p == i), np.flatnonzero(p == j)
            x, y, b = v[:, left], v[:, right], asset[right]
            step = max(1, CELLS // max(1, len(right)))
            for s in range(0, len(left) if len(right) else 0, step):
                own = left[s : s + step]
                total, d = np.zeros((2, len(own), len(right)))
                for u, w in zip(x[:, s : s + step], y):
                    np.subtract(u[:, None], w[None, :], out=d)
                    np.multiply(d, d, out=d)
                    total += d
                a = asset[own][:, None]
                take = a < b if i == j else a != b
                known = ((size[own][:, None] == size[right]) & (size[right] >= 0))[take]
                first, second = np.minimum(a, b)[take], np.maximum(a, b)[take]
                dist = pa.array(rounded(np.sqrt(total[take]), digits), mask=None if known.all() else ~known)
                yield pa.RecordBatch.from_arrays([*[pa.repeat(tile.column(k)[0], len(first)) for k in keys], pa.array(first), pa.array(second), dist], [*keys, "a", "b", "dist"])

    types = T.StructType([x.schema[k] for k in keys]).add("a", "long").add("b", "long").add("dist", "double")
    return x.mapInArrow(run, types)


def distance(u, v) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(u, v, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def aligned(panel: DataFrame, pairs: DataFrame, value: str, keys: list[str], min_obs: int = 50) -> DataFrame:
    """(keys, a, b, dt, asset1, asset2): both assets' values on common dates, for pairs with at least min_obs of them."""
    p = panel.where(finite(value).isNotNull())
    left = pairs.join(p.select(*keys, F.col("asset").alias("a"), "dt", F.col(value).alias("asset1")), [*keys, "a"])
    both = left.join(p.select(*keys, F.col("asset").alias("b"), "dt", F.col(value).alias("asset2")), [*keys, "b", "dt"])
    return both.withColumn("n_obs", F.count("*").over(W.partitionBy(*keys, "a", "b"))).where(F.col("n_obs") >= min_obs)


def ols(df: DataFrame, keys: list[str], y: str = "asset1", x: str = "asset2") -> DataFrame:
    """(keys, alpha, beta, r2, resid_std): y on x with a constant; the residual deviation divides by n - 1.

    It follows from moments: var(residual) = var(y) (1 - r2). r2 of a constant y is null.
    """
    agg = df.groupBy(*keys).agg(F.regr_intercept(y, x).alias("alpha"), F.regr_slope(y, x).alias("beta"), F.when(F.var_pop(y) > 0, F.regr_r2(y, x)).alias("r2"), F.var_samp(y).alias("_v"), F.count("*").alias("n_obs"))
    return agg.withColumn("resid_std", F.sqrt(F.greatest(F.col("_v") * (1 - F.col("r2")), F.lit(0.0)))).drop("_v")


def with_spread(df: DataFrame, fits: DataFrame, keys: list[str], intercept: bool = True) -> DataFrame:
    """df with spread = asset1 - beta asset2, less alpha if asked for."""
    s = F.col("asset1") - F.col("beta") * F.col("asset2")
    return df.join(fits.select(*keys, "alpha", "beta"), keys).withColumn("spread", s - F.col("alpha") if intercept else s)


def spread_stats(df: DataFrame, keys: list[str], spread: str = "spread", year: int = 252) -> DataFrame:
    """(keys, sigma, change_sigma, half_life), sigmas annualised; half-life is infinite without reversion."""
    w = W.partitionBy(*keys).orderBy("dt")
    d = df.withColumn("_lag", F.lag(spread).over(w)).withColumn("_d", F.col(spread) - F.col("_lag"))
    agg = d.groupBy(*keys).agg(F.stddev_samp(spread).alias("sigma"), F.stddev_samp("_d").alias("change_sigma"), F.regr_slope("_d", "_lag").alias("phi"), F.count("_lag").alias("n_lag"))
    return agg.select(*keys, (F.col("sigma") * math.sqrt(year)).alias("sigma"), (F.col("change_sigma") * math.sqrt(year)).alias("change_sigma"), half_life(F.col("phi"), F.col("n_lag")).alias("half_life"))


def half_life(phi: Column, n: Column) -> Column:
    """Infinite without reversion, and where fewer than three rows have a row before."""
    return F.when(phi.isNull() | (phi >= 0) | (n < 3), F.lit(float("inf"))).otherwise(-math.log(2) / phi)


def dickey_fuller(df: DataFrame, keys: list[str], y: str = "asset1", x: str = "asset2") -> DataFrame:
    """(keys, t_stat): of the lagged residual in its change, no constant and no lags; sums only."""
    e = with_spread(df, ols(df, keys, y, x), keys)
    w = W.partitionBy(*keys).orderBy("dt")
    e = e.withColumn("_l", F.lag("spread").over(w)).withColumn("_d", F.col("spread") - F.col("_l")).where(F.col("_l").isNotNull())
    s = e.groupBy(*keys).agg(F.sum(F.col("_l") * F.col("_l")).alias("ll"), F.sum(F.col("_l") * F.col("_d")).alias("ld"), F.sum(F.col("_d") * F.col("_d")).alias("dd"), F.count("*").alias("n"))
    rho = F.try_divide(F.col("ld"), F.col("ll"))
    return s.select(*keys, F.try_divide(rho, F.sqrt(F.try_divide(F.col("dd") - rho * F.col("ld"), (F.col("n") - 1) * F.col("ll")))).alias("t_stat"))


def score(p="pval_min", hl="half_life", sigma="spread_change_sigma", dist="pca_distance") -> Column:
    """Higher is better; a p of 0 scores infinity, a distance of 0 or a missing value scores null."""
    p = F.col(p)
    logp = F.when(p == 0, F.lit(float("inf"))).otherwise(-F.log10(p))
    d = F.nullif(F.col(dist), F.lit(0.0))
    return F.when(d.isNotNull(), logp - 0.02 * F.col(hl) - 0.5 * F.col(sigma) + 0.1 / (1 + d))


def select_pairs(screened: DataFrame, keys: list[str], s: Pick = Pick()) -> DataFrame:
    """The best s.most of each key that pass the limits, with score and rank; null scores come last."""
    ok = screened.where((F.col("pval_min") <= s.p) & F.col("half_life").between(*s.half_life) & (F.col("overlap_n") >= s.overlap)).withColumn("score", score())
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc_nulls_last("score"), "a", "b"))
    return ok.withColumn("rank", rank).where(F.col("rank") <= s.most)


def stepped(state: np.ndarray, v: np.ndarray, s: Trade) -> np.ndarray:
    """The states after a row of z. A state is 0 (flat), or the rows that a position has been held, below 0 for a short one; held for 1 if s has no limit."""
    side = np.sign(state)
    w = v * side  # as if long: entered below, gone above
    out = w > -s.leave
    if s.stop is not None:
        out |= w < -abs(s.stop)
    if s.hold:
        out |= np.abs(state) >= s.hold
    enter = np.where(v > s.enter, -1, np.where(v < -s.enter, 1, 0))
    return np.where(np.isnan(v), 0, np.where(side == 0, enter, np.where(out, 0, state + side if s.hold else state)))


def walked(z: list[np.ndarray], state: np.ndarray, s: Trade, keep: bool) -> tuple[list[np.ndarray], np.ndarray]:
    """(the positions of each series, the states after its last row), all series in step; state: (series, states to start from)."""
    size = np.array([len(v) for v in z], int)
    order, state, out = np.argsort(-size, kind="stable"), state.copy(), [np.zeros(0, np.int64)] * len(z)
    at = 0
    while at < len(z):
        n = max(1, min(len(z) - at, ROOM // max(1, int(size[order[at]]))))  # series of like lengths
        some = order[at : at + n]
        rows = np.full((n, int(size[some[0]])), np.nan)
        inside = np.arange(rows.shape[1])[None, :] < size[some][:, None]
        rows[inside] = np.concatenate([z[k] for k in some])
        now, path = state[some], np.zeros(rows.shape if keep else (0, 0), np.int8)
        ends = np.searchsorted(-size[some], -np.arange(rows.shape[1]))  # how many series have a row there: they come first
        for t, m in enumerate(ends.tolist()):
            now[:m] = stepped(now[:m], rows[:m, t, None], s)
            if keep:
                path[:m, t] = np.sign(now[:m, 0])
        state[some] = now
        if keep:
            for k, p in zip(some, path):
                out[k] = p[: size[k]]
        at += n
    return out, state


def positions(df: DataFrame, keys: list[str], s: Trade = Trade(), z: str = "z") -> DataFrame:
    """(keys, dt, z, position): flat, long (1) or short (-1) by z with hysteresis, in the order of dt.

    A null z is flat and forgets; an exit and a new entry never share a row; a stop isn't tested on entry. Rows are dealt by ranges of
    (keys, dt), so a key of many rows is cut into pieces. What a piece does to each state that it may be entered with is a map of few states;
    the maps of a key's pieces, put one after the other, say in which state each is entered, and then all pieces are
    walked through at once. Most keys are one piece, which is entered flat.
    """
    starts = np.array([0, *(x for h in range(1, (s.hold or 1) + 1) for x in (h, -h))])
    dealt = kept(df.select(*keys, "dt", F.col(z).cast("double").alias("z")).repartitionByRange(*keys, "dt").withColumn("_piece", F.spark_partition_id()))
    pieces = dealt.groupBy(*keys, "_piece").agg(F.array_sort(F.collect_list(F.struct("dt", "z"))).alias("_rows"))
    several = dealt.select(*keys, "_piece").distinct().groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    types = T.StructType([pieces.schema[k] for k in keys])
    types = types.add("_piece", T.IntegerType())

    def series(batch):
        flat = batch.column("_rows")
        o = flat.offsets.to_numpy() - flat.offsets[0].as_py()
        return np.split(flat.flatten().field("z").to_numpy(zero_copy_only=False).astype(float), o[1:-1]) if len(flat) else []

    def mapped(batches):
        import pyarrow as pa

        for batch in batches:
            zs = series(batch)
            _, after = walked(zs, np.tile(starts, (len(zs), 1)), s, False)
            first = batch.column("_rows").flatten().field("dt").take(pa.array(batch.column("_rows").offsets.to_numpy()[:-1] - batch.column("_rows").offsets[0].as_py()))
            after = pa.ListArray.from_arrays(pa.array(np.arange(len(zs) + 1, dtype=np.int32) * len(starts)), pa.array(after.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*keys, "_piece")], first, after], names=[*keys, "_piece", "first", "after"])

    def chained(batches):
        import pyarrow as pa

        place = {int(v): n for n, v in enumerate(starts)}
        for batch in batches:
            parent, piece, state = [], [], []
            for n, maps in enumerate(batch.column("maps").to_pylist()):
                now = 0
                for m in maps:
                    parent.append(n), piece.append(m["_piece"]), state.append(now)
                    now = m["after"][place[now]]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(parent, pa.int64())) for k in keys], pa.array(piece, pa.int32()), pa.array(state, pa.int32())], names=[*keys, "_piece", "entered"])

    def placed(batches):
        import pyarrow as pa

        for batch in batches:
            zs = series(batch)
            found, _ = walked(zs, batch.column("entered").to_numpy(zero_copy_only=False).astype(np.int64)[:, None], s, True)
            offsets = pa.array(np.r_[0, np.cumsum([len(v) for v in zs])].astype(np.int32))
            found = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*found, np.zeros(0, np.int8)]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], batch.column("_rows"), found], names=[*keys, "_rows", "_positions"])

    long = T.StructType([*types.fields]).add("first", pieces.schema["_rows"].dataType.elementType["dt"].dataType).add("after", T.ArrayType(T.IntegerType()))
    if several.isEmpty():  # each key is one piece
        both = pieces.withColumn("entered", F.lit(0)).drop("_piece")
    else:
        maps = pieces.join(several, keys).mapInArrow(mapped, long).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", "_piece", "after"))).alias("maps"))
        entered = maps.mapInArrow(chained, T.StructType([*types.fields]).add("entered", T.IntegerType()))
        both = pieces.join(entered, [*keys, "_piece"], "left").withColumn("entered", F.coalesce("entered", F.lit(0))).drop("_piece")
    walked_ = both.mapInArrow(placed, T.StructType([pieces.schema[k] for k in keys]).add("_rows", pieces.schema["_rows"].dataType).add("_positions", T.ArrayType(T.IntegerType())))
    x = walked_.select(*keys, F.explode(F.arrays_zip("_rows", "_positions")).alias("x"))
    return x.select(*keys, F.col("x._rows.dt").alias("dt"), F.col("x._rows.z").alias("z"), F.col("x._positions").alias("position"))


def pair_pnl(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds pnl: the position held before times the spread's change; 0 where either is missing."""
    w = W.partitionBy(*keys).orderBy("dt")
    return df.withColumn("pnl", F.coalesce(F.lag("position").over(w), F.lit(0)) * F.coalesce(F.col("spread") - F.lag("spread").over(w), F.lit(0.0)))


def portfolio_pnl(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, "dt").agg(F.avg("pnl").alias("pnl"), F.count("pnl").alias("n_pairs"))


def pnl_wide(df: DataFrame, keys: list[str], pairs: list[tuple]) -> DataFrame:
    """Export: a column "a_b" for each pair given, null on dates without it."""
    return df.withColumn("_pair", F.concat_ws("_", "a", "b")).groupBy(*keys, "dt").pivot("_pair", [f"{a}_{b}" for a, b in pairs]).agg(F.first("pnl", ignorenulls=True))


def equity(df: DataFrame, keys: list[str], order: list[str], start: float = 1.0) -> DataFrame:
    w = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("equity", start + F.sum("pnl").over(w))


def forward_pnl(panel: DataFrame, chosen: DataFrame, keys: list[str], s: Trade = Trade()) -> DataFrame:
    """(keys, a, b, dt, spread, z, position, pnl) of chosen pairs (keys, a, b, beta) on a panel (keys, asset, dt, lp).

    The spread is that of a on b; where chosen has a column `swapped` that is true, that of b on a.
    """
    k = [*keys, "a", "b"]
    both = aligned(panel, chosen, "lp", keys, s.rows + 1)
    spread = F.col("asset1") - F.col("beta") * F.col("asset2")
    if "swapped" in chosen.columns:
        spread = F.when(F.col("swapped"), F.col("asset2") - F.col("beta") * F.col("asset1")).otherwise(spread)
    both = both.withColumn("spread", spread)
    from .panel import rolling_zscore

    z = kept(rolling_zscore(both, "spread", "z", s.rows, k).select(*k, "dt", "spread", F.round("z", 9).alias("z")))
    return pair_pnl(z.join(positions(z, k, s).select(*k, "dt", "position"), [*k, "dt"]), k)
