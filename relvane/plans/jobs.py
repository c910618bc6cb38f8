"""Jobs over all sectors and all dates at once: screening, the rolling evaluation and portfolios.

Results that several later steps read (calendar, windows, loadings, candidates, aligned pairs, tests) are written as tables in
a shared folder: plans stay short, and what a lost executor had made is read again, not computed again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators import clusters, models, moments, pairs, panel
from ..params import Fit, Pick, Trade
from ..schemas import SCHEMAS, conform
from ..sources.tables import kept, write_artifact

KEYS = ["sector", "rebal_date"]


def windows_of(prices: DataFrame, cal: DataFrame, dates: DataFrame, n: int, full: bool = True, least: int | None = None) -> DataFrame:
    """(sector, rebal_date, asset, dt, price, ...): trailing windows; with full, only assets with a price on the window's first date."""
    w = panel.trailing(prices, cal, dates, n, least)
    if not full:
        return w
    first = F.min("dt").over(W.partitionBy(*KEYS))
    has = F.max(F.when((F.col("dt") == F.col("_first")) & F.col("price").isNotNull(), 1)).over(W.partitionBy(*KEYS, "asset"))
    return w.withColumn("_first", first).withColumn("_has", has).where(F.col("_has") == 1).drop("_first", "_has")


def factors(prices: DataFrame, cal: DataFrame, dates: DataFrame, n: int, passes: int = 1, least: int | None = None, demeaned: str = "prices"):
    """(loadings, ratios, scores) of the scaled returns of each (sector, rebal_date), from n rows back (`least` at least)."""
    z = kept(windows_of(prices, cal, dates, n, least=least).select(*KEYS, "asset", "dt", "price"))
    for _ in range(passes):
        z = kept(panel.scaled(z, "price", tuple(KEYS), demeaned).withColumnRenamed("z", "price"))
    return models.pca(z.withColumnRenamed("price", "z"), KEYS)


def candidates(labels: DataFrame, loadings: DataFrame, k: int | None = None) -> DataFrame:
    """(keys, a, b, cluster_id, pca_distance) of in-cluster pairs."""
    vec = F.col("vec") if k is None else F.slice("vec", 1, k)
    both = labels.join(loadings.select(*KEYS, "asset", vec.alias("vec")), [*KEYS, "asset"])
    a = both.where("label != -1").select(*KEYS, "label", F.col("asset").alias("a"), F.col("vec").alias("va"))
    b = both.select(*KEYS, "label", F.col("asset").alias("b"), F.col("vec").alias("vb"))
    return a.join(b, [*KEYS, "label"]).where("a < b").select(*KEYS, "a", "b", F.col("label").alias("cluster_id"), pairs.distance("va", "vb").alias("pca_distance"))


def spans_of(cal: DataFrame, dates: DataFrame, n: int) -> DataFrame:
    """(rebal_date, lo, hi): the n calendar rows up to each date, by their ordinals; dates with fewer rows are left out."""
    r = dates.select("rebal_date").distinct().join(cal, F.col("rebal_date") == F.col("dt")).where(F.col("ord") >= n - 1)
    return r.select("rebal_date", (F.col("ord") - (n - 1)).alias("lo"), F.col("ord").alias("hi"))


def screen(prices: DataFrame, cal: DataFrame, dates: DataFrame, cand: DataFrame, n: int, min_overlap: int, lags: int | None = None) -> DataFrame:
    """Candidates with both-way cointegration, and regression, half-life and deviation in the winning direction, from n rows up to the date.

    A pair's series travel once, whatever the number of its dates, and its windows are differences of running sums. lags: the
    number of lags of the test, else chosen by AIC.
    """
    arrays = kept(moments.series(panel.log_price(prices), cal, ["sector"]))
    spans = cand.join(spans_of(cal, dates, n), "rebal_date").withColumn("least", F.lit(min_overlap))
    tested = moments.winning(moments.windowed(spans, arrays, ["sector"], lags=lags), tie_first=True)
    out = tested.withColumn("best_direction", F.when(F.col("first"), "a_on_b").otherwise("b_on_a"))
    out = out.withColumnsRenamed({"p_value": "pval_min", "n_obs": "overlap_n", "change_sigma": "spread_change_sigma"})
    return out.select(*KEYS, "a", "b", "cluster_id", "pca_distance", "t_stat", "pval_min", "overlap_n", "alpha", "beta", "spread_change_sigma", "half_life", "best_direction")


def rolling(prices: DataFrame, dates: DataFrame, w: Fit = Fit(), pick: Pick = Pick(), s: Trade = Trade(), k: int = 6, passes: int = 2, half_open: bool = False, direction_aware: bool = False, demeaned: str = "prices") -> dict[str, DataFrame]:
    """The results of a panel (sector, asset, dt, price) at dates (rebal_date, next_date): loadings, labels, candidates, screened, selected,
    pair_pnl, portfolio_pnl and equity.

    A date needs w.components and w.tests rows up to it. With half_open a boundary date belongs to the later rebalance alone; with
    direction_aware the forward spread is that of the winning direction, else always a on b.
    """
    cal, dates = kept(panel.calendar(prices)), kept(dates)
    loadings, _, _ = factors(prices, cal, dates, w.components + 1, passes, w.components, demeaned)
    loadings = loadings.select(*KEYS, "asset", F.slice("vec", 1, k).alias("vec"))
    labels = kept(clusters.cluster(models.scaled_loadings(loadings, KEYS), KEYS))
    cand = kept(candidates(labels, loadings))
    return {"loadings": loadings, "labels": labels, "candidates": cand} | evaluated(prices, cal, dates, cand, w, pick, s, half_open, direction_aware)


def evaluated(prices: DataFrame, cal: DataFrame, dates: DataFrame, cand: DataFrame, w: Fit = Fit(), pick: Pick = Pick(), s: Trade = Trade(), half_open: bool = False, direction_aware: bool = False, lags: int | None = None) -> dict[str, DataFrame]:
    """screened, selected, pair_pnl, portfolio_pnl and equity of candidates (sector, rebal_date, a, b, cluster_id, pca_distance)."""
    screened = kept(screen(prices, cal, dates, cand, w.tests, w.overlap, lags))
    chosen = kept(pairs.select_pairs(screened, KEYS, pick))
    ahead = panel.log_price(panel.forward(prices, cal, dates, half_open))
    swapped = F.lit(direction_aware) & (F.col("best_direction") == "b_on_a")
    pnl = kept(pairs.forward_pnl(ahead.select(*KEYS, "asset", "dt", "lp"), chosen.select(*KEYS, "a", "b", "beta", swapped.alias("swapped")), KEYS, s))
    total = pairs.portfolio_pnl(pnl, KEYS)
    return {"screened": screened, "selected": chosen, "pair_pnl": pnl, "portfolio_pnl": total, "equity": pairs.equity(total, ["sector"], ["dt", "rebal_date"])}


def write_artifacts(results: dict[str, DataFrame], path: str) -> None:
    """A table for each result that is keyed by sector and rebalance date; those that have a schema must conform to it."""
    for name, df in results.items():
        write_artifact(conform(df, name) if name in SCHEMAS else df, path, name)


def in_order(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """df with each two columns in the winning order: swapped where `first` is false."""
    return df.withColumns({c: F.when(F.col("first"), F.col(x)).otherwise(F.col(y)) for a, b in columns for c, x, y in ((a, a, b), (b, b, a))})


def portfolio(prices: DataFrame, dates: DataFrame, w: Fit = Fit(), benchmark: float = 0.5, p_most: float = 0.05, min_obs: int = 50, spread_window: str = "full") -> DataFrame:
    """Cointegrated in-cluster pairs (permno1 on permno2, the winning order) at each date, with regression, spread deviations and half-life.

    Windows start w.components and w.tests rows before the date. A pair is tested if its sector has min_obs dates in all and neither asset misses a
    price in the window. The statistics are those of the full history (spread_window="coint": of the window), of which a
    pair has min_obs rows at least.
    """
    cal, dates = kept(panel.calendar(prices)), kept(dates)
    loadings, ratios, _ = factors(prices, cal, dates, w.components + 1)
    cut = models.relevant(ratios, KEYS, benchmark)
    loadings = kept(loadings.join(cut, KEYS).select(*KEYS, "asset", F.slice("vec", F.lit(1), F.col("k")).alias("vec")))
    labels = kept(clusters.cluster(models.scaled_loadings(loadings, KEYS), KEYS))
    lp = panel.log_price(prices)
    long = lp.groupBy("sector").agg(F.countDistinct("dt").alias("n")).where(F.col("n") >= min_obs).select("sector")
    arrays = kept(moments.series(lp, cal, ["sector"]))
    spans = kept(spans_of(cal, dates, w.tests + 1))
    days = lp.select("sector", "dt").distinct().join(cal, "dt").join(spans, F.col("ord").between(F.col("lo"), F.col("hi"))).groupBy(*KEYS).agg(F.count("*").cast("int").alias("least"))
    cand = candidates(labels, loadings).join(long, "sector").join(spans, "rebal_date").join(days, KEYS).drop("pca_distance")
    tested = moments.winning(moments.windowed(cand, arrays, ["sector"]), tie_first=False)
    tested = tested.withColumn("cointegrated", F.col("p_value") < p_most).where("cointegrated")
    if spread_window == "coint":
        tested = tested.where(F.col("n_obs") >= min_obs)
    else:
        whole = cal.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).withColumn("least", F.lit(min_obs))
        tested = kept(tested.drop(*moments.PARTS).withColumnRenamed("n_obs", "n_tested"))
        tested = moments.directed(moments.windowed(tested.crossJoin(F.broadcast(whole)), arrays, ["sector"], test=False)).drop("n_obs").withColumnRenamed("n_tested", "n_obs")  # one row of the calendar's ends
    m = (F.col("n_obs") - 1).cast("double")
    out = tested.withColumns({c: F.lit(x) + F.lit(y) / m + F.lit(z) / (m * m) for c, (x, y, z) in models.CRITICAL.items()})
    out = out.withColumns({c: F.col(c) * math.sqrt(252) for c in ("sigma", "change_sigma")})
    out = out.select(*KEYS, "a", "b", "cluster_id", "first", "t_stat", "p_value", *models.CRITICAL, "n_obs", "cointegrated", "alpha", "beta", "r2", "resid_std", "sigma", "change_sigma", "half_life")
    return in_order(out, [("a", "b")]).withColumnsRenamed({"a": "permno1", "b": "permno2"}).drop("first")
