"""Panels in long form, (sector, asset, dt, price): build, scale, calendar and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .quotes import SHARE_CODES, adjusted_close, finite


def build(quotes: DataFrame, sectors: DataFrame) -> DataFrame:
    """Adjusted closes of common shares by sector. An asset of several sectors is in each; of several quotes a day
    the one of the smallest tie values (the order of `quotes`' key columns) counts."""
    q = quotes.where(F.col("share_code").isin(*SHARE_CODES)).withColumn("price", adjusted_close())
    return dedup(q.join(sectors, "permno").select("sector", F.col("permno").alias("asset"), F.col("date").alias("dt"), "price", "tie"))


def dedup(df: DataFrame) -> DataFrame:
    """One price for each (sector, asset, dt): the first non-null one by `tie`."""
    return df.groupBy("sector", "asset", "dt").agg(F.min_by("price", F.when(F.col("price").isNotNull(), F.col("tie"))).alias("price"))


def wide(panel: DataFrame, assets: list) -> DataFrame:
    """Export: a column for each asset given."""
    return panel.groupBy("dt").pivot("asset", assets).agg(F.first("price", ignorenulls=True))


def log_price(panel: DataFrame) -> DataFrame:
    return panel.withColumn("lp", F.ln(finite("price")))


def log_first_sector(panel: DataFrame) -> DataFrame:
    """Log prices of each asset in the first sector, by name, that holds it."""
    return log_price(panel.withColumn("_s", F.min("sector").over(W.partitionBy("asset"))).where(F.col("sector") == F.col("_s")).drop("_s"))


def demean(panel: DataFrame, value: str, out: str, keys: tuple = ("sector", "dt")) -> DataFrame:
    """Less the cross-section's mean of the date."""
    return panel.withColumn(out, F.col(value) - F.avg(value).over(W.partitionBy(*keys)))


def change(panel: DataFrame, value: str, out: str, keys: tuple = ("sector", "asset"), fill: str = "pad") -> DataFrame:
    """Relative change to the row before; "pad" carries the last value over gaps first. A change from 0 is null."""
    w = W.partitionBy(*keys).orderBy("dt")
    v = F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)) if fill == "pad" else F.col(value)
    return panel.withColumn("_v", v).withColumn(out, finite(F.try_divide(F.col("_v"), F.lag("_v").over(w)) - 1)).drop("_v")


def zscore(panel: DataFrame, value: str, out: str, keys: tuple = ("sector", "asset")) -> DataFrame:
    """Population z-score of a column; a spread of 0 divides by 1."""
    w = W.partitionBy(*keys)
    return panel.withColumn(out, (F.col(value) - F.avg(value).over(w)) / F.coalesce(F.nullif(F.stddev_pop(value).over(w), F.lit(0.0)), F.lit(1.0)))


def complete_dates(panel: DataFrame, value: str, group: tuple = ("sector",)) -> DataFrame:
    """Only dates on which no asset of the group misses the value: a count by window against the group's number of assets."""
    n = panel.groupBy(*group).agg(F.countDistinct("asset").alias("_n"))
    have = panel.withColumn("_have", F.count(value).over(W.partitionBy(*group, "dt")))
    return have.join(n, list(group)).where(F.col("_have") == F.col("_n")).drop("_have", "_n")


def scaled(panel: DataFrame, value: str = "price", group: tuple = ("sector",), demeaned: str = "prices", fill: str = "pad") -> DataFrame:
    """Changes on complete dates, as z-scores. The cross-section's mean is taken off the values before, or with demeaned="returns" off the changes."""
    if demeaned == "returns":
        d = demean(change(panel, value, "_x", (*group, "asset"), fill), "_x", "_r", (*group, "dt"))
    else:
        d = change(demean(panel, value, "_x", (*group, "dt")), "_x", "_r", (*group, "asset"), fill)
    return zscore(complete_dates(d, "_r", group), "_r", "z", (*group, "asset")).select(*group, "asset", "dt", "z")


def rolling_zscore(df: DataFrame, value: str, out: str, window: int, keys: list[str], order: str = "dt") -> DataFrame:
    """Against the mean and population deviation of the last `window` rows; null for a deviation of 0, up to rounding."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(-(window - 1), 0)
    sd = F.stddev_pop(value).over(w)
    return df.withColumn(out, F.when(sd > 1e-12, (F.col(value) - F.avg(value).over(w)) / sd))


def calendar(panel: DataFrame) -> DataFrame:
    """(dt, ord): the distinct dates, numbered from 0; a few thousand rows."""
    return panel.select("dt").distinct().withColumn("ord", F.row_number().over(W.orderBy("dt")) - 1)


def offset(cal: DataFrame, n: int) -> DataFrame:
    """(dt, back): the date n rows earlier; null where the history is shorter."""
    return cal.select("dt", F.lag("dt", n).over(W.orderBy("dt")).alias("back"))


def back_from(cal: DataFrame, days: DataFrame, n: int) -> DataFrame:
    """(dt, back) of the dates given; one that isn't in the calendar is an error."""
    known = offset(cal, n).withColumn("_known", F.lit(True))
    back = F.when(F.col("_known"), F.col("back")).otherwise(F.raise_error(F.concat(F.lit("not a trading date: "), F.col("dt").cast("string"))).cast("date"))
    return days.select("dt").join(known, "dt", "left").select("dt", back.alias("back"))


def rebalances(cal: DataFrame, start, end, months: int = 3) -> DataFrame:
    """(rebal_date, next_date): starts of periods, moved to the first calendar date on or after; the last one ends at `end`."""
    first = F.trunc(F.add_months(F.lit(start).cast("date") - 1, 1), "MM") if months == 1 else F.when(F.trunc(F.lit(start).cast("date"), "quarter") == F.lit(start).cast("date"), F.lit(start).cast("date")).otherwise(F.add_months(F.trunc(F.lit(start).cast("date"), "quarter"), 3))
    starts = cal.agg(F.max("dt").alias("last")).select(F.explode(F.sequence(first, F.lit(end).cast("date"), F.expr(f"interval {months} month"))).alias("s"), "last").where(F.col("s") <= F.col("last"))
    dates = starts.join(cal, F.col("dt") >= F.col("s")).groupBy("s").agg(F.min("dt").alias("rebal_date")).select("rebal_date").distinct()
    return dates.withColumn("next_date", F.coalesce(F.lead("rebal_date").over(W.orderBy("rebal_date")), F.lit(end).cast("date")))


def schedule(cal: DataFrame) -> DataFrame:
    """(rebal_date, selection_date): first date of each month and the calendar date before; the first month is left out."""
    before = cal.select("dt", F.lag("dt").over(W.orderBy("dt")).alias("selection_date"))
    months = cal.groupBy(F.trunc("dt", "MM").alias("m")).agg(F.min("dt").alias("dt"))
    return months.join(before, "dt").where(F.col("selection_date").isNotNull()).select(F.col("dt").alias("rebal_date"), "selection_date")


def trailing(panel: DataFrame, cal: DataFrame, dates: DataFrame, n: int, least: int | None = None) -> DataFrame:
    """The last n calendar rows up to each rebalance date, that included; dates with fewer than `least` (n) rows are left out.

    A row names the rebalances it serves by the ordinals they span, so the join is an equi-join on ord."""
    r = dates.join(cal, F.col("rebal_date") == F.col("dt")).where(F.col("ord") >= (least or n) - 1)
    r = r.select("rebal_date", F.explode(F.sequence(F.greatest(F.col("ord") - (n - 1), F.lit(0)), F.col("ord"))).alias("ord"))
    return panel.join(cal, "dt").join(r, "ord")


def forward(panel: DataFrame, cal: DataFrame, dates: DataFrame, half_open: bool = False) -> DataFrame:
    """Rows from a rebalance date to the next one; a boundary date is in both, or with half_open only in the later one.

    The calendar's dates, a few thousand, are matched with the rebalances; the panel joins by equal dates."""
    inside = (F.col("dt") >= F.col("rebal_date")) & ((F.col("dt") < F.col("next_date")) if half_open else (F.col("dt") <= F.col("next_date")))
    return panel.join(cal.select("dt").join(dates, inside), "dt")


def in_force(cal: DataFrame, selected: DataFrame) -> DataFrame:
    """On each calendar date the selection of the latest rebalance date on or before."""
    dates = selected.select(F.col("rebal_date").alias("dt"), F.col("rebal_date").alias("_r")).distinct()
    latest = cal.join(dates, "dt", "left").withColumn("rebal_date", F.last("_r", ignorenulls=True).over(W.orderBy("dt").rowsBetween(W.unboundedPreceding, 0)))
    return latest.select("dt", "rebal_date").join(selected, "rebal_date")
