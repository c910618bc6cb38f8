"""Quotes and reference data: interval joins to the names history, filters, links and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import filled

#: Exchange codes, link types and share classes that count.
EXCHANGES = {"NYSE": 1, "AMEX": 2, "NASDAQ": 3}
LINK_TYPES, LINK_PRIMARY, SHARE_CODES = ("LU", "LC"), ("P", "C"), (10, 11)

#: Columns of the sources by their names in the quote table.
RENAMED = {
    "comnam": "company_name", "shrcd": "share_code", "prc": "price", "vol": "volume", "ret": "return", "retx": "return_ex_dividend", "shrout": "shares_outstanding",
    "openprc": "open_price", "askhi": "ask_high", "bidlo": "bid_low", "cfacshr": "cum_factor_shares", "cfacpr": "cum_factor_price",
}
#: Days of a bin of an interval join.
BIN = 128


def finite(c) -> Column:
    """NaN and infinities as null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def between(df: DataFrame, start, end, date: str = "date") -> DataFrame:
    return df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def on_exchanges(df: DataFrame, names: list[str], code: str = "exchcd") -> DataFrame:
    """Rows of the named exchanges; unknown names count for nothing, without names there is no filter."""
    return df.where(F.col(code).isin([EXCHANGES[n] for n in names if n in EXCHANGES])) if names else df


def exchange_name(code: str = "exchcd") -> Column:
    out = F.lit(None).cast("string")
    for name, number in EXCHANGES.items():
        out = F.when(F.col(code) == number, name).otherwise(out)
    return out


def bins(day: Column, last: Column) -> Column:
    """The bin of BIN days that a date is in; dates after `last` are in its bin."""
    return F.floor(F.datediff(F.least(day, last), F.lit("1970-01-01").cast("date")) / BIN).cast("int")


def valid_at(quotes: DataFrame, names: DataFrame, how: str = "left") -> DataFrame:
    """Quotes with the names row whose inclusive interval holds the quote's date.

    An interval is repeated for each bin of dates that it meets, and rows join on (permno, bin), so a permno of many quotes is the work
    of as many tasks as it has bins, and a quote is held against the intervals of its bin alone. No interval starts after
    the last namedt, so from then on one bin will do. A quote is in one bin: no match comes twice.
    """
    last = F.broadcast(names.agg(F.max("namedt").alias("_last")))  # one row
    n = names.withColumnRenamed("permno", "_permno").crossJoin(last).withColumn("_nbin", F.explode(F.sequence(bins(F.col("namedt"), F.col("_last")), F.greatest(bins(F.col("namedt"), F.col("_last")), bins(F.col("nameendt"), F.col("_last")))))).drop("_last")
    q = quotes.crossJoin(last).withColumn("_bin", bins(F.col("date"), F.col("_last"))).drop("_last")
    match = (F.col("permno") == F.col("_permno")) & (F.col("_bin") == F.col("_nbin")) & F.col("date").between(F.col("namedt"), F.col("nameendt"))
    return q.join(n, match, how).drop("_permno", "_nbin", "_bin")


def daily(quotes: DataFrame, names: DataFrame, start, end, exchanges: list[str] = ()) -> DataFrame:
    """Quotes of a range of dates with their names, as the table `quotes`; columns that the sources lack are null."""
    df = on_exchanges(valid_at(between(quotes, start, end), names), list(exchanges))
    return filled(df.withColumnsRenamed({k: v for k, v in RENAMED.items() if k in df.columns}), "quotes")


def names_on(names: DataFrame, day) -> DataFrame:
    return names.where(F.lit(day).cast("date").between(F.col("namedt"), F.col("nameendt"))).distinct()


def market_cap(price: str = "prc", shares: str = "shrout") -> Column:
    return F.abs(price) * F.col(shares) * 1000


def adjusted_close(price: str = "prc", factor: str = "cfacpr") -> Column:
    """abs(price) / factor; null for a factor of 0. Negative prices stand for quote midpoints."""
    return F.try_divide(F.abs(price), F.col(factor))


def clean(quotes: DataFrame, names: DataFrame, exchanges: list[str]) -> DataFrame:
    """Quotes with names, positive price, market value and exchange name; with exchanges, the join is an inner one."""
    df = on_exchanges(valid_at(quotes, names), exchanges)
    return df.withColumns({"market_cap": market_cap(), "exchange_name": exchange_name()}).withColumn("prc", F.abs("prc"))


def sector_map(company: DataFrame, link: DataFrame) -> DataFrame:
    """(permno, sector string, industry), distinct, of primary links of the right types with a sector."""
    df = link.where(F.col("linktype").isin(*LINK_TYPES) & F.col("linkprim").isin(*LINK_PRIMARY) & F.col("permno").isNotNull())
    return df.join(company.where(F.col("gsector").isNotNull()), "gvkey").select("permno", F.col("gsector").cast("string").alias("sector"), F.col("gind").alias("industry")).distinct()


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, n, pct): non-null values of each column; one pass."""
    agg = df.agg(F.count("*").alias("_all"), *[F.count(c).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n")) for c in columns])).alias("x")
    return agg.select("_all", rows).select("x.field", "x.n", F.try_divide(F.col("x.n") * 100.0, F.col("_all")).alias("pct"))


def first_per_key(df: DataFrame, key: str, order: list[str], columns: list[str], n: int = 10) -> DataFrame:
    """First non-null value of each column in the given order, for the first n keys."""
    o = F.struct(*order)
    return df.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), o)).alias(c) for c in columns]).orderBy(key).limit(n)


def summary(df: DataFrame, asset: str, date: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.min(date).alias("first_dt"), F.max(date).alias("last_dt"), F.countDistinct(asset).alias("assets"), F.countDistinct(date).alias("days"), F.countDistinct(F.year(date)).alias("years"))
