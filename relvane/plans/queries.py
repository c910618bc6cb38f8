"""Registered queries on the fixture views, and the same in SQL for an engine that has the tables only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clusters, models, moments, neighbours, pairs, panel, quotes
from ..params import Fit, Pick, Trade
from ..sources import tables
from ..sources.fixtures import view, with_views
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
PAIR = ["sector", "a", "b"]
TRADE = Trade(8, 1.0, 0.25, 3.0, 8)
START, END = "1993-01-01", "1998-12-31"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_views(sql.strip())
        return f

    return add


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def r9(name: str):
    """For sums of multiples of 1e-7: no rounding falls on a tie, and there is no negative zero."""
    return (F.round(name, 9) + 0.0).alias(name)


# quotes and reference data


@query("select permno, date, l_orderkey, l_linenumber, prc, shrout, cfacpr from fx_daily where date between date '1994-01-01' and date '1995-12-31'")
def quotes_scan(spark, d):
    return quotes.between(view(spark, d, "fx_daily"), "1994-01-01", "1995-12-31")


@query("""select q.permno, cast(null as bigint) as permco, date, o_orderpriority as ticker, cast(null as varchar) as company_name, exchcd, 9 + cast(substr(o_orderpriority, 1, 1) as integer) as share_code, cast(prc as double) as price, cast(null as double) as volume,
 cast(null as double) as "return", cast(null as double) as return_ex_dividend, cast(shrout as double) as shares_outstanding, cast(null as double) as open_price, cast(null as double) as ask_high, cast(null as double) as bid_low, cast(null as double) as cum_factor_shares, round(cast(cfacpr as double), 6) as cum_factor_price
 from fx_daily q join fx_names n on q.permno = n.permno and date between namedt and nameendt where date between date '1994-01-01' and date '1995-12-31' and exchcd in (1, 3)""")
def quotes_daily(spark, d):
    """All columns of the quote table, of two exchanges and two years."""
    n = view(spark, d, "fx_names").withColumn("ticker", F.col("o_orderpriority")).withColumn("shrcd", F.substring("o_orderpriority", 1, 1).cast("int") + 9)
    out = quotes.daily(view(spark, d, "fx_daily"), n, "1994-01-01", "1995-12-31", ["NYSE", "NASDAQ"])
    return out.withColumn("cum_factor_price", F.round("cum_factor_price", 6))


@query("select cast(year(date) as integer) as year, count(*) as n from fx_daily group by 1")
def quotes_by_year(spark, d):
    at = tables.new_folder(spark)
    tables.write_by_year(view(spark, d, "fx_daily"), at)
    return spark.read.parquet(at).groupBy("year").agg(F.count("*").alias("n"))


@query("select cast(year(date) as integer) as year, count(*) as n, count(distinct permno) as permnos from fx_daily where year(date) between 1994 and 1996 group by 1")
def year_pruned_scan(spark, d):
    at = tables.new_folder(spark)
    tables.write_by_year(view(spark, d, "fx_daily"), at)
    return tables.read_quotes(spark, at, 1994, 1996).groupBy("year").agg(F.count("*").alias("n"), F.countDistinct("permno").alias("permnos"))


@query("select permno, namedt, exchcd from fx_names where exchcd in (1, 3)")
def exchange_filter(spark, d):
    return quotes.on_exchanges(view(spark, d, "fx_names"), ["NYSE", "NASDAQ", "no such"]).select("permno", "namedt", "exchcd")


@query("select q.permno, date, l_orderkey, l_linenumber, prc, namedt, exchcd from fx_daily q join fx_names n on q.permno = n.permno and date between namedt and nameendt where exchcd in (1, 2)")
def interval_join(spark, d):
    out = quotes.on_exchanges(quotes.valid_at(view(spark, d, "fx_daily"), view(spark, d, "fx_names")), ["NYSE", "AMEX"])
    return out.select("permno", "date", "l_orderkey", "l_linenumber", "prc", "namedt", "exchcd")


@query("select q.permno, date, l_orderkey, l_linenumber, namedt, exchcd from fx_daily q left join fx_names n on q.permno = n.permno and date between namedt and nameendt")
def interval_join_left(spark, d):
    return quotes.valid_at(view(spark, d, "fx_daily"), view(spark, d, "fx_names")).select("permno", "date", "l_orderkey", "l_linenumber", "namedt", "exchcd")


@query("select distinct permno, o_orderpriority, namedt, nameendt, exchcd from fx_names where date '1996-06-30' between namedt and nameendt")
def names_snapshot(spark, d):
    return quotes.names_on(view(spark, d, "fx_names").drop("o_orderstatus"), "1996-06-30")


@query("select permno, namedt, case exchcd when 1 then 'NYSE' when 2 then 'AMEX' when 3 then 'NASDAQ' end as exchange from fx_names")
def exchange_name(spark, d):
    return view(spark, d, "fx_names").select("permno", "namedt", quotes.exchange_name().alias("exchange"))


@query("select case exchcd when 1 then 'NYSE' when 2 then 'AMEX' when 3 then 'NASDAQ' end as exchange, count(*) as n from fx_names group by 1")
def exchange_counts(spark, d):
    return view(spark, d, "fx_names").groupBy(quotes.exchange_name().alias("exchange")).agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("select l_orderkey, l_linenumber, round(cast(abs(prc) * shrout * 1000 as double), 4) as market_cap from fx_daily")
def market_cap(spark, d):
    return view(spark, d, "fx_daily").select("l_orderkey", "l_linenumber", F.round(quotes.market_cap().cast("double"), 4).alias("market_cap"))


@query("""select l_orderkey, l_linenumber, round(abs(prc) / nullif(cfacpr, 0), 6) as adj from fx_daily q join fx_names n on q.permno = n.permno and date between namedt and nameendt
 where 9 + cast(substr(o_orderpriority, 1, 1) as integer) in (10, 11)""")
def adj_close(spark, d):
    q = quotes.valid_at(view(spark, d, "fx_daily"), view(spark, d, "fx_names"), "inner")
    q = q.where((F.substring("o_orderpriority", 1, 1).cast("int") + 9).isin(*quotes.SHARE_CODES))
    return q.select("l_orderkey", "l_linenumber", F.round(quotes.adjusted_close(), 6).alias("adj"))


@query("""select 'exchcd' as field, count(exchcd) as n, round(100.0 * count(exchcd) / count(*), 6) as pct from fx_daily q left join fx_names n on q.permno = n.permno and date between namedt and nameendt
 union all select 'prc', count(prc), round(100.0 * count(prc) / count(*), 6) from fx_daily union all select 'shrout', count(shrout), round(100.0 * count(shrout) / count(*), 6) from fx_daily""")
def completeness(spark, d):
    q = quotes.valid_at(view(spark, d, "fx_daily"), view(spark, d, "fx_names"))
    return quotes.completeness(q, ["exchcd", "prc", "shrout"]).select("field", "n", *r6("pct"))


@query("select o_orderpriority as ticker, arg_min(permno, (namedt, permno)) as permno, arg_min(exchcd, (namedt, permno)) as exchcd from fx_names group by 1 order by 1 limit 10")
def sample_per_key(spark, d):
    n = view(spark, d, "fx_names").withColumnRenamed("o_orderpriority", "ticker").withColumn("p", F.col("permno"))
    return quotes.first_per_key(n, "ticker", ["namedt", "p"], ["permno", "exchcd"])


@query("""select q.permno, l_orderkey, l_linenumber, abs(prc) as prc, round(cast(abs(prc) * shrout * 1000 as double), 4) as market_cap, case exchcd when 1 then 'NYSE' when 2 then 'AMEX' when 3 then 'NASDAQ' end as exchange_name
 from fx_daily q join fx_names n on q.permno = n.permno and date between namedt and nameendt where exchcd in (1, 3)""")
def clean_quotes(spark, d):
    out = quotes.clean(view(spark, d, "fx_daily"), view(spark, d, "fx_names"), ["NYSE", "NASDAQ"])
    return out.select("permno", "l_orderkey", "l_linenumber", "prc", F.round(F.col("market_cap").cast("double"), 4).alias("market_cap"), "exchange_name")


SECTORS = "select distinct permno, cast(gsector as varchar) as sector from fx_link join fx_company using (gvkey) where gsector is not null and linktype in ('LU','LC') and linkprim in ('P','C')"


@query(SECTORS)
def sector_map(spark, d):
    return quotes.sector_map(view(spark, d, "fx_company"), view(spark, d, "fx_link")).select("permno", "sector").distinct()


@query(f"select q.permno, l_orderkey, l_linenumber, sector from fx_daily q join ({SECTORS}) m on q.permno = m.permno")
def sector_enrich(spark, d):
    return view(spark, d, "fx_daily").join(sector_map(spark, d), "permno").select("permno", "l_orderkey", "l_linenumber", "sector")


@query(f"""select sector, q.permno as asset, date as dt, arg_min(abs(prc) / nullif(cfacpr, 0), (l_orderkey, l_linenumber, prc, cfacpr)) as price
 from fx_daily q join fx_names n on q.permno = n.permno and date between namedt and nameendt join ({SECTORS}) m on q.permno = m.permno
 where 9 + cast(substr(o_orderpriority, 1, 1) as integer) in (10, 11) group by 1, 2, 3""")
def build_panel(spark, d):
    q = quotes.valid_at(view(spark, d, "fx_daily"), view(spark, d, "fx_names"), "inner").withColumn("share_code", F.substring("o_orderpriority", 1, 1).cast("int") + 9)
    return panel.build(q.withColumn("tie", F.struct("l_orderkey", "l_linenumber", "prc", "cfacpr")), sector_map(spark, d)).select("sector", "asset", "dt", "price")


# panels and the calendar


@query("select asset, dt, price from fx_panel where sector = '1'")
def panel_sector(spark, d):
    at = tables.new_folder(spark)
    tables.write_panel(view(spark, d, "fx_panel"), at)
    return tables.read_panel(spark, at, "1").select("asset", "dt", "price")


@query("select sector, asset, dt, price from fx_panel where dt between date '1995-01-01' and date '1995-06-30'")
def panel_date_slice(spark, d):
    return quotes.between(view(spark, d, "fx_panel"), "1995-01-01", "1995-06-30", "dt").select("sector", "asset", "dt", "price")


@query("select count(*) as n, min(dt) as first_dt, max(dt) as last_dt, count(distinct asset) as assets, count(distinct dt) as days, count(distinct year(dt)) as years from fx_panel")
def panel_summary(spark, d):
    return quotes.summary(view(spark, d, "fx_panel"), "asset", "dt")


@query("select 'all' as sector, permno as asset, date as dt, arg_min(abs(prc), (l_orderkey, l_linenumber, prc, cfacpr)) as price from fx_daily group by 2, 3")
def panel_dedup(spark, d):
    q = view(spark, d, "fx_daily").select(F.lit("all").alias("sector"), F.col("permno").alias("asset"), F.col("date").alias("dt"), F.abs("prc").alias("price"), F.struct("l_orderkey", "l_linenumber", "prc", "cfacpr").alias("tie"))
    return panel.dedup(q).select("sector", "asset", "dt", "price")


@query("select dt, " + ", ".join(f"max(price) filter (where asset = {i}) as a{i}" for i in range(25)) + " from fx_panel group by dt")
def panel_pivot(spark, d):
    out = panel.wide(view(spark, d, "fx_panel"), list(range(25)))
    return out.select("dt", *[F.col(str(i)).alias(f"a{i}") for i in range(25)])


@query("select sector, asset, dt, round(ln(case when price > 0 then price end), 6) as lp from fx_walk")
def log_price(spark, d):
    return panel.log_price(view(spark, d, "fx_walk")).select("sector", "asset", "dt", *r6("lp"))


@query("select asset, dt, round(ln(price), 6) as lp from (select *, min(sector) over (partition by asset) as s from fx_walk) t where sector = s")
def log_series_first_sector(spark, d):
    return panel.log_first_sector(view(spark, d, "fx_walk")).select("asset", "dt", *r6("lp"))


@query("select sector, asset, dt, round(price - avg(price) over (partition by sector, dt), 6) as x from fx_panel")
def xs_demean(spark, d):
    return panel.demean(view(spark, d, "fx_panel"), "price", "x").select("sector", "asset", "dt", *r6("x"))


@query("select sector, asset, dt, round(price / nullif(lag(price) over (partition by sector, asset order by dt), 0) - 1, 6) as r from fx_panel")
def pct_change(spark, d):
    return panel.change(view(spark, d, "fx_panel"), "price", "r").select("sector", "asset", "dt", *r6("r"))


@query("select sector, asset, dt, round((price - avg(price) over w) / coalesce(nullif(stddev_pop(price) over w, 0), 1), 6) as z from fx_panel window w as (partition by sector, asset)")
def zscore(spark, d):
    return panel.zscore(view(spark, d, "fx_panel"), "price", "z").select("sector", "asset", "dt", *r6("z"))


@query("""with x as (select *, price - avg(price) over (partition by sector, dt) as x from fx_panel),
 r as (select *, x / nullif(lag(x) over (partition by sector, asset order by dt), 0) - 1 as r from x),
 n as (select sector, count(distinct asset) as n from r group by 1), h as (select sector, dt, count(r) as h from r group by 1, 2),
 c as (select r.* from r join n using (sector) join h using (sector, dt) where h = n)
 select sector, asset, dt, round((r - avg(r) over w) / coalesce(nullif(stddev_pop(r) over w, 0), 1), 5) as z from c window w as (partition by sector, asset)""")
def scaled_returns(spark, d):
    return panel.scaled(view(spark, d, "fx_panel")).select("sector", "asset", "dt", F.round("z", 5).alias("z"))


@query("select sector, asset, dt, round((price - avg(price) over w) / nullif(stddev_pop(price) over w, 0), 5) as z from fx_panel window w as (partition by sector, asset order by dt rows between 7 preceding and current row)")
def rolling_zscore(spark, d):
    return panel.rolling_zscore(view(spark, d, "fx_panel"), "price", "z", 8, ["sector", "asset"]).select("sector", "asset", "dt", F.round("z", 5).alias("z"))


@query("select dt, lag(dt, 52) over (order by dt) as back from fx_calendar")
def calendar_offset(spark, d):
    return panel.offset(panel.calendar(view(spark, d, "fx_panel")), 52)


REBALANCES = f"""r as (select distinct (select min(dt) from fx_calendar c where c.dt >= s) as rebal_date from (select cast(unnest(generate_series(date '{START}', date '{END}', interval 3 month)) as date) as s) t where s <= (select max(dt) from fx_calendar)),
 s as (select rebal_date, coalesce(lead(rebal_date) over (order by rebal_date), date '{END}') as next_date from r)"""


def dates_of(spark, d):
    return panel.rebalances(panel.calendar(view(spark, d, "fx_panel")), START, END)


@query(f"with {REBALANCES} select rebal_date, next_date from s")
def rebalance_asof(spark, d):
    return dates_of(spark, d)


@query("""with b as (select dt, lag(dt) over (order by dt) as selection_date from fx_calendar), m as (select min(dt) as dt from fx_calendar group by date_trunc('month', dt))
 select m.dt as rebal_date, selection_date from m join b on m.dt = b.dt where selection_date is not null""")
def schedule(spark, d):
    return panel.schedule(panel.calendar(view(spark, d, "fx_panel")))


@query(f"""with {REBALANCES}, o as (select rebal_date, ord from s join fx_calendar on dt = rebal_date where ord >= 51)
 select rebal_date, sector, asset, count(*) as n, round(avg(price), 6) as mean from o join fx_calendar c on c.ord between o.ord - 51 and o.ord join fx_panel p on p.dt = c.dt group by 1, 2, 3""")
def trailing_window(spark, d):
    p = view(spark, d, "fx_panel")
    return panel.trailing(p, panel.calendar(p), dates_of(spark, d), 52).groupBy("rebal_date", "sector", "asset").agg(F.count("*").alias("n"), F.round(F.avg("price"), 6).alias("mean"))


@query(f"with {REBALANCES} select rebal_date, next_date, sector, asset, dt from fx_panel join s on dt between rebal_date and next_date")
def forward_windows(spark, d):
    p = view(spark, d, "fx_panel")
    return panel.forward(p, panel.calendar(p), dates_of(spark, d)).select("rebal_date", "next_date", "sector", "asset", "dt")


@query("select sector, count(*) as n, round(sum(price), 4) as total from fx_panel group by 1")
def sink_roundtrip(spark, d):
    at = tables.new_folder(spark)
    tables.write_csv(view(spark, d, "fx_panel"), at)
    back = spark.read.csv(at, header=True, schema="dt date, asset long, sector string, price double")
    return back.groupBy("sector").agg(F.count("*").alias("n"), F.round(F.sum("price"), 4).alias("total"))


# pairs


@query("select a.vec_id as a, b.vec_id as b, a.label from embeddings a join embeddings b on a.label = b.label and a.vec_id < b.vec_id where a.label <> -1")
def candidate_pairs(spark, d):
    return pairs.combinations(view(spark, d, "embeddings").select(F.lit(0).alias("k"), F.col("vec_id").alias("asset"), "label"), ["k"]).select("a", "b", "label")


DISTANCES = "select a.vec_id as a, b.vec_id as b, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: power(cast(x[1] as double) - cast(x[2] as double), 2)))) as dist from embeddings a join embeddings b on a.label = b.label"


@query(f"select a, b, round(dist, 6) as dist from ({DISTANCES} and a.vec_id < b.vec_id) t")
def loading_distance(spark, d):
    e = view(spark, d, "embeddings").select("label", F.col("vec_id").alias("asset"), F.col("embedding").alias("vec"))
    return pairs.distances(e, ["label"], 6).select("a", "b", "dist")


@query(f"select a, round(min(dist), 6) as dist from ({DISTANCES} and a.vec_id <> b.vec_id) t group by a")
def nn_distance(spark, d):
    e = view(spark, d, "embeddings").select("label", F.col("vec_id").alias("asset"), F.col("embedding").alias("vec"))
    return neighbours.nearest(e, ["label"]).select(F.col("asset").alias("a"), *r6("dist"))


ALIGNED = """al as (select * from (select x.sector, x.asset as a, y.asset as b, x.dt, ln(x.price) as asset1, ln(y.price) as asset2, count(*) over (partition by x.sector, x.asset, y.asset) as n_obs
 from fx_walk x join fx_walk y on x.sector = y.sector and x.dt = y.dt and x.asset < y.asset) t where n_obs >= 50)"""
WIDE = ALIGNED.replace("fx_walk", "fx_wide_walk")
FITS = "f as (select sector, a, b, regr_intercept(asset1, asset2) as alpha, regr_slope(asset1, asset2) as beta from al group by 1, 2, 3), sp as (select al.*, alpha, beta, asset1 - alpha - beta * asset2 as spread from al join f using (sector, a, b))"


def aligned(spark, d, name="fx_walk"):
    lp = panel.log_price(view(spark, d, name))
    both = pairs.combinations(lp.select("sector", "asset").distinct().withColumn("label", F.lit(0)), ["sector"]).drop("label")
    return pairs.aligned(lp, both, "lp", ["sector"]).select(*PAIR, "dt", "asset1", "asset2", "n_obs")


def spreads(spark, d, name="fx_walk"):
    x = aligned(spark, d, name)
    return pairs.with_spread(x, pairs.ols(x, PAIR), PAIR)


@query(f"with {ALIGNED} select sector, a, b, dt, round(asset1, 6) as asset1, round(asset2, 6) as asset2, n_obs from al")
def pair_align(spark, d):
    return aligned(spark, d).select(*PAIR, "dt", *r6("asset1", "asset2"), "n_obs")


@query(f"with {ALIGNED}, {FITS} select sector, a, b, round(regr_intercept(asset1, asset2), 6) as alpha, round(regr_slope(asset1, asset2), 6) as beta, round(regr_r2(asset1, asset2), 6) as r2, round(stddev_samp(spread), 6) as resid_std from sp group by 1, 2, 3")
def ols_hedge(spark, d):
    return pairs.ols(aligned(spark, d), PAIR).select(*PAIR, *r6("alpha", "beta", "r2", "resid_std"))


STATS = f"with {ALIGNED}, {FITS}, l as (select *, lag(spread) over (partition by sector, a, b order by dt) as p from sp)"
HALF = "case when count(p) >= 3 and regr_slope(spread - p, p) < 0 then round(-ln(2) / regr_slope(spread - p, p), 4) else cast('infinity' as double) end as half_life"


@query(f"{STATS} select sector, a, b, round(stddev_samp(spread) * sqrt(252), 6) as sigma, round(stddev_samp(spread - p) * sqrt(252), 6) as change_sigma from l group by 1, 2, 3")
def spread_vol(spark, d):
    return pairs.spread_stats(spreads(spark, d), PAIR).select(*PAIR, *r6("sigma", "change_sigma"))


@query(f"{STATS} select sector, a, b, {HALF} from l group by 1, 2, 3")
def spread_half_life(spark, d):
    return pairs.spread_stats(spreads(spark, d), PAIR).select(*PAIR, F.round("half_life", 4).alias("half_life"))


@query(f"{STATS} select sector, a, b, round(min(alpha), 6) as alpha, round(min(beta), 6) as beta, round(stddev_samp(spread) * sqrt(252), 6) as sigma, round(stddev_samp(spread - p) * sqrt(252), 6) as change_sigma, {HALF} from l group by 1, 2, 3")
def spread_stats(spark, d):
    """From running sums: series travel as arrays, and no long rows of a pair are made."""
    arrays, both = arrays_of(spark, d, "fx_walk")
    s = moments.directed(moments.windowed(both.withColumn("first", F.lit(True)), arrays, ["sector"], test=False))
    year = lambda c: F.round(F.col(c) * math.sqrt(252), 6).alias(c)
    return s.select(*PAIR, *r6("alpha", "beta"), year("sigma"), year("change_sigma"), F.round("half_life", 4).alias("half_life"))


@query(f"""{STATS}, s as (select sector, a, b, sum(p * p) as ll, sum(p * (spread - p)) as ld, sum((spread - p) * (spread - p)) as dd, count(*) as n from l where p is not null group by 1, 2, 3)
 select sector, a, b, round((ld / ll) / sqrt((dd - ld / ll * ld) / ((n - 1) * ll)), 5) as t_stat from s""")
def df0_stat(spark, d):
    return pairs.dickey_fuller(aligned(spark, d), PAIR).select(*PAIR, F.round("t_stat", 5).alias("t_stat"))


#: A screen of plain aggregates of all pairs of the wide panel: the level of the Dickey-Fuller statistic (as 10 ** t), half-life, change deviation,
#: the distance of the fit from b alone, and common rows; rounded before they are compared.
SCREENED = WIDE + """, f as (select sector, a, b, regr_intercept(asset1, asset2) as alpha, regr_slope(asset1, asset2) as beta from al group by 1, 2, 3), sp as (select al.*, alpha, beta, asset1 - alpha - beta * asset2 as spread from al join f using (sector, a, b)),
 l as (select *, lag(spread) over (partition by sector, a, b order by dt) as p from sp),
 m as (select sector, a, b, sum(p * p) as ll, sum(p * (spread - p)) as ld, sum((spread - p) * (spread - p)) as dd, count(p) as n, count(*) as overlap_n, regr_slope(spread - p, p) as phi, stddev_samp(spread - p) as s, min(beta) as beta from l group by 1, 2, 3),
 sc as (select sector, a, b, round(power(10, ld / ll / sqrt((dd - ld / ll * ld) / ((n - 1) * ll))), 6) as pval_min, round(case when phi < 0 then -ln(2) / phi else cast('infinity' as double) end, 4) as half_life,
 round(s, 6) as spread_change_sigma, round(abs(1 - beta), 6) as pca_distance, cast(overlap_n as integer) as overlap_n from m)"""
SCORE = """case when nullif(pca_distance, 0) is not null then case when pval_min = 0 then cast('infinity' as double) else -log10(nullif(pval_min, 0)) end - 0.02 * half_life - 0.5 * spread_change_sigma + 0.1 / (1 + pca_distance) end"""


def screened(spark, d):
    al = tables.kept(aligned(spark, d, "fx_wide_walk"))
    fits = pairs.ols(al, PAIR)
    stats = pairs.spread_stats(pairs.with_spread(al, fits, PAIR), PAIR, year=1)
    level = pairs.dickey_fuller(al, PAIR).withColumn("pval_min", F.round(F.pow(F.lit(10.0), F.col("t_stat")), 6))
    out = fits.join(stats, PAIR).join(level, PAIR)
    out = out.select(*PAIR, "pval_min", F.round("half_life", 4).alias("half_life"), F.round("change_sigma", 6).alias("spread_change_sigma"), F.round(F.abs(1 - F.col("beta")), 6).alias("pca_distance"), F.col("n_obs").cast("int").alias("overlap_n"))
    return tables.kept(out)


@query(f"with {SCREENED} select sector, a, b, round({SCORE}, 6) as score from sc")
def pair_score(spark, d):
    return screened(spark, d).select(*PAIR, F.round(pairs.score(), 6).alias("score"))


@query(f"""with {SCREENED}, k as (select *, row_number() over (partition by sector order by {SCORE} desc nulls last, a, b) as rank from sc where pval_min <= 0.05 and half_life between 0.1 and 60 and overlap_n >= 50)
 select sector, a, b, round({SCORE}, 6) as score, cast(rank as integer) as rank from k where rank <= 3""")
def select_pairs(spark, d):
    return pairs.select_pairs(screened(spark, d), ["sector"], Pick(3, 0.05, (0.1, 60), 50)).select(*PAIR, *r6("score"), "rank")


@query(f"with {SCREENED} select sector, a, b, pval_min from sc where pval_min < 0.05")
def cointegrated_union(spark, d):
    at = tables.new_folder(spark)
    found = screened(spark, d).withColumn("cointegrated", F.col("pval_min") < 0.05)
    tables.write_panel(found, at)
    return tables.read_panel(spark, at, schema=found.schema).where("cointegrated").select(*PAIR, "pval_min")


# positions and results

ZED = f"""z as (select sector, a, b, dt, spread, round((spread - avg(spread) over w) / nullif(stddev_pop(spread) over w, 0), 9) as z from (select *, asset1 - beta * asset2 as spread from (select al.*, 1.0 as beta from al) u) t
 window w as (partition by sector, a, b order by dt rows between 7 preceding and current row)), n as (select *, row_number() over (partition by sector, a, b order by dt) as i from z)"""
POSITIONS = f"""with recursive {ALIGNED}, {ZED}, p as (
 select sector, a, b, dt, spread, z, i, 0 as hold, 0 as position from (select *, 1 from n where i = 1) t
 union all select n.sector, n.a, n.b, n.dt, n.spread, n.z, n.i,
  case when n.z is null then 0 when p.position = 0 then case when abs(n.z) > 1.0 then 1 else 0 end when n.z * p.position > -0.25 or n.z * p.position < -3.0 or p.hold >= 8 then 0 else p.hold + 1 end,
  case when n.z is null then 0 when p.position = 0 then case when n.z > 1.0 then -1 when n.z < -1.0 then 1 else 0 end when n.z * p.position > -0.25 or n.z * p.position < -3.0 or p.hold >= 8 then 0 else p.position end
 from p join n on n.sector = p.sector and n.a = p.a and n.b = p.b and n.i = p.i + 1)"""
PNL = POSITIONS + ", g as (select *, coalesce(lag(position) over w, 0) * coalesce(spread - lag(spread) over w, 0) as pnl from p window w as (partition by sector, a, b order by dt))"


def traded(spark, d):
    both = aligned(spark, d).withColumn("spread", F.col("asset1") - F.col("asset2"))
    z = tables.kept(panel.rolling_zscore(both, "spread", "z", 8, PAIR).select(*PAIR, "dt", "spread", F.round("z", 9).alias("z")))
    return pairs.pair_pnl(z.join(pairs.positions(z, PAIR, TRADE).select(*PAIR, "dt", "position"), [*PAIR, "dt"]), PAIR)


@query(f"{POSITIONS} select sector, a, b, dt, position from p")
def positions(spark, d):
    return traded(spark, d).select(*PAIR, "dt", "position")


@query(f"{PNL} select concat(a, '_', b) as pair, sector, dt, position, round(pnl, 9) + 0.0 as pnl from g")
def pair_pnl(spark, d):
    return traded(spark, d).select(F.concat_ws("_", "a", "b").alias("pair"), "sector", "dt", "position", r9("pnl"))


@query(f"{PNL} select sector, dt, round(avg(pnl), 9) + 0.0 as pnl, count(pnl) as n_pairs from g group by 1, 2")
def portfolio_pnl(spark, d):
    return pairs.portfolio_pnl(traded(spark, d), ["sector"]).select("sector", "dt", r9("pnl"), "n_pairs")


@query(f"{PNL}, t as (select sector, dt, avg(pnl) as pnl from g group by 1, 2) select sector, dt, round(1 + sum(pnl) over (partition by sector order by dt rows unbounded preceding), 9) as equity from t")
def equity_curve(spark, d):
    return pairs.equity(pairs.portfolio_pnl(traded(spark, d), ["sector"]), ["sector"], ["dt"]).select("sector", "dt", r9("equity"))


FORWARD = f"""with recursive {REBALANCES}, pick as (select sector, min(a) as a, max(b) as b from (select x.sector, x.asset as a, y.asset as b from (select distinct sector, asset from fx_walk) x join (select distinct sector, asset from fx_walk) y on x.sector = y.sector and x.asset < y.asset) t group by 1),
 al as (select * from (select s.rebal_date, pick.sector, a, b, x.dt, ln(x.price) - 0.5 * ln(y.price) as spread, count(*) over (partition by s.rebal_date, pick.sector) as n_obs
 from s cross join pick join fx_walk x on x.sector = pick.sector and x.asset = a and x.dt between rebal_date and next_date join fx_walk y on y.sector = pick.sector and y.asset = b and y.dt = x.dt) t where n_obs >= 9),
 z as (select rebal_date, sector, a, b, dt, spread, round((spread - avg(spread) over w) / nullif(stddev_pop(spread) over w, 0), 9) as z from al window w as (partition by rebal_date, sector order by dt rows between 7 preceding and current row)),
 n as (select *, row_number() over (partition by rebal_date, sector order by dt) as i from z), p as (
 select rebal_date, sector, a, b, dt, spread, z, i, 0 as hold, 0 as position from (select *, 1 from n where i = 1) t
 union all select n.rebal_date, n.sector, n.a, n.b, n.dt, n.spread, n.z, n.i,
  case when n.z is null then 0 when p.position = 0 then case when abs(n.z) > 1.0 then 1 else 0 end when n.z * p.position > -0.25 or n.z * p.position < -3.0 or p.hold >= 8 then 0 else p.hold + 1 end,
  case when n.z is null then 0 when p.position = 0 then case when n.z > 1.0 then -1 when n.z < -1.0 then 1 else 0 end when n.z * p.position > -0.25 or n.z * p.position < -3.0 or p.hold >= 8 then 0 else p.position end
 from p join n on n.rebal_date = p.rebal_date and n.sector = p.sector and n.i = p.i + 1)
 select rebal_date, sector, a, b, dt, position, round(coalesce(lag(position) over w, 0) * coalesce(spread - lag(spread) over w, 0), 9) + 0.0 as pnl from p window w as (partition by rebal_date, sector order by dt)"""


@query(FORWARD)
def forward_pnl(spark, d):
    """The widest pair of each sector, with a beta of 0.5, from each rebalance date to the next."""
    p, dates = walks(spark, d), tables.kept(dates_of(spark, d))
    ahead = panel.log_price(panel.forward(p, panel.calendar(view(spark, d, "fx_panel")), dates)).select(*jobs.KEYS, "asset", "dt", "lp")
    assets = p.groupBy("sector").agg(F.min("asset").alias("a"), F.max("asset").alias("b")).where("a < b")
    chosen = ahead.select(*jobs.KEYS).distinct().join(assets, "sector").withColumn("beta", F.lit(0.5))
    return pairs.forward_pnl(ahead, chosen, jobs.KEYS, TRADE).select(*jobs.KEYS, "a", "b", "dt", "position", r9("pnl"))


#: The pairs of the nations of the sample schema's second region, which the wide export lists.
LISTED = [(a, b) for a in (1, 2, 3, 17, 24) for b in (1, 2, 3, 17, 24) if a < b]


@query(f"{PNL} select sector, dt, " + ", ".join(f"max(round(pnl, 9) + 0.0) filter (where a = {a} and b = {b}) as p_{a}_{b}" for a, b in LISTED) + " from g group by 1, 2")
def pair_pnl_wide(spark, d):
    out = pairs.pnl_wide(traded(spark, d).withColumn("pnl", r9("pnl")), ["sector"], LISTED)
    return out.select("sector", "dt", *[F.col(f"{a}_{b}").alias(f"p_{a}_{b}") for a, b in LISTED])


@query(f"with {REBALANCES}, o as (select rebal_date, ord from s join fx_calendar on dt = rebal_date where ord >= 51) select rebal_date, sector, asset, round(avg(price), 6) as mean from o join fx_calendar c on c.ord between o.ord - 51 and o.ord join fx_panel p on p.dt = c.dt where sector in ('1', '3') group by 1, 2, 3")
def artifacts_roundtrip(spark, d):
    """Written by sector and rebalance date, one sector a second time, and read back by partition."""
    at = tables.new_folder(spark)
    p = view(spark, d, "fx_panel")
    means = panel.trailing(p, panel.calendar(p), dates_of(spark, d), 52).groupBy(*jobs.KEYS, "asset").agg(F.round(F.avg("price"), 6).alias("mean"))
    jobs.write_artifacts({"means": means.where("sector <> '3'").withColumn("mean", F.when(F.col("sector") == "1", 0.0).otherwise(F.col("mean")))}, at)
    jobs.write_artifacts({"means": means.where("sector in ('1', '3')")}, at)
    back = spark.read.schema("asset long, mean double, sector string, rebal_date date").parquet(f"{at}/means")
    return back.where("sector in ('1', '3')").select("rebal_date", "sector", "asset", "mean")


@query("select label % 3 as k, count(distinct case when label <> -1 then label end) as clusters from embeddings group by 1")
def label_counts(spark, d):
    return models.cluster_counts(view(spark, d, "embeddings").withColumn("k", F.col("label") % 3), ["k"])


@query("select sector, 1 + min(pc) filter (where c > 0.5) - 1 as k from (select *, sum(ratio) over (partition by sector order by pc) as c from (select sector, cast(row_number() over (partition by sector order by total desc, asset) as integer) as pc, total / sum(total) over (partition by sector) as ratio from (select sector, asset, sum(price) as total from fx_panel group by 1, 2) t) u) v group by 1")
def relevant_pcs(spark, d):
    from pyspark.sql.window import Window as W

    t = view(spark, d, "fx_panel").groupBy("sector", "asset").agg(F.sum("price").alias("total"))
    t = t.select("sector", F.row_number().over(W.partitionBy("sector").orderBy(F.desc("total"), "asset")).alias("pc"), (F.col("total") / F.sum("total").over(W.partitionBy("sector"))).alias("ratio"))
    return models.relevant(t, ["sector"])


@query(f"with {REBALANCES}, pick as (select rebal_date, sector, min(asset) as a from s cross join (select distinct sector, asset from fx_panel) t where month(rebal_date) < 7 group by 1, 2) select c.dt, p.rebal_date, sector, a from fx_calendar c join pick p on p.rebal_date = (select max(rebal_date) from pick q where q.rebal_date <= c.dt)")
def portfolio_in_force(spark, d):
    p = view(spark, d, "fx_panel")
    pick = dates_of(spark, d).where(F.month("rebal_date") < 7).select("rebal_date").crossJoin(p.groupBy("sector").agg(F.min("asset").alias("a")))  # dates x sectors: what is picked
    return panel.in_force(panel.calendar(p), pick).select("dt", "rebal_date", "sector", "a")


# models and jobs: rows of matrix steps, held against goldens, planted truth and invariants in the tests

SMALL = (Fit(52, 104, 40), Pick(10, 0.2, (1, 60), 40), TRADE)


def walks(spark, d, name="fx_walk"):
    return tables.kept(view(spark, d, name))


def factored(spark, d):
    p = walks(spark, d, "fx_full_walk")
    return jobs.factors(p, panel.calendar(p), dates_of(spark, d), 53)


@query(f"""with {REBALANCES}, cal as (select dt, row_number() over (order by dt) - 1 as ord from (select distinct dt from fx_full_walk) t), o as (select rebal_date, ord from s join cal on dt = rebal_date where ord >= 52),
 w as (select rebal_date, p.* from o join cal on cal.ord between o.ord - 52 and o.ord join fx_full_walk p on p.dt = cal.dt), x as (select *, price - avg(price) over (partition by rebal_date, sector, dt) as x from w),
 ch as (select *, x / nullif(lag(x) over (partition by rebal_date, sector, asset order by dt), 0) - 1 as r from x), n as (select sector, count(distinct asset) as n from ch group by 1), h as (select rebal_date, sector, dt, count(r) as h from ch group by 1, 2, 3),
 c as (select ch.* from ch join n using (sector) join h using (rebal_date, sector, dt) where h = n), z as (select *, (r - avg(r) over v) / coalesce(nullif(stddev_pop(r) over v, 0), 1) as z from c window v as (partition by rebal_date, sector, asset)),
 g as (select a.rebal_date, a.sector, a.asset as a, b.asset as b, sum(a.z * b.z) as g from z a join z b on a.rebal_date = b.rebal_date and a.sector = b.sector and a.dt = b.dt group by 1, 2, 3, 4)
 select rebal_date, sector, round(sum(g * g) / power(sum(g) filter (where a = b), 2), 6) as concentration from g group by 1, 2""")
def pca_moments(spark, d):
    """The sum of the squared ratios, which is that of the squared covariances over the squared total variance."""
    return factored(spark, d)[1].groupBy(*jobs.KEYS).agg(F.round(F.sum(F.col("ratio") * F.col("ratio")), 6).alias("concentration"))


@query()
def pca_evr(spark, d):
    return factored(spark, d)[1]


@query()
def pca_loadings(spark, d):
    return factored(spark, d)[0]


@query()
def factor_returns(spark, d):
    return factored(spark, d)[2]


@query()
def optics_labels(spark, d):
    return clusters.cluster(models.scaled_loadings(pca_loadings(spark, d), jobs.KEYS, 2), jobs.KEYS)


@query()
def cluster_counts(spark, d):
    return models.cluster_counts(optics_labels(spark, d), jobs.KEYS)


def arrays_of(spark, d, name):
    """(arrays of each asset's log prices, all pairs of a sector over the whole calendar)."""
    p = walks(spark, d, name)
    cal = tables.kept(panel.calendar(p))
    arrays = tables.kept(moments.series(panel.log_price(p), cal, ["sector"]))
    ends = cal.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).withColumn("least", F.lit(50))
    both = pairs.combinations(arrays.select("sector", "asset", F.lit(0).alias("label")), ["sector"]).drop("label")
    return arrays, both.crossJoin(F.broadcast(ends))  # one row


@query()
def coint_screen(spark, d):
    """Both-way tests of all pairs of a sector; permno1 and permno2 in the winning order."""
    arrays, both = arrays_of(spark, d, "fx_wide_walk")
    s = moments.winning(moments.windowed(both, arrays, ["sector"]), tie_first=False).withColumn("cointegrated", F.col("p_value") < 0.05)
    m = (F.col("n_obs") - 1).cast("double")
    s = s.withColumns({c: F.lit(x) + F.lit(y) / m + F.lit(z) / (m * m) for c, (x, y, z) in models.CRITICAL.items()})
    s = s.select(*PAIR, "first", "t_stat", "p_value", "n_obs", *models.CRITICAL, "cointegrated")
    return jobs.in_order(s, [("a", "b")]).withColumnsRenamed({"a": "permno1", "b": "permno2"}).drop("first")


#: Moments of the level (l) and of the changes before (1, 2) with each other and with the change (y); what the changes explain is taken off.
LAGGED = f"""{STATS}, d as (select sector, a, b, dt, p as l, spread - p as y, lag(spread - p) over w as d1, lag(spread - p, 2) over w as d2 from l window w as (partition by sector, a, b order by dt)),
 m1 as (select sector, a, b, count(*) as n, sum(l * l) as ll, sum(l * y) as ly, sum(y * y) as yy, sum(d1 * d1) as s11, sum(d1 * l) as l1, sum(d1 * y) as y1 from d where d1 is not null group by 1, 2, 3),
 k1 as (select sector, a, b, 1 as k, n - 2 as free, ll - l1 * l1 / s11 as ll, ly - l1 * y1 / s11 as ly, yy - y1 * y1 / s11 as yy from m1),
 m2 as (select sector, a, b, count(*) as n, sum(l * l) as ll, sum(l * y) as ly, sum(y * y) as yy, sum(d1 * d1) as s11, sum(d1 * d2) as s12, sum(d2 * d2) as s22, sum(d1 * l) as l1, sum(d2 * l) as l2, sum(d1 * y) as y1, sum(d2 * y) as y2 from d where d2 is not null group by 1, 2, 3),
 k2 as (select sector, a, b, 2 as k, n - 3 as free, ll - (l1 * l1 * s22 - 2 * l1 * l2 * s12 + l2 * l2 * s11) / (s11 * s22 - s12 * s12) as ll, ly - (l1 * y1 * s22 - (l1 * y2 + l2 * y1) * s12 + l2 * y2 * s11) / (s11 * s22 - s12 * s12) as ly,
 yy - (y1 * y1 * s22 - 2 * y1 * y2 * s12 + y2 * y2 * s11) / (s11 * s22 - s12 * s12) as yy from m2)"""


@query(f"{LAGGED} select sector, a, b, k, round(ly / ll / sqrt((yy - ly * ly / ll) / free / ll), 5) as t_stat from (select * from k1 union all select * from k2) t")
def df_k_stat(spark, d):
    """The unit-root statistic of a on b with one and with two lags."""
    arrays, both = arrays_of(spark, d, "fx_walk")
    stat = lambda k: moments.windowed(both, arrays, ["sector"], lags=k).select(*PAIR, F.lit(k).alias("k"), F.round("t1", 5).alias("t_stat"))
    return stat(1).unionByName(stat(2))


#: Candidates by fixed labels and loadings, screened without lags: two thirds of a year's cross-section in three labels of each sector.
#: The normal distribution: erf(x) is exp(-x^2) times the sum of x^(2n+1) / gamma(n + 3/2); in the tail, a continued fraction.
PHI = """case when z < -2 then exp(-z * z / 2) / sqrt(2 * pi()) / list_reduce(range(80, 0, -1), lambda f, n: n / f - z, -z)
 else 0.5 * (1 + exp(-z * z / 2) * list_sum(list_transform(range(0, 90), lambda n: power(z / sqrt(2), 2 * n + 1) / gamma(n + 1.5)))) end"""
P_VALUE = "case when t > 0.92 then 1.0 when t < -18.86 then 0.0 else " + PHI + " end"
FIXED = f"""{REBALANCES}, cal as (select dt, row_number() over (order by dt) - 1 as ord from (select distinct dt from WALK) t), o as (select rebal_date, ord from s join cal on dt = rebal_date where ord >= 103), x as (select distinct sector, asset from WALK),
 cand as (select rebal_date, ord, x.sector, x.asset as a, y.asset as b, x.asset % 3 as cluster_id, sqrt(power(x.asset % 7 - y.asset % 7, 2) + power(x.asset % 11 - y.asset % 11, 2)) / 10 as pca_distance from o cross join x join x y on x.sector = y.sector and x.asset % 3 = y.asset % 3 and x.asset < y.asset),
 al as (select * from (select cand.*, cal.dt, ln(u.price) as u, ln(v.price) as v, count(*) over (partition by rebal_date, cand.sector, a, b) as n_obs from cand join cal on cal.ord between cand.ord - 103 and cand.ord
  join WALK u on u.asset = a and u.dt = cal.dt join WALK v on v.asset = b and v.dt = cal.dt) t where n_obs >= 40),
 f as (select rebal_date, sector, a, b, regr_slope(u, v) as b1, regr_intercept(u, v) as a1, regr_slope(v, u) as b2, regr_intercept(v, u) as a2 from al group by 1, 2, 3, 4),
 e as (select al.*, b1, a1, b2, a2, u - a1 - b1 * v as e1, v - a2 - b2 * u as e2 from al join f using (rebal_date, sector, a, b)),
 l as (select *, lag(e1) over w as p1, lag(e2) over w as p2 from e window w as (partition by rebal_date, sector, a, b order by dt)),
 g as (select rebal_date, sector, a, b, min(cluster_id) as cluster_id, min(pca_distance) as pca_distance, count(*) as overlap_n, min(a1) as a1, min(b1) as b1, min(a2) as a2, min(b2) as b2, count(p1) as n,
  sum(p1 * p1) as ll1, sum(p1 * (e1 - p1)) as ld1, sum(power(e1 - p1, 2)) as dd1, regr_slope(e1 - p1, p1) as phi1, stddev_samp(e1 - p1) as c1, sum(p2 * p2) as ll2, sum(p2 * (e2 - p2)) as ld2, sum(power(e2 - p2, 2)) as dd2, regr_slope(e2 - p2, p2) as phi2, stddev_samp(e2 - p2) as c2 from l group by 1, 2, 3, 4),
 t as (select *, ld1 / ll1 / sqrt((dd1 - ld1 / ll1 * ld1) / ((n - 1) * ll1)) as t1, ld2 / ll2 / sqrt((dd2 - ld2 / ll2 * ld2) / ((n - 1) * ll2)) as t2 from g),
 z1 as (select *, {P_VALUE} as q1 from (select *, t1 as t, case when t1 <= -2.62 then 2.92 + 1.5012 * t1 + 0.039796 * t1 * t1 else 2.1945 + 0.64695 * t1 - 0.29198 * t1 * t1 - 0.042377 * power(t1, 3) end as z from t) z),
 z2 as (select *, {P_VALUE} as q2 from (select * exclude (t, z), t2 as t, case when t2 <= -2.62 then 2.92 + 1.5012 * t2 + 0.039796 * t2 * t2 else 2.1945 + 0.64695 * t2 - 0.29198 * t2 * t2 - 0.042377 * power(t2, 3) end as z from z1) z),
 sc as (select rebal_date, sector, a, b, cluster_id, pca_distance, overlap_n, case when q1 <= q2 then 'a_on_b' else 'b_on_a' end as best_direction, least(q1, q2) as pval_min, case when q1 <= q2 then t1 else t2 end as t_stat, case when q1 <= q2 then a1 else a2 end as alpha, case when q1 <= q2 then b1 else b2 end as beta,
  case when q1 <= q2 then c1 else c2 end as spread_change_sigma, case when (case when q1 <= q2 then phi1 else phi2 end) < 0 then -ln(2) / (case when q1 <= q2 then phi1 else phi2 end) else cast('infinity' as double) end as half_life from z2),
 sel as (select * from (select *, {SCORE} as score, row_number() over (partition by rebal_date, sector order by {SCORE} desc nulls last, a, b) as rank from sc where pval_min <= 0.2 and half_life between 1 and 60 and overlap_n >= 40) t where rank <= 10)"""
AHEAD = """, fw as (select * from (select sel.rebal_date, sel.sector, a, b, u.dt, ln(u.price) - beta * ln(v.price) as spread, count(*) over (partition by sel.rebal_date, sel.sector, a, b) as n_obs from sel join s on s.rebal_date = sel.rebal_date
  join WALK u on u.asset = a and u.dt between s.rebal_date and s.next_date join WALK v on v.asset = b and v.dt = u.dt) t where n_obs >= 9),
 zz as (select rebal_date, sector, a, b, dt, spread, round(case when stddev_pop(spread) over w > 1e-12 then (spread - avg(spread) over w) / (stddev_pop(spread) over w) end, 9) as z from fw window w as (partition by rebal_date, sector, a, b order by dt rows between 7 preceding and current row)),
 n as (select *, row_number() over (partition by rebal_date, sector, a, b order by dt) as i from zz), p as (
 select rebal_date, sector, a, b, dt, spread, z, i, 0 as hold, 0 as position from (select *, 1 from n where i = 1) t
 union all select n.rebal_date, n.sector, n.a, n.b, n.dt, n.spread, n.z, n.i,
  case when n.z is null then 0 when p.position = 0 then case when abs(n.z) > 1.0 then 1 else 0 end when n.z * p.position > -0.25 or n.z * p.position < -3.0 or p.hold >= 8 then 0 else p.hold + 1 end,
  case when n.z is null then 0 when p.position = 0 then case when n.z > 1.0 then -1 when n.z < -1.0 then 1 else 0 end when n.z * p.position > -0.25 or n.z * p.position < -3.0 or p.hold >= 8 then 0 else p.position end
 from p join n on n.rebal_date = p.rebal_date and n.sector = p.sector and n.a = p.a and n.b = p.b and n.i = p.i + 1),
 pn as (select *, coalesce(lag(position) over w, 0) * coalesce(spread - lag(spread) over w, 0) as pnl from p window w as (partition by rebal_date, sector, a, b order by dt)),
 tot as (select sector, rebal_date, dt, avg(pnl) as pnl, count(pnl) as n_pairs from pn group by 1, 2, 3)"""


def fixed(spark, d, name):
    """The evaluation from labels and loadings that follow from the assets' numbers, tested without lags."""
    p = walks(spark, d, name)
    dates, cal = tables.kept(dates_of(spark, d)), tables.kept(panel.calendar(p))
    each = p.select("sector", "asset").distinct().join(F.broadcast(dates.select("rebal_date")))  # assets x dates: what the labels and loadings are
    labels = each.withColumn("label", F.col("asset") % 3)
    loadings = each.withColumn("vec", F.array(F.col("asset") % 7 / 10.0, F.col("asset") % 11 / 10.0))
    return jobs.evaluated(p, cal, dates, tables.kept(jobs.candidates(labels, loadings)), *SMALL, lags=0)


@query(f"with {FIXED} select rebal_date, sector, a, b, cluster_id, best_direction, cast(overlap_n as integer) as overlap_n, round(pca_distance, 6) as pca_distance, round(t_stat, 6) as t_stat, round(pval_min, 8) as pval_min, round(alpha, 6) as alpha, round(beta, 6) as beta, round(spread_change_sigma, 8) as spread_change_sigma, round(least(half_life, 10000), 2) as half_life from sc".replace("WALK", "fx_wide_walk"))
def screen_fixed(spark, d):
    x = fixed(spark, d, "fx_wide_walk")["screened"]
    return x.select(*jobs.KEYS, "a", "b", "cluster_id", "best_direction", "overlap_n", *r6("pca_distance", "t_stat", "alpha", "beta"), *[F.round(c, 8).alias(c) for c in ("pval_min", "spread_change_sigma")], F.round(F.least("half_life", F.lit(10000)), 2).alias("half_life"))


@query(f"with {FIXED} select rebal_date, sector, a, b, cast(rank as integer) as rank, round(score, 3) as score from sel".replace("WALK", "fx_full_walk"))
def selected_fixed(spark, d):
    return fixed(spark, d, "fx_full_walk")["selected"].select(*jobs.KEYS, "a", "b", "rank", F.round("score", 3).alias("score"))


@query(f"with recursive {FIXED}{AHEAD} select sector, rebal_date, dt, n_pairs, round(pnl, 9) + 0.0 as pnl, round(1 + sum(pnl) over (partition by sector order by dt, rebal_date rows unbounded preceding), 8) as equity from tot".replace("WALK", "fx_full_walk"))
def rolling_fixed(spark, d):
    x = fixed(spark, d, "fx_full_walk")["equity"]
    return x.select("sector", "rebal_date", "dt", "n_pairs", r9("pnl"), F.round("equity", 8).alias("equity"))


def evaluated(spark, d):
    """On the walks that keep their level over weeks without trades: every window is complete at every scale."""
    return jobs.rolling(walks(spark, d, "fx_full_walk"), dates_of(spark, d), *SMALL, k=2)


@query()
def screen_pairs(spark, d):
    return evaluated(spark, d)["screened"]


@query()
def selected_pairs(spark, d):
    return evaluated(spark, d)["selected"]


@query()
def rolling_backtest(spark, d):
    return evaluated(spark, d)["equity"]


@query()
def rolling_daily(spark, d):
    """Daily walks, quarterly dates, and the default windows, limits and bounds of the job."""
    p = walks(spark, d, "fx_days_walk")
    return jobs.rolling(p, panel.rebalances(panel.calendar(p), START, END))["equity"]


@query()
def portfolio_candidates(spark, d):
    return jobs.portfolio(walks(spark, d, "fx_full_walk"), dates_of(spark, d), SMALL[0])
