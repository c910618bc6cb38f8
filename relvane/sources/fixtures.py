"""Quotes, names, links and price panels as views over the star-schema tables. The SQL runs on Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")
PRICE = "cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / cast(sum(cast(l_quantity as decimal(18,2))) as double) as price"
WALK = """select dt, asset, sector, 100 * exp(sum(round(0.02 * (price / m - 1), 6)) over (partition by asset order by dt rows between unbounded preceding and current row)) as price
 from (select dt, asset, sector, price, avg(price) over (partition by asset) as m from {}) t"""

#: A walk without gaps: on dates without trades an asset keeps its level.
FULL = """select dt, asset, sector, 100 * exp(sum(coalesce(round(0.02 * (price / m - 1), 6), 0)) over (partition by asset order by dt rows between unbounded preceding and current row)) as price
 from (select c.dt, a.asset, a.sector, w.price, avg(w.price) over (partition by a.asset) as m from (select distinct dt from {0}) c cross join (select distinct asset, sector from {0}) a left join {0} w on w.dt = c.dt and w.asset = a.asset) t"""

#: name: (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_panel": ((), f"""select cast(date_trunc('week', l_shipdate) as date) as dt, cast(s_nationkey as bigint) as asset, cast(n_regionkey as string) as sector, {PRICE}
 from lineitem join supplier on l_suppkey = s_suppkey join nation on n_nationkey = s_nationkey group by 1, 2, 3"""),
    "fx_wide": ((), f"""select cast(date_trunc('week', l_shipdate) as date) as dt, cast(n_regionkey as bigint)*100 + cast(substr(p_brand,7) as bigint) as asset, cast(n_regionkey as string) as sector, {PRICE}
 from lineitem join supplier on l_suppkey = s_suppkey join nation on n_nationkey = s_nationkey join part on l_partkey = p_partkey group by 1, 2, 3"""),
    "fx_walk": (("fx_panel",), WALK.format("fx_panel")),
    "fx_wide_walk": (("fx_wide",), WALK.format("fx_wide")),
    "fx_full_walk": (("fx_wide",), FULL.format("fx_wide")),
    "fx_days": ((), f"""select cast(l_shipdate as date) as dt, cast(n_regionkey as bigint)*100 + cast(substr(p_brand,7) as bigint) as asset, cast(n_regionkey as string) as sector, {PRICE}
 from lineitem join supplier on l_suppkey = s_suppkey join nation on n_nationkey = s_nationkey join part on l_partkey = p_partkey group by 1, 2, 3"""),
    "fx_days_walk": (("fx_days",), FULL.format("fx_days")),
    "fx_names": ((), """select o_custkey as permno, o_orderstatus, o_orderpriority, namedt, case when nxt is null then date '2099-12-31' else cast(nxt - interval 1 day as date) end as nameendt,
 case o_orderstatus when 'O' then 1 when 'P' then 2 else 3 end as exchcd from (
 select o_custkey, o_orderstatus, o_orderpriority, cast(o_orderdate as date) as namedt, lead(cast(o_orderdate as date)) over (partition by o_custkey order by cast(o_orderdate as date), o_orderkey) as nxt from orders) t
 where nxt is null or nxt > namedt"""),
    "fx_daily": ((), """select o_custkey as permno, cast(l_shipdate as date) as date, l_orderkey, l_linenumber, case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as prc, l_quantity as shrout, 1 + l_tax * 10 as cfacpr
 from lineitem join orders on l_orderkey = o_orderkey"""),
    "fx_link": ((), """select c_custkey as permno, c_nationkey as gvkey, case when c_mktsegment in ('BUILDING','MACHINERY') then 'LU' when c_mktsegment='HOUSEHOLD' then 'LC' else 'NR' end as linktype, case when c_acctbal >= 0 then 'P' else 'J' end as linkprim from customer"""),
    "fx_company": ((), """select n_nationkey as gvkey, case when n_nationkey % 7 = 0 then null else n_regionkey end as gsector, n_nationkey as gind from nation"""),
    "fx_calendar": (("fx_panel",), "select dt, row_number() over (order by dt) - 1 as ord from (select distinct dt from fx_panel) t"),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table of the folder."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs, sql = VIEWS[name]
    for t in needs:
        view(spark, sf_dir, t).createOrReplaceTempView(t)
    if not needs:
        for t in TABLES:
            if t in sql:
                spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)


def with_views(sql: str) -> str:
    """sql with the views it names in front, for an engine that has the tables only."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        for t in VIEWS[name][0]:
            add(t)
        out.setdefault(name, VIEWS[name][1])

    for name in sorted(VIEWS, key=len, reverse=True):
        if name in sql.replace("fx_wide_walk", "" if name == "fx_wide" else "fx_wide_walk"):
            add(name)
    if not out:
        return sql
    head, body = ("with recursive ", sql[15:]) if sql.startswith("with recursive ") else ("with ", sql[5:]) if sql.startswith("with ") else ("with ", "")
    return head + ", ".join(f"{k} as ({v})" for k, v in out.items()) + (", " + body if body else " " + sql)
