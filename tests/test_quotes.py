"""Interval joins by bins of dates, and tables that must conform to their schemas."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from relvane import schemas
from relvane.operators import quotes

DAY = dt.date(2000, 1, 1)


def test_interval_join_by_bins(spark):
    r = random.Random(1)
    names = []
    for permno in range(6):
        for k in range(8):
            lo = r.randrange(0, 3000)
            names.append((permno, DAY + dt.timedelta(days=lo), DAY + dt.timedelta(days=lo + r.choice([-3, 0, 1, 127, 128, 900])) if k else dt.date(2099, 12, 31), k))  # they overlap, are empty or open
    names += [(7, None, DAY, 0), (8, DAY, None, 0), (None, DAY, DAY, 0)]
    rows = [(0 if r.random() < 0.5 else r.randrange(9), DAY + dt.timedelta(days=r.randrange(-200, 6000)), i) for i in range(900)] + [(1, None, 900), (None, DAY, 901)]  # half of one permno
    q = spark.createDataFrame(rows, "permno long, date date, i int").repartition(4)
    n = spark.createDataFrame(names, "permno long, namedt date, nameendt date, k int")
    match = lambda p, d, m: None not in (p, d, *m[:3]) and p == m[0] and m[1] <= d <= m[2]
    want = {how: sorted((i, m[3]) for p, d, i in rows for m in names if match(p, d, m)) for how in ("inner",)}
    got = quotes.valid_at(q, n, "inner")
    assert sorted((x.i, x.k) for x in got.select("i", "k").collect()) == want["inner"] and len(want["inner"]) > 500
    left = quotes.valid_at(q, n)
    alone = {i for _, _, i in rows} - {i for i, _ in want["inner"]}
    assert sorted((x.i, x.k) for x in left.select("i", "k").collect() if x.k is not None) == want["inner"]
    assert {x.i for x in left.where("k is null").collect()} == alone
    assert left.columns == ["permno", "date", "i", "namedt", "nameendt", "k"]
    assert quotes.valid_at(q, n.where("false"), "inner").collect() == [] and quotes.valid_at(q, n.where("false")).count() == len(rows)
    assert quotes.valid_at(q.where("false"), n).collect() == []


def test_quote_table(spark):
    q = spark.createDataFrame([(1, DAY, -5.0, 2.0), (2, DAY, 3.0, 1.0)], "permno long, date date, prc double, cfacpr double")
    n = spark.createDataFrame([(1, DAY, DAY, 1, "A")], "permno long, namedt date, nameendt date, exchcd int, ticker string")
    got = quotes.daily(q, n, DAY, DAY)
    assert got.schema.fieldNames() == schemas.schema("quotes").fieldNames() and [f.dataType for f in got.schema] == [f.dataType for f in schemas.schema("quotes")]
    assert {(x.permno, x.price, x.ticker, x.volume) for x in got.collect()} == {(1, -5.0, "A", None), (2, 3.0, None, None)}
    assert [x.permno for x in quotes.daily(q, n, DAY, DAY, ["NYSE"]).collect()] == [1]


def test_tables_conform(spark):
    df = spark.createDataFrame([("s", 1, DAY, 2.0, 3)], "sector string, asset long, dt date, price double, more int")
    assert schemas.conform(df, "panel").columns == ["sector", "asset", "dt", "price"]
    with pytest.raises(TypeError, match="asset bigint: int"):
        schemas.conform(df.withColumn("asset", F.col("asset").cast("int")), "panel")
    with pytest.raises(TypeError, match="price double: missing"):
        schemas.conform(df.drop("price"), "panel")
