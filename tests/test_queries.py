import duckdb
import pytest

import __spark_entry__ as entry
from relvane.plans import queries as q
from relvane.sources.fixtures import TABLES


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = q.QUERIES[name](spark, sf_dir)
    r = c.execute(q.SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    rows = r.fetchall()
    assert sorted(map(str, (tuple(x) for x in df.select(*names).collect()))) == sorted(map(str, rows))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["sector", "rebal_date", "dt", "pnl", "n_pairs", "equity"] and not df.isEmpty() and set(entry.oracle_sql()) <= set(entry.queries())
