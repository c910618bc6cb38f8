"""Columns and types of the tables that jobs read and write. Names and types are fixed values; tables hold rows, never a column an asset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEYS = "sector string, rebal_date date"
_PAIR = f"{_KEYS}, a bigint, b bigint"

SCHEMAS: dict[str, str] = {
    "quotes": "permno bigint, permco bigint, date date, ticker string, company_name string, exchcd int, share_code int, price double, volume double, return double, return_ex_dividend double, shares_outstanding double,"
    " open_price double, ask_high double, bid_low double, cum_factor_shares double, cum_factor_price double",
    "panel": "sector string, asset bigint, dt date, price double",
    "calendar": "dt date, ord int",
    "schedule": "rebal_date date, selection_date date",
    "scaled": f"{_KEYS}, asset bigint, dt date, z double",
    "evr": f"{_KEYS}, pc int, ratio double, cum_ratio double",
    "loadings": f"{_KEYS}, asset bigint, vec array<double>",
    "factor_returns": f"{_KEYS}, dt date, pc int, value double",
    "labels": f"{_KEYS}, asset bigint, label int",
    "candidates": f"{_PAIR}, cluster_id int, pca_distance double",
    "screened": f"{_PAIR}, cluster_id int, pca_distance double, t_stat double, pval_min double, overlap_n int, alpha double, beta double, spread_change_sigma double, half_life double, best_direction string",
    "pair_pnl": f"{_PAIR}, dt date, spread double, z double, position int, pnl double",
    "portfolio_pnl": f"{_KEYS}, dt date, pnl double, n_pairs bigint",
    "equity": f"{_KEYS}, dt date, pnl double, n_pairs bigint, equity double",
    "pair_stats": f"{_KEYS}, permno1 bigint, permno2 bigint, cluster_id int, t_stat double, p_value double, crit_1pct double, crit_5pct double, crit_10pct double, n_obs int, cointegrated boolean,"
    " alpha double, beta double, r2 double, resid_std double, sigma double, change_sigma double, half_life double",
}
SCHEMAS["selected"] = SCHEMAS["screened"] + ", score double, rank int"


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """df with the columns of a table in their order; a column that is missing or of another type is an error. Other columns are dropped."""
    want = schema(name)
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name} {f.dataType.simpleString()}: {have[f.name].simpleString() if f.name in have else 'missing'}" for f in want if have.get(f.name) != f.dataType]
    if wrong:
        raise TypeError(f"not a table of {name}: {'; '.join(wrong)}")
    return df.select(*want.fieldNames())


def filled(df: DataFrame, name: str) -> DataFrame:
    """df cast to the columns of a table; those that it lacks are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name)])
