"""Readers and writers of quotes, panels and results: partitioned Parquet, CSV for import and export."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share; in local mode one of this machine will do."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-kept-")
    return f"{shared}/kept-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """df, evaluated once into a table that later steps read: their plans start there, and a lost executor loses none of it."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_quotes(spark: SparkSession, path: str, start=None, end=None, fmt: str = "parquet", schema=None) -> DataFrame:
    """Quotes from a table partitioned by year; only the years from start to end are read, and it is an error if there are none."""
    df = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {}))
    df = (df.schema(schema) if schema is not None else df).load(path)
    if start is None:
        return df
    df = df.where(F.col("year").between(start, end))
    if df.select("year").isEmpty():
        raise FileNotFoundError(f"{path} has no year from {start} to {end}")
    return df


def write_by_year(df: DataFrame, path: str, date: str = "date", key: str = "permno", files: int = 16) -> None:
    """A folder a year, of at most `files` files, so that a year is the work of as many tasks."""
    df.withColumn("year", F.year(date)).repartition("year", F.pmod(F.hash(key), F.lit(files))).write.mode("overwrite").partitionBy("year").parquet(path)


def write_panel(df: DataFrame, path: str) -> None:
    """One folder for each sector; a reader of a sector opens that folder alone."""
    df.write.mode("overwrite").partitionBy("sector").parquet(path)


def read_panel(spark: SparkSession, path: str, sector: str | None = None, schema=None) -> DataFrame:
    """A panel, or the rows of a sector. With its schema, a panel without rows can be read too."""
    df = spark.read.option("partitionColumnTypeInference.enabled", False)
    df = (df.schema(schema) if schema is not None else df).parquet(path).withColumn("sector", F.col("sector").cast("string"))
    return df if sector is None else df.where(F.col("sector") == sector)


def write_artifact(df: DataFrame, path: str, name: str) -> None:
    """A result table by sector and rebalance date; a rerun replaces only the partitions that it holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sector", "rebal_date").parquet(f"{path}/{name}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)
