"""What the operators of this folder share: tables, lineage cuts and two-level ranks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

#: Separators of words: space and the control characters from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a new one."""
    sc = spark.sparkContext
    if (named := sc.getConf().get("spark.checkpoint.dir", None)) is None:
        named = sc.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-shared-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Evaluates df once and cuts its lineage with a reliable checkpoint; for narrow tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stash(df: DataFrame) -> DataFrame:
    """Evaluates df once into a Parquet table in the shared folder, for large tables; what it shuffled is of no more use then and goes."""
    spark, cleanup = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path = f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
    before = spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stash_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of stash() that nothing reads any more."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t.stash_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def free(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores in front as it takes to be none of the columns (upper and lower case are alike)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bucket(*cols: Column, n: int = 1024) -> Column:
    """A bucket from 0 to n - 1 that follows from the values alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def ranked(df: DataFrame, keys: list[str], order: list, name: str, weight: Column | None = None) -> DataFrame:
    """Adds a gapless rank from 0 within keys (with weight: the sum of the weights before the row).

    order: columns that start with an integer bucket column "bucket". A key that holds most of the rows is
    sorted in as many parts as there are buckets; only the sums of the buckets meet in one place.
    """
    one = F.lit(1).cast("long") if weight is None else weight
    rows = df.withColumn("_w", one)
    parts = rows.groupBy(*keys, "bucket").agg(F.sum("_w").alias("_sum"))
    before = F.sum("_sum").over(W.partitionBy(*keys).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("bucket").alias("_b"), F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum("_w").over(W.partitionBy(*keys, "bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_inside", F.coalesce(inside, F.lit(0)))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("bucket") == F.col("_b")]
    return rows.join(parts, on).withColumn(name, (F.col("_before") + F.col("_inside")).cast("long")).drop("_w", "_inside", "_b", "_before", *[f"_{k}" for k in keys])


def raw_texts(batch, name: str = "text") -> list:
    """The column's texts as UTF-8 bytes; None for null."""
    import pyarrow as pa

    return batch.column(name).cast(pa.binary()).to_pylist()


def schema(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(k, T.DataType.fromDDL(v)) for k, v in fields.items()])
