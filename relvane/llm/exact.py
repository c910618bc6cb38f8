"""Exact dedup (operator 12): rows whose texts are equal once each run of spaces is one space; DataFrame functions alone.

Texts meet under a digest, but it is the whole text that decides, at each stage:

1. Equal texts of a partition become one row (the map side of the first aggregate, whose keys are digest, salt and text).
2. A digest's rows of one salt meet and become one row for each text. The salt is the partition that a row came from, modulo
   SALTS, so copies that hold a third of the table still meet as a row for each partition at most, in SALTS places.
3. The winners of the salts, SALTS rows of a text at most, meet under the digest alone.

A digest with one text needs no text from there on: rows join their group by the digest. Digests that different texts share,
should there be any, are joined by digest and text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, discard, free, stash, table

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def combined(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, text, keep_id, size): a row for each text."""
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    winners = rows.groupBy("digest", salt.alias("salt"), "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("size"))
    return winners.repartition("digest").groupBy("digest", "text").agg(F.min("keep_id").alias("keep_id"), F.sum("size").alias("size"))


def first_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first): the row number of the smallest id; rows without an id come last, and of several rows the first."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    return rows.groupBy(*keys).agg(first.alias("_first")).select(*keys, F.col("_first.row").alias("first"))


def marked(docs: DataFrame, digest: Callable[[Column], Column] = sha256, row: str | None = None) -> DataFrame:
    """(doc_id, row, keep_id, group_size, kept, digest), a row for each row of docs; of equal texts the row of the smallest doc_id is kept.

    A null text counts as empty. Rows that share text and doc_id are rows of their own, of which one is kept. A row without a
    doc_id is kept only where no row of its text has one (keep_id is null then). row: a column of docs that numbers its rows.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row"), normalised(F.col("text")).alias("text")).withColumn("digest", digest(F.col("text")))
    narrow = stash(rows.select("doc_id", "row", "digest"))
    texts = combined(rows).groupBy("digest").agg(F.count("*").alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("size").alias("group_size"))
    groups = stash(texts.join(first_rows(narrow, ["digest"]), "digest"))
    columns = ["doc_id", "row", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"), "digest"]
    out = narrow.join(groups.where("texts = 1"), "digest").select(*columns)
    shared = groups.where("texts > 1").select("digest")
    if shared.isEmpty():
        return out
    rows = stash(rows.join(shared, "digest", "left_semi"))
    groups = combined(rows).join(first_rows(rows, ["digest", "text"]), ["digest", "text"])
    return out.unionByName(rows.join(stash(groups), ["digest", "text"]).withColumnRenamed("size", "group_size").select(*columns))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    (row,) = free(docs.columns, "row")
    rows = stash(docs.withColumn(row, F.monotonically_increasing_id()))
    kept = marked(rows, row=row).where("kept").select(F.col("row").alias(row))
    out = stash(rows.join(kept, row, "left_semi").select(*docs.columns))
    discard(rows)
    return out


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = marked(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP12_SQL = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as text from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept, sha256(text) as text_sha256 from t window w as (partition by text)
"""
