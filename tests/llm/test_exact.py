import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from relvane.llm import exact

from .brute import frame, odd_docs


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def docs():
    out = odd_docs() + [(300, "a  b"), (301, "a\tb"), (302, " a b"), (303, "a b "), (304, "a b"), (305, "A b"), (306, "\n"), (299, "a\r\n b")]
    out += [(None, "only null ids"), (None, "only  null ids"), (5, "hot"), (5, "hot"), (6, "hot")]
    return out + [(1000 + i, "hot" if i % 3 else "hot \t") for i in range(300)]  # copies of a third of the rows and more


def by_text(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normalised(t)].append(i)
    return groups


def compare(spark, rows, digest):
    got = exact.marked(frame(spark, rows, digest="x", row=1, size=2, salt=3), digest).collect()
    groups = by_text(rows)
    least = {t: min((i for i in g if i is not None), default=None) for t, g in groups.items()}
    assert len(got) == len(rows)
    plain = sorted(((str(i), str(least[normalised(t)]), len(groups[normalised(t)])) for i, t in rows))
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in got) == plain
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    return got


def test_equal_texts_by_brute_force(spark):
    rows = docs()
    got = compare(spark, rows, exact.sha256)
    assert {bytes(r["digest"]).hex() for r in got} == {hashlib.sha256(t.encode()).hexdigest() for t in by_text(rows)}


def test_texts_that_share_a_digest_are_told_apart(spark):
    compare(spark, docs(), lambda t: F.length(t) % 3)
    compare(spark, docs(), lambda t: F.lit(0))


def test_rows_that_stay_keep_all_columns(spark):
    rows = docs()
    df = frame(spark, rows, row="r", digest=5).withColumn("n", F.monotonically_increasing_id())
    got = exact.deduplicated(df)
    assert got.columns == df.columns
    assert sorted(normalised(r["text"]) for r in got.collect()) == sorted(by_text(rows))


def test_empty_table(spark):
    df = frame(spark, [(1, "x")]).where("false")
    assert exact.marked(df).collect() == [] and exact.deduplicated(df).collect() == []


def test_query_on_a_table_with_nulls(spark, tmp_path):
    rows = [(i, t) for i, t in dict(docs()).items() if i is not None]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    groups = by_text(rows)
    wanted = {(i, min(groups[normalised(t)]), len(groups[normalised(t)]), i == min(groups[normalised(t)]), hashlib.sha256(normalised(t).encode()).hexdigest()) for i, t in rows}
    got = exact.op12_exact(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("keep_id", "bigint"), ("group_size", "bigint"), ("kept", "boolean"), ("text_sha256", "string")]
    assert {tuple(r) for r in got.collect()} == wanted


def test_no_python_runs(spark, sf_dir):
    plan = exact.combined(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("x").alias("digest")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("partial_min") >= 1
