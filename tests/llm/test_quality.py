import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from relvane.llm import quality

from .brute import frame, odd_docs, prose


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, prose(i, 60) if i % 3 else prose(i, 60).upper().replace(" ", "!! ")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), None) for i in range(600)] + [(None, 1, 0), (5, None, 1), (10**6, 0, 0)], "doc_id long, quality int, toxic int")
    return rows, labels


def test_held_out_accuracy(spark, labelled):
    rows, labels = labelled
    docs = frame(spark, rows, quality=1, score_="x")
    got = quality.scored(docs, quality.train(docs, labels, sample=300)).withColumn("h", quality.held_out()).collect()
    out = [r for r in got if r.h]
    assert {r.doc_id for r in out} == {d for d, _ in rows if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum((r.score >= 0.3) == (r.doc_id % 3 > 0) for r in out) >= 0.95 * len(out)


def test_held_out_labels_are_not_read(spark, labelled):
    rows, labels = labelled
    docs = frame(spark, rows)
    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.train(docs, labels) == quality.train(docs, other)).all()


def test_odd_texts_get_scores(spark, labelled):
    rows, labels = labelled
    w = quality.train(frame(spark, rows), labels)
    odd = odd_docs() + [(5000, "x" * 300_000)]
    got = quality.scored(frame(spark, odd, at=1, label="z"), w).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (0, 1, 2)}) == 1
    assert quality.scored(frame(spark, []), w).collect() == []


def test_a_column_named_score_stays(spark, labelled):
    rows, labels = labelled
    docs = frame(spark, rows, score="mine")
    got = quality.keep_good(docs, labels, docs)
    assert got.columns == docs.columns and {r.score for r in got.collect()} == {"mine"}
    assert quality.scored(docs, quality.train(docs, labels)).columns == ["doc_id", "text", "score"]


def test_without_labels_scores_are_even(spark, labelled):
    rows, labels = labelled
    w = quality.train(frame(spark, rows), labels.limit(0))
    assert {r.score for r in quality.scored(frame(spark, rows[:5]), w).collect()} == {0.5}


def plain_features(text, bits=18):
    """{bucket: value} by dictionaries and whole numbers."""
    import xxhash

    full = (1 << 64) - 1
    codes = [xxhash.xxh64_intdigest(t) for t in re.findall(rb"[A-Za-z0-9_\x80-\xff]+|[^A-Za-z0-9_\x80-\xff\s]+", (text or "").encode())]
    pairs = [1 << 63 if a == b else ((a * 0x9E3779B97F4A7C15 & full ^ b) * 0xD6E8FEB86659FD93) & full for a, b in zip(codes, codes[1:])]
    n = {}
    for c in codes + pairs:
        n[c >> 64 - bits] = n.get(c >> 64 - bits, 0) + 1
    length = math.sqrt(sum(math.log1p(x) ** 2 for x in n.values()))
    return {k: math.log1p(x) / length for k, x in n.items()}


def plain_ftrl(rows, epochs=8, alpha=1.0, beta=1.0, l1=0.01, l2=0.01):
    """A scorer, trained on (text, label) one after the other; the bias is feature -1."""
    z, n = {}, {}

    def weight(i):
        v = z.get(i, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    def score(text):
        x = plain_features(text) | {-1: 1.0}
        return x, 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items())))

    for _ in range(epochs):
        for text, label in rows:
            x, p = score(text)
            w = {i: weight(i) for i in x}
            for i, v in x.items():
                g = (p - label) * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return lambda text: score(text)[1]


def test_scores_equal_a_plain_version(spark, labelled):
    rows, labels = labelled
    rows = rows[:150]
    docs = frame(spark, rows)
    order = [r.doc_id for r in docs.where(~quality.held_out()).orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").collect()]
    quality_of = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    texts = dict(rows)
    plain = plain_ftrl([(texts[d], quality_of[d]) for d in order])
    got = quality.scored(docs, quality.train(docs, labels)).collect()
    assert max(abs(r.score - plain(r.text)) for r in got) < 1e-4


def test_repeated_labels_and_rows(spark, labelled):
    rows, labels = labelled
    docs = frame(spark, rows[:60])
    twice = labels.unionByName(labels.withColumn("quality", F.lit(0)))  # of several labels the highest counts
    assert (quality.train(docs, labels) == quality.train(docs, twice)).all()
    assert quality.scored(docs.unionByName(docs), quality.train(docs, labels)).count() == 120


def test_query(spark, sf_dir):
    got = quality.op5_quality(spark, sf_dir).collect()
    assert len(got) == 200 and all(r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
