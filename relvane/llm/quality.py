"""Quality classifier (operator 5): logistic regression on hashed word n-grams, trained with FTRL-proximal
updates (McMahan et al., 2013) and scored as a sparse dot product.

A text is read as tokens (runs of letters, digits and other characters of words; runs of punctuation), case kept.
Features are unigrams and bigrams, hashed into 2**bits buckets; a token that follows itself is one bigram of its own.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import raw_texts, table

#: Training reads at most so many labelled documents, those of the smallest hashes of doc_id.
SAMPLE = 8192
PLACES = 1 << 40
BITS, EPOCHS, ALPHA, BETA, L1, L2 = 18, 8, 1.0, 1.0, 0.01, 0.01
THRESHOLD = 0.3
TOKEN = re.compile(rb"[A-Za-z0-9_\x80-\xff]+|[^A-Za-z0-9_\x80-\xff\s]+")


class Codes(dict):
    """64-bit codes of byte strings, computed once each while they fit."""

    def __init__(self, seed: int = 0, most: int = 1_000_000):
        super().__init__()
        import xxhash

        self.digest, self.seed, self.most = xxhash.xxh64_intdigest, seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        code = self[word] = self.digest(word, self.seed)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def features(text: bytes | None, codes: Codes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values (log of 1 + count, to length 1) of a text; none for a text without tokens."""
    c = codes.of(TOKEN.findall(text or b""))
    if not len(c):
        return np.array([], np.int32), np.array([], np.float32)
    pairs = (c[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ c[1:]) * np.uint64(0xD6E8FEB86659FD93)
    pairs[c[1:] == c[:-1]] = np.uint64(1) << np.uint64(63)
    at, n = np.unique(np.concatenate([c, pairs]) >> np.uint64(64 - bits), return_counts=True)
    values = np.log1p(n)
    return at.astype(np.int32), (values / np.sqrt(values @ values)).astype(np.float32)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the bias last, after so many passes over rows of (buckets, values, label)."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for at, x, y in rows:
            i, x = np.append(at, size), np.append(x, 1.0)
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(np.arange(size + 1)).astype(np.float32)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> np.ndarray:
    """Weights learnt from at most `sample` labelled documents of docs that are not held out, those of the smallest hashes.

    Labels without a quality or a document, and held-out rows, are not read; of several labels of a document the highest
    counts. The sample is bounded, so one task trains and 2**bits weights come back, whatever the size of docs.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(PLACES))
    bound = int(min(1.0, 1.2 * sample / max(1, known.count())) * PLACES)  # so tasks send about as many ids as are kept
    known = known.where(place <= bound).orderBy(place, "doc_id").limit(sample)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id")

    def read(batches):
        import pyarrow as pa

        codes = Codes()
        for batch in batches:
            got = [features(x, codes, bits) for x in raw_texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality").cast(pa.int32()), pa.array([a for a, _ in got], pa.list_(pa.int32())), pa.array([v for _, v in got], pa.list_(pa.float32()))], ["doc_id", "quality", "at", "x"])

    def learn(batches):
        import pyarrow as pa

        seen = []
        for batch in batches:
            at, x = batch.column("at"), batch.column("x")
            o, a, v = at.offsets.to_numpy(), at.values.to_numpy(), x.values.to_numpy()
            seen += [(a[s:e].copy(), v[s:e].copy(), int(y > 0)) for s, e, y in zip(o, o[1:], batch.column("quality").to_pylist())]
        if seen:
            w = ftrl(seen, bits)
            i = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(w[i])], ["i", "w"])

    one = rows.mapInArrow(read, "doc_id long, quality int, at array<int>, x array<float>").repartition(1).sortWithinPartitions(F.xxhash64(F.lit(1), "doc_id"), "doc_id", "at", "x")
    w = np.zeros((1 << bits) + 1, np.float32)
    for i, v in one.mapInArrow(learn, "i int, w float").collect():  # at most 2**bits + 1 numbers
        w[i] = v
    return w


def scored(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """docs with score, the chance that quality is 1 by the text alone, in place of a column of that name. Null and empty texts get the bias's score."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    bits = len(weights).bit_length() - 1
    docs = docs.drop(name)
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        codes, w = Codes(), shared.value
        for batch in batches:
            got = (features(x, codes, bits) for x in raw_texts(batch))
            s = np.array([w[at] @ x + w[-1] for at, x in got], np.float64)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(1 / (1 + np.exp(-np.clip(s, -35, 35))))], [*names, name])

    return docs.mapInArrow(run, docs.select("*", F.lit(0.0).alias(name)).schema)


def keep_good(docs: DataFrame, labels: DataFrame, known: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs whose score is at least the threshold, all columns as they are; the classifier is trained on the labelled rows of `known`."""
    name = max(docs.columns, key=len) + "_score"  # longer than any other name
    return scored(docs, train(known, labels), name).where(F.col(name) >= threshold).drop(name)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
