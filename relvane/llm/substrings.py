"""Substring dedup by level-wise doubling (operator 7).

A word is removed if a window of 20 words covers it whose words also start earlier: in a smaller doc_id, or
in the same document before. Rows are told apart by (doc_id, row), row being a hash of the text. Levels of 5, 10 and 20 words find these windows, and only what is repeated at one
level is extended to twice its length:

* Length 5. Of the 5-word windows inside each window of 20 words the one of the smallest hash, the leftmost on ties, is
  its anchor. It follows from the words alone, so equal windows have equal anchors; only some 12 % of all positions
  are anchors. Consecutive windows with one anchor are a context of 20 to 35 words. Anchors that occur once go.
* Contexts. Equal contexts are repeats as they stand: all but the first are covered whole. The first ones go on if
  their anchor also has another context.
* Length 10. A window of 20 words with its anchor at its start or up to 10 words on contains the 10 words from the anchor
  on; any other contains the 10 words that end with the anchor. Groups of windows whose 10 words occur once go.
* Length 20. The windows left are compared by the hashes of all their words and of the ten, 128 bits, and each but the first of
  its kind is covered.

Counts and first positions are aggregated before the shuffle and written; a repeated context or window meets its first position
in an ordinary equi-join of two tables, whose hot keys Spark splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, raw_texts, stash, table
from .quality import Codes

BASE, WINDOW = 5, 20
_A = 0x9E3779B97F4A7C15
_A_INVERSE = pow(_A, -1, 1 << 64)


def finish(h: np.ndarray, length) -> np.ndarray:
    """Mixes polynomial hashes (and their lengths) so that all bits count."""
    h = h ^ (np.asarray(length, np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashed:
    """Hashes of any stretch of a text's words, from running sums; equal stretches have equal hashes."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        up = np.full(n + 1, _A, np.uint64)
        down = np.full(n + 1, _A_INVERSE, np.uint64)
        up[0] = down[0] = 1
        self.up = np.cumprod(up, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * np.cumprod(down, dtype=np.uint64)[:n], out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return finish((self.sums[hi] - self.sums[lo]) * self.up[lo], hi - lo)


def contexts(codes: np.ndarray) -> tuple[np.ndarray, ...] | None:
    """(lo, hi, anchor, hash of the anchor, hash of the context) of each context; None below 20 words."""
    n = len(codes)
    if n < WINDOW:
        return None
    hashed, at = Hashed(codes), np.arange(n - BASE + 1)
    h = hashed.of(at, at + BASE)
    step = 1
    while step < WINDOW - BASE + 1:  # 16 = 2 ** 4 anchors to choose from
        left, right = at[:-step], at[step:]
        at = np.where(h[left] <= h[right], left, right)
        step *= 2
    new = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1]
    lo, hi, a = new, np.r_[new[1:], len(at)] + WINDOW - 1, at[new]
    return lo, hi, a, h[a], hashed.of(lo, hi)


def halves(codes: np.ndarray, lo: int, hi: int, a: int, hashed: Hashed) -> list[tuple[int, int, np.ndarray]]:
    """(first window, hash of its 10 words, hashes of the windows) for the windows on either side."""
    out = []
    for first, last, ten in ((max(lo, a - 10), hi - WINDOW, a), (lo, min(a - 11, hi - WINDOW), a - 5)):
        if first <= last:
            p = np.arange(first, last + 1)
            out.append((first, int(hashed.of(np.array([ten]), np.array([ten + 10]))[0]), hashed.of(p, p + WINDOW)))
    return out


def arrow(columns: dict, types: dict):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(columns[k], types[k]) for k in types], list(types))


def anchored(docs: DataFrame) -> DataFrame:
    """(doc_id, row, lo, hi, anchor, h5, hc): one row for each context."""

    def run(batches):
        import pyarrow as pa

        codes = Codes(7)
        for batch in batches:
            out = []
            for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), raw_texts(batch)):
                if text is not None and (got := contexts(codes.of(text.split()))):
                    out.append((np.full(len(got[0]), doc, np.int64), np.full(len(got[0]), row, np.int64), *got))
            if out:
                d, r, lo, hi, a, h5, hc = (np.concatenate(x) for x in zip(*out))
                yield arrow({"doc_id": d, "row": r, "lo": lo.astype(np.int32), "hi": hi.astype(np.int32), "anchor": a.astype(np.int32), "h5": h5.view(np.int64), "hc": hc.view(np.int64)}, {"doc_id": pa.int64(), "row": pa.int64(), "lo": pa.int32(), "hi": pa.int32(), "anchor": pa.int32(), "h5": pa.int64(), "hc": pa.int64()})

    return docs.where(F.col("doc_id").isNotNull()).mapInArrow(run, "doc_id long, row long, lo int, hi int, anchor int, h5 long, hc long")


def extended(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, row, first, h10, windows array of hashes) for the contexts wanted (doc_id, row, spans)."""

    def run(batches):
        import pyarrow as pa

        codes = Codes(7)
        for batch in batches:
            spans = batch.column("spans")
            o = spans.offsets.to_numpy()
            lo, hi, a = (spans.values.field(k).to_numpy() for k in ("lo", "hi", "anchor"))
            ids, rows, firsts, tens, windows = [], [], [], [], []
            for k, (doc, row, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), raw_texts(batch))):
                c = codes.of((text or b"").split())
                hashed = Hashed(c)
                for s in range(o[k], o[k + 1]):
                    for first, ten, hs in halves(c, int(lo[s]), int(hi[s]), int(a[s]), hashed):
                        ids.append(doc), rows.append(row), firsts.append(first), tens.append(ten), windows.append(hs)
            if ids:
                offsets = np.r_[0, np.cumsum([len(x) for x in windows])].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(windows).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(firsts, pa.int32()), pa.array(np.array(tens, np.uint64).view(np.int64)), lists], ["doc_id", "row", "first", "h10", "windows"])

    return docs.join(wanted, ["doc_id", "row"]).select("doc_id", "row", "text", "spans").mapInArrow(run, "doc_id long, row long, first int, h10 long, windows array<long>")


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """The values of a column that more than one row has."""
    return stash(rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, row, lo, hi): stretches of words covered by windows that also start earlier. docs: doc_id, row, text."""
    place = ["doc_id", "row", "lo"]
    every = stash(anchored(docs))
    twice = repeated(every, "h5")
    rows = stash(every.join(twice, "h5", "left_semi"))
    discard(every, twice)
    firsts = stash(rows.groupBy("h5", "hc").agg(F.min(F.struct(*place, "hi", "anchor")).alias("first"), F.count("*").alias("n")))
    whole = rows.join(firsts.where("n > 1").select("h5", "hc", *[F.col(f"first.{c}").alias(f"first_{c}") for c in place]), ["h5", "hc"])
    whole = stash(whole.where(" or ".join(f"{c} != first_{c}" for c in place)).select(*place, "hi"))
    several = repeated(firsts, "h5")
    wanted = firsts.join(several, "h5", "left_semi").select("first.*").groupBy("doc_id", "row").agg(F.collect_list(F.struct("lo", "hi", "anchor")).alias("spans"))
    tens = stash(extended(docs, wanted))
    discard(rows, firsts, several)
    twice = repeated(tens, "h10")
    windows = stash(tens.join(twice, "h10", "left_semi").select("doc_id", "row", "first", "h10", F.posexplode("windows").alias("i", "h20")).select("doc_id", "row", (F.col("first") + F.col("i")).alias("lo"), "h10", "h20"))
    discard(tens, twice)
    first = stash(windows.groupBy("h10", "h20").agg(F.min(F.struct(*place)).alias("at"), F.count("*").alias("n")).where("n > 1").select("h10", "h20", *[F.col(f"at.{c}").alias(f"first_{c}") for c in place]))
    single = windows.join(first, ["h10", "h20"]).where(" or ".join(f"{c} != first_{c}" for c in place)).select(*place, (F.col("lo") + WINDOW).alias("hi"))
    out = stash(whole.unionByName(single).groupBy("doc_id", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    discard(whole, windows, first)
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of docs; kept: the words that stay, joined by one space.

    A null text has no words. Texts below 20 words stay whole. Rows that share a doc_id are documents of their own, in the order of
    a hash of the text; equal rows count as one and keep the same words. Rows without a doc_id stay whole and remove nothing.
    """
    text = F.col("text").cast("string")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    both = plain.join(repeats(plain), ["doc_id", "row"], "left").select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            spans = batch.column("spans")
            o = spans.offsets.to_numpy()
            lo, hi = (spans.values.field(k).to_numpy() for k in ("lo", "hi"))
            counts, removed, kept = [], [], []
            for k, text in enumerate(raw_texts(batch)):
                words = (text or b"").split()
                n = len(words)
                s, e = lo[o[k] : o[k + 1]], hi[o[k] : o[k + 1]]
                counts.append(n)
                if len(s):
                    edge = np.bincount(np.minimum(s, n), minlength=n + 1) - np.bincount(np.minimum(e, n), minlength=n + 1)
                    stay = edge.cumsum()[:n] == 0
                    words = [w for w, x in zip(words, stay.tolist()) if x]
                removed.append(n - len(words))
                kept.append(b" ".join(words).decode())
            yield arrow({"doc_id": batch.column("doc_id"), "n_words": counts, "n_removed": removed, "kept": kept}, {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()})

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
