"""Periodic runs of words by recompression (operator 11; after Jez, 2015, and I, 2017).

A run is a longest stretch of words with smallest period q. Each run of period q and at least 2 q words holds two neighbours i, i + q of
the grid 0, q, 2 q, ...; over all q these are about n ln n candidates. A run is the common extension of such a pair to both sides.

Extensions are answered by a grammar. Texts are rewritten in rounds: block compression gives each stretch a a ... a of one symbol a symbol of its
own, pair compression splits the symbols into left and right ones and gives each left-right pair a symbol. Equal pairs and blocks get
equal symbols, so equal passages are rewritten alike but for their ends, and after O(log n) rounds a text is one symbol. Two
places are compared upwards, from round to round while their symbols agree, at most one symbol or block a round, and from the
first difference downwards, again one a round, to the first words that differ.

Texts travel once, in Arrow batches, and nothing is shuffled. A candidate whose words next to the grid differ on both sides is dropped
before the grammar, and texts without candidates get none.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import raw_texts, table

LEAST = 12
#: Words whose candidates are tried at once; texts up to GRID words share a grid that is laid out once.
WORDS, GRID = 1 << 19, 1 << 15
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def scrambled(x: np.ndarray) -> np.ndarray:
    """A hash of each number (splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grammar:
    """The rounds of recompression of texts that stand between ends: numbers below 0, each different, one before each text and one after the last."""

    def __init__(self, symbols: np.ndarray):
        self.rounds: list[tuple[bool, np.ndarray, np.ndarray, np.ndarray]] = []
        texts = int((symbols < 0).sum()) - 1
        s, fresh, block = symbols.astype(np.int64), int(symbols.max(initial=0)) + 1, True
        while len(s) > 2 * texts + 1:
            start, named, fresh = self.blocks(s, fresh) if block else self.pairs(s, fresh, len(self.rounds))
            self.rounds.append((block, s, np.flatnonzero(start), np.cumsum(start) - 1))
            s, block = named, not block
        self.top = s

    @staticmethod
    def blocks(s: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(which symbols start a block, the blocks' symbols, the next new symbol)."""
        start = np.r_[True, s[1:] != s[:-1]]
        at = np.flatnonzero(start)
        size, named = np.diff(np.r_[at, len(s)]), s[at]
        several = np.flatnonzero(size > 1)
        if len(several):
            kinds, number = np.unique(named[several] * (int(size.max()) + 1) + size[several], return_inverse=True)
            named[several] = fresh + number
            fresh += len(kinds)
        return start, named, fresh

    @staticmethod
    def pairs(s: np.ndarray, fresh: int, turn: int) -> tuple[np.ndarray, np.ndarray, int]:
        """As blocks(). Which symbols are left ones follows from a hash, in the direction that makes more pairs."""
        left, inner = (scrambled(s + (turn << 40)) & np.uint64(1)).astype(bool), s >= 0
        both = inner[:-1] & inner[1:]
        pair, other = both & left[:-1] & ~left[1:], both & ~left[:-1] & left[1:]
        if other.sum() > pair.sum():
            pair = other
        at = np.flatnonzero(pair)
        start = np.ones(len(s), bool)
        start[at + 1] = False
        named = s.copy()
        kinds, number = np.unique(s[at] * fresh + s[at + 1], return_inverse=True)
        named[at] = fresh + number
        return start, named[start], fresh + len(kinds)

    def common(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from places i < j of a text onwards; with back: before them."""
        i0, i, j = i, i.copy(), j.copy()
        seen = -1 if back else 0  # the symbol next to a place
        level = np.full(len(i), len(self.rounds))
        live = np.arange(len(i))
        for n, (block, s, first, up) in enumerate(self.rounds):
            a, b = i[live], j[live]
            same = s[a + seen] == s[b + seen]
            level[live[~same]] = n
            live, a, b = live[same], a[same], b[same]
            if not len(live):
                break
            if block:
                x, y = self.rest(first, up, len(s), a, back), self.rest(first, up, len(s), b, back)
                step, even = np.minimum(x, y), x == y
                level[live[~even]] = n
            else:
                even = np.ones(len(live), bool)
                step = ((first[up[a]] != a) | (first[up[b]] != b)).astype(np.int64)
            if back:
                step = -step
            a, b = a + step, b + step
            i[live], j[live] = np.where(even, up[a], a), np.where(even, up[b], b)
            live = live[even]
        for n in range(min(len(self.rounds), int(level.max(initial=0))) - 1, -1, -1):
            block, s, first, up = self.rounds[n]
            down = np.flatnonzero(level > n)
            a, b = first[i[down]], first[j[down]]
            same = s[a + seen] == s[b + seen]
            step = same.astype(np.int64)
            if block:
                step *= np.minimum(self.rest(first, up, len(s), a, back), self.rest(first, up, len(s), b, back))
            if back:
                step = -step
            i[down], j[down] = a + step, b + step
        return np.abs(i - i0)

    @staticmethod
    def rest(first: np.ndarray, up: np.ndarray, n: int, at: np.ndarray, back: bool) -> np.ndarray:
        """Symbols left of the block that a place is in, or before it."""
        if back:
            return at - first[up[at - 1]]
        block = up[at] + 1
        return np.where(block < len(first), first[np.minimum(block, len(first) - 1)], n) - at


_grid: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def laid_out(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, ends): the pairs of neighbours i < j of all grids up to n, by j; ends[m]: how many have j < m."""
    if n not in _grid:
        j = np.concatenate([np.arange(q, n, q, dtype=np.int32) for q in range(1, n)])
        q = np.repeat(np.arange(1, n, dtype=np.int32), [(n - 1) // q for q in range(1, n)])
        order = np.argsort(j, kind="stable")
        j = j[order]
        _grid[n] = (j - q[order], j, np.searchsorted(j, np.arange(n + 1)))
    return _grid[n]


def candidates(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours i, j of a grid whose words agree next to it.

    A run of period q agrees with itself, q words on, along max(least - q, q) words or more, so half as many, and `near` at least,
    stand before or after i. Hashes of `near` words are compared, which agree where the words do.
    """
    n = len(codes)
    near = max(1, min(3, (least // 2 + 1) // 2))
    if n < max(least, 2):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    after = np.arange(n, dtype=np.int64) + (1 << 62)  # no two alike: too few words follow
    before = after.copy()
    h = np.zeros(n - near + 1, np.uint64)
    for k in range(near):
        h ^= (codes[k : n - near + 1 + k].astype(np.uint64) + np.uint64(1)) * MIX[k]
    h = (scrambled(h) >> np.uint64(2)).view(np.int64)
    after[: n - near + 1] = h
    before[near:] = h[: n - near]
    if n <= GRID:
        i, j, ends = laid_out(GRID if n > GRID // 16 else GRID // 16)
        i, j = i[: ends[n]], j[: ends[n]]
        ok = np.flatnonzero((after[i] == after[j]) | (before[i] == before[j]))
        return i[ok].astype(np.int64), j[ok].astype(np.int64)
    found = []
    for q in range(1, n // 2 + 1):
        a, b = after[::q], before[::q]
        ok = np.flatnonzero((a[:-1] == a[1:]) | (b[:-1] == b[1:]))
        if len(ok):
            found.append(np.stack([ok * q, ok * q + q]))
    return tuple(np.concatenate(found, 1)) if found else (np.zeros(0, np.int64),) * 2


def runs_of(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """For each text, as codes of its words from 0, its runs (start, length, period) of max(least, 2 * period) words or more, by start and period."""
    tried = [candidates(x, least) for x in texts]
    some = [k for k, (i, _) in enumerate(tried) if len(i)]
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    if not some:
        return out
    sizes = np.array([len(texts[k]) for k in some])
    offset = np.cumsum(sizes + 1) - sizes  # after its end in front
    symbols = np.empty(int(sizes.sum()) + len(some) + 1, np.int64)
    symbols[np.r_[offset - 1, len(symbols) - 1]] = -1 - np.arange(len(some) + 1)
    for k, o in zip(some, offset):
        symbols[o : o + len(texts[k])] = texts[k]
    grammar = Grammar(symbols)
    which = np.repeat(np.arange(len(some)), [len(tried[k][0]) for k in some])
    i, j = (np.concatenate([tried[k][x] for k in some]) + offset[which] for x in (0, 1))
    q = j - i
    ahead, behind = grammar.common(i, j), grammar.common(i, j, back=True)
    ok = ahead + behind >= np.maximum(least - q, q)
    which, start, length, q = which[ok], (i - behind)[ok], (ahead + behind + q)[ok], q[ok]
    order = np.lexsort((q, length, start, which))
    which, start, length, q = (x[order] for x in (which, start, length, q))
    new = np.r_[True, (which[1:] != which[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])] if len(q) else np.zeros(0, bool)
    which, start, length, q = which[new], start[new], length[new], q[new]  # of a stretch the smallest period
    start = start - offset[which]
    order = np.lexsort((q, start, which))
    rows, ends = np.stack([start, length, q], 1)[order], np.searchsorted(which, np.arange(len(some) + 1))
    for n, k in enumerate(some):
        out[k] = rows[ends[n] : ends[n + 1]]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, joined by one space, less those that a run contains after its first period."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [w for w, gone in zip(words, (edge.cumsum() > 0).tolist()) if not gone]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = LEAST, words: Callable[[int | None, bytes], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of docs. runs: (start, length, period) of each run of at least max(least, 2 * period) words, by
    start and period; collapsed: the words joined by one space, of each run the first period alone.

    A null or empty text has no words. Rows that share an id, and rows without one, are rows of their own. words: (doc_id, text) to
    the words to look at; the text's own words unless given. A text is the work of one task, whose memory grows with it.
    """

    def run(batches):
        import pyarrow as pa

        def done(ids, lists):
            flat = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode().indices.to_numpy()
            ends = np.cumsum([len(x) for x in lists])
            found = runs_of(np.split(flat, ends[:-1]), least)
            offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int32))
            rows = np.concatenate(found)
            runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], ["start", "length", "period"]))
            kept = pa.array([collapsed(w, r) for w, r in zip(lists, found)], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(x) for x in lists], pa.int64()), runs, kept], ["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            ids, lists, n = [], [], 0
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                text = raw_texts(batch.slice(k, 1))[0] or b""
                ids.append(doc), lists.append(text.split() if words is None else words(doc, text))
                n += len(lists[-1])
                if n >= WORDS:
                    yield done(ids, lists)
                    ids, lists, n = [], [], 0
            if ids:
                yield done(ids, lists)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(doc: int | None, text: bytes) -> list[bytes]:
    """The words of a text; of each document whose crc32 of the id ends in 0, those from one on repeat. Without an id, the text's own."""
    words = text.split()
    g, last = divmod(zlib.crc32(str(doc).encode()), 10)
    n = len(words)
    if doc is None or last or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), words=planted)
    best = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    rows = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))))
    x = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.try_element_at(best, F.lit(1)).alias("best"), F.sha2(rows, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length = -F.col("best.less")
    return x.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"), F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
