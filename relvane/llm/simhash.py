"""SimHash near-dedup (operator 1).

Fingerprints link at a Hamming distance of at most `radius`. Any such pair agrees on at least
`blocks - radius` of `blocks` blocks of bits, so each fingerprint is dealt to one bucket for each choice of so
many blocks. In a bucket the distances are computed bit-sliced: bit planes are stored vertically,
one word of a plane holds a bit of 64 pairs, the planes' differences are added up by carry-save counters,
and words of which all pairs exceed the radius are abandoned.

Only distinct fingerprints are compared, a bucket returns a spanning star of each local component instead of
its pairs, and a bucket of more than `limit` fingerprints is cut into pairs of chunks.

keep_first, a stage of the pipeline, takes texts whose fingerprints link at NEAR bits and verifies each by the exact Jaccard similarity of
the sets of word shingles. A pair of similarity 0.8 lies 10 of 64 bits apart on average, beyond what blocks can serve, so pairs that share
all minima of one of BANDS groups of ROWS MinHashes are candidates too: of similarity 0.8 these miss one in 5,500.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, discard, free, raw_texts, stash, table
from .components import connected_components

RADIUS, BLOCKS, SHINGLE, LIMIT = 4, 6, 4, 4096
#: For keep_first: the radius and blocks of candidates (7 is the most that near() counts to), MinHashes in groups, the least Jaccard similarity, and
#: how many sets are compared in one place.
NEAR, NEAR_BLOCKS = 7, 9
BANDS, ROWS, SIMILARITY, SETS = 12, 3, 0.8, 512
#: An exclusive-or and an odd factor for each MinHash.
FLIPS, FACTORS = np.random.default_rng(13).integers(0, 2**64, (2, BANDS * ROWS, 1), np.uint64) | np.array([[[0]], [[1]]], np.uint64)


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """(n, 8) bytes: the hash of each word shingle of a text, repeats included; a text of fewer words is one shingle. Lower case holds for A-Z only."""
    import xxhash

    words = text.lower().split() if text else []
    digest, joined = xxhash.xxh64_digest, b" ".join(words)
    ends = list(accumulate(map(len, words), lambda s, n: s + n + 1, initial=-1)) if len(words) > width else [-1, *[len(joined)] * width]
    return np.frombuffer(b"".join([digest(joined[s + 1 : t], 42) for s, t in zip(ends, ends[width:])]), np.uint8).reshape(-1, 8)


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes."""
    n, counts = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 16384):
        counts += np.unpackbits(hashes[i : i + 16384], axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles (repeats count); 0 without words."""
    return majority(shingle_hashes(text, width)) if text and text.split() else 0


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long): one row for each row of docs; a null text has no words."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = np.array([fingerprint(x, width) for x in raw_texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def planes(fps: np.ndarray) -> np.ndarray:
    """(64, words) uint64: bit i of a plane's word w is that plane's bit of fps[64 * w + i]; one more word of zeros."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    out = np.zeros((64, (len(fps) // 64 + 2) * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def near(diff: Callable[[int, np.ndarray], np.ndarray], asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs asked for (bits of words), those within the radius: (numbers of words, words)."""
    live = np.flatnonzero(asked)
    ones, twos, fours, over = (np.zeros(len(live), np.uint64) for _ in range(4))
    left = asked[live]
    for p in range(64):
        x = diff(p, live)
        carry = ones & x
        ones ^= x
        x = twos & carry
        twos ^= carry
        over |= fours & x
        fours ^= x
        if p >= radius and (p % 8 == 7 or p == 63):
            equal, above = ~np.uint64(0), over.copy()
            for word, bit in ((fours, radius & 4), (twos, radius & 2), (ones, radius & 1)):
                if bit:
                    equal = equal & word
                else:
                    above |= equal & word
                    equal = equal & ~word
            left &= ~above
            if not (keep := left != 0).all():
                live, left, ones, twos, fours, over = live[keep], left[keep], ones[keep], twos[keep], fours[keep], over[keep]
            if not len(live):
                break
    return live, left


def spread(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of a word, bit) of each set bit."""
    return np.nonzero(np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Joins the sets of i and j; root[x] is the smallest member of x's set."""
    while True:
        a, b = root[i], root[j]
        if not (apart := a != b).any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root]).tolist() != root.tolist() if len(root) < 64 else not np.array_equal(up := root[root], root):
            root = up


def near_pairs(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of indices within the radius, in parts, of the runs [start, end)."""
    long = ends - starts >= 48
    if (small := ~long).any():
        size = (ends - starts)[small]
        at = np.repeat(starts[small] - np.r_[0, size.cumsum()[:-1]], size) + np.arange(size.sum())
        stop = np.repeat(ends[small], size)
        rows = planes(fps[at])
        for d in range(1, int(size.max())):
            asked = np.zeros(rows.shape[1] * 64, np.uint8)
            asked[: len(at)] = at + d < stop
            asked = np.packbits(asked, bitorder="little").view(np.uint64)
            up, down = np.uint64(d), np.uint64(64 - d)
            live, left = near(lambda p, w: rows[p, w] ^ ((rows[p, w] >> up) | (rows[p, np.minimum(w + 1, rows.shape[1] - 1)] << down)), asked, radius)
            w, b = spread(left)
            i = live[w] * 64 + b
            yield at[i], at[i] + d
    for s, e in zip(starts[long].tolist(), ends[long].tolist()):
        rows, m = planes(fps[s:e]), e - s
        width = rows.shape[1]
        after = np.arange(width)
        for q in range(0, m, 256):
            own = np.arange(q, min(q + 256, m))
            masks = (((fps[s:e][own][None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)) * ~np.uint64(0)).astype(np.uint64)
            asked = np.where(after[None, :] > own[:, None] // 64, ~np.uint64(0), np.uint64(0))
            shift = (own % 64).astype(np.uint64)
            asked[np.arange(len(own)), own // 64] = (~np.uint64(1)) << shift
            last = m % 64
            asked[:, m // 64] &= np.uint64((1 << last) - 1)
            asked[:, m // 64 + 1 :] = 0
            live, left = near(lambda p, w: rows[p, w % width] ^ masks[p, w // width], asked.ravel(), radius)
            w, b = spread(left)
            yield s + own[live[w] // width], s + (live[w] % width) * 64 + b


def stars(fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, fingerprint) that connect what is connected inside the runs: at most one a fingerprint and run."""
    root = np.arange(len(fps))
    for i, j in near_pairs(fps, starts, ends, radius):
        if len(i):
            root = unite(root, i, j)
    tied = np.flatnonzero(root != np.arange(len(fps)))
    return fps[tied], fps[root[tied]]


def bucket_masks(radius: int, blocks: int) -> list[int]:
    """A mask of bits for each choice of blocks - radius blocks, as signed longs."""
    at = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [(1 << at[i + 1]) - (1 << at[i]) for i in range(blocks)]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def hamming_links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between the distinct values of fps.fp whose components are those of all links within the radius."""
    masks = bucket_masks(radius, blocks)
    fp = F.col("fp")
    dealt = fps.select(fp, F.explode(F.array(*[F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(masks)])).alias("x")).select("x.t", "x.k", "fp")
    large = dealt.groupBy("t", "k").count().where(F.col("count") > limit).select("t", "k", F.ceil(F.col("count") / limit).cast("int").alias("c"))
    chunk = F.pmod(F.xxhash64(F.lit(1), "fp"), F.coalesce("c", F.lit(1))).cast("int")
    dealt = dealt.join(large, ["t", "k"], "left").withColumn("x", chunk).withColumn("y", F.explode(F.sequence(F.lit(0), F.coalesce("c", F.lit(1)) - 1)))
    dealt = dealt.select("t", "k", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "fp")
    keys = ["t", "k", "i", "j"]

    def run(batches):
        import pyarrow as pa

        rest = None
        for batch in batches:
            now = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in [*keys, "fp"]])
            now = now if rest is None else np.concatenate([rest, now], axis=1)
            new = np.flatnonzero((now[:4, 1:] != now[:4, :-1]).any(0)) + 1 if now.shape[1] > 1 else np.array([], int)
            if not len(new):
                rest = now
                continue
            rest = now[:, new[-1] :].copy()
            yield from out(now[:, : new[-1]], new[:-1], pa)
        if rest is not None and rest.shape[1]:
            yield from out(rest, np.array([], int), pa)

    def out(rows, new, pa):
        starts, ends = np.r_[0, new], np.r_[new, rows.shape[1]]
        keep = ends - starts > 1
        if keep.any():
            a, b = stars(np.ascontiguousarray(rows[4]).view(np.uint64), starts[keep], ends[keep], radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, width: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs.

    component_id: the smallest doc_id that links of at most `radius` differing bits reach. Texts that are null,
    empty or without words have fingerprint 0 and link like any other. Rows that share a doc_id each get a row;
    a null doc_id never names a component unless it has no other. Other columns of docs are left aside.
    """
    own = cut(fingerprints(docs, width))
    values = cut(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(hamming_links(values.select("fp"), radius, blocks, limit))
    named = cut(values.join(roots, values.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    ids = cut(named.groupBy("root").agg(F.min("least").alias("component_id")))  # two tables, so that Spark can split the join at a large component
    named = cut(named.join(ids, "root").select("fp", "component_id"))
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of a text's different word shingles."""
    return np.unique(shingle_hashes(text, width).view(np.uint64))


def bands_of(grams: np.ndarray) -> np.ndarray:
    """BANDS hashes, each of ROWS minima."""
    least = np.full(len(FLIPS), 2**64 - 1, np.uint64)
    for i in range(0, len(grams), 4096):
        least = np.minimum(least, ((grams[None, i : i + 4096] ^ FLIPS) * FACTORS).min(1))
    out = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        out = (out ^ row) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, key, fp, bands): a 128-bit hash of each text's shingle set, and the set's fingerprint and bands (bytes). Shingles count once in
    the fingerprint, as in the similarity, so that texts of one repeated filler don't all meet."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            sets = [shingle_set(x, width) for x in raw_texts(batch)]
            keys, bands = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets], [bands_of(x).tobytes() for x in sets]
            fps = [majority(x.view(np.uint8).reshape(-1, 8)) for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(keys, pa.binary()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(bands, pa.binary())], ["doc_id", "row", "key", "fp", "bands"])

    return docs.mapInArrow(run, "doc_id long, row long, key binary, fp long, bands binary")


def fingerprint_rows(kinds: DataFrame, radius: int = NEAR, blocks: int = NEAR_BLOCKS) -> DataFrame:
    """(k, key): buckets of the sets of kinds (key, fp); any two sets whose fingerprints differ in at most `radius` bits share one.

    A bucket is a star of hamming_links(): the fingerprints that one bucket of blocks connects, named by the centre.
    """
    fps = cut(kinds.select("fp").distinct())
    own = fps.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    near_ = cut(hamming_links(fps, radius, blocks).unionByName(own).distinct())
    return kinds.join(near_, F.col("fp") == F.col("a")).select(F.xxhash64(F.lit("fp"), "b").alias("k"), "key")


def band_rows(kinds: DataFrame) -> DataFrame:
    """(k, key): buckets of the sets of kinds (key, bands), BANDS for each."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                k = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(k), batch.column("key").take(pa.array(np.arange(len(k)) // BANDS))], ["k", "key"])

    return kinds.select("key", "bands").mapInArrow(run, "k long, key binary")


def set_buckets(rows: DataFrame, limit: int) -> DataFrame:
    """(k, i, j, key): of rows (k, key) the buckets that hold several sets; of buckets of the same sets one, large ones as pairs of chunks."""
    several = rows.groupBy("k").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x")).where("n > 1")
    several = several.groupBy("n", "x").agg(F.min("k").alias("k")).select("k", F.ceil(F.col("n") / limit).cast("int").alias("c"))
    rows = rows.join(several, "k").withColumn("x", F.pmod(F.xxhash64(F.lit(1), "key"), "c").cast("int")).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    return rows.select("k", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "key")


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least `similarity`."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = np.sort(np.concatenate([a, b]), kind="stable")
    m = int((both[1:] == both[:-1]).sum())
    return m >= similarity * (len(both) - m) - 1e-9


def jaccard_links(docs: DataFrame, kinds: DataFrame, rows: DataFrame, width: int, similarity: float, limit: int) -> DataFrame:
    """Links (a, b) of keys that connect what pairs of at least that Jaccard similarity connect in the buckets of rows (k, key)."""
    members = stash(set_buckets(rows, limit))
    asked = kinds.join(members.select("key").distinct(), "key", "left_semi").select("least.*", "key")

    def own(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([shingle_set(x, width).tobytes() for x in raw_texts(batch)], pa.binary())], ["key", "grams"])

    sets = stash(docs.join(asked, ["doc_id", "row"]).select("key", "text").mapInArrow(own, "key binary, grams binary").dropDuplicates(["key"]))

    def links(keys: list[bytes], sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
        root, out = list(range(len(keys))), []
        for i in range(len(keys)):
            for j in range(i + 1, len(keys)):
                if root[i] != root[j] and similar(sets[i], sets[j], similarity):
                    a, b = root[i], root[j]
                    root = [a if x == b else x for x in root]
                    out.append((keys[i], keys[j]))
        return out

    def run(batches):
        import pyarrow as pa

        def out(pairs):
            return pa.RecordBatch.from_arrays([pa.array([p[x] for p in pairs], pa.binary()) for x in (0, 1)], ["a", "b"])

        at, keys, held = None, [], []
        for batch in batches:
            pairs = []
            for place, key, grams in zip(zip(*(batch.column(c).to_pylist() for c in ("k", "i", "j"))), batch.column("key").to_pylist(), batch.column("grams")):
                if place != at:
                    pairs += links(keys, held)
                    at, keys, held = place, [], []
                keys.append(key), held.append(np.frombuffer(grams.as_py(), np.uint64))
            yield out(pairs)
        yield out(links(keys, held))

    out = stash(members.join(sets, "key").repartition("k", "i", "j").sortWithinPartitions("k", "i", "j").mapInArrow(run, "a binary, b binary"))
    discard(members, sets)
    return out


def keep_first(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY, limit: int = SETS) -> DataFrame:
    """docs with one document of each group, that of the smallest (doc_id, hash of the text); all columns stay.

    Groups are components of links of at least that Jaccard similarity of the sets of word shingles, each link verified; candidates are near
    fingerprints, and beyond their radius common bands. Texts
    without words are alike. Rows that share a doc_id are documents of their own; of those that share the text too, the one of the smallest
    hash of all columns stays. Rows without a doc_id all stay and link nothing.
    """
    text = F.col("text").cast("string")
    named = docs.where(F.col("doc_id").isNotNull())
    plain = named.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    own = stash(shingle_sets(plain, width))
    kinds = stash(own.groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("least"), F.min("fp").alias("fp"), F.min("bands").alias("bands")))
    rows = fingerprint_rows(kinds).unionByName(band_rows(kinds))
    roots = connected_components(jaccard_links(plain, kinds, rows, width, similarity, limit))
    groups = cut(kinds.join(roots, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root")))
    ids = cut(groups.groupBy("root").agg(F.min("least").alias("first")))
    groups = groups.join(ids, "root").select("key", "first")
    ident, row, ident2, row2, place = free(docs.columns, "id", "row", "id2", "row2", "place")
    extra = stash(own.join(groups, "key").where(F.struct("doc_id", "row") != F.col("first")).select(F.col("doc_id").alias(ident2), F.col("row").alias(row2)).distinct())
    discard(own, kinds)
    named = named.withColumns({ident: F.col("doc_id").cast("long"), row: F.xxhash64(text)})
    named = named.join(extra, (F.col(ident) == F.col(ident2)) & (F.col(row) == F.col(row2)), "left_anti")
    named = named.withColumn(place, F.row_number().over(W.partitionBy(ident, row).orderBy(F.xxhash64(*docs.columns)))).where(F.col(place) == 1)
    return named.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
