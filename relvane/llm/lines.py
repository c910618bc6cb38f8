"""Line dedup (operator 4): exact lines by a 120-bit key, fuzzy lines by MinHash bands and edit similarity.

Lines are normalised (A-Z to lower case, white space to one space); every line that isn't empty then takes part. Two different
normalised lines of at least `words` words or `chars` characters are linked if their edit similarity, 1 - distance / longer length,
is at least `similarity` and the search finds them: they share one of BANDS keys and AGREE of CODES further
MinHashes of windows of eight bytes. A key is the minimum of the line's windows of 16 bytes under one hash or, for lines below
SHORT bytes, a pair of minima of windows of eight bytes; lines around SHORT have both kinds. SimHashes of words within a few bits, the method asked for, find a changed
letter in one line of fifty, so these keys stand in for its blocks (see the README).

Keys travel alone, packed, and only those that different lines of like length share name lines whose texts are fetched and compared. Of
each connected group of lines, the occurrence of the smallest (doc_id, row, line) stays; row is a hash of the text.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket, discard, free, raw_texts, schema, stash, table
from .components import connected_components
from .simhash import unite

WORDS, CHARS, SIMILARITY, LIMIT = 3, 16, 0.8, 1024
#: Keys of a line, and the bits that number them; MinHashes (one byte each) that a pair is tested by before its texts are compared, and how many of
#: these must agree.
BANDS, BITS, CODES, AGREE = 12, 4, 32, 4
#: Keys of up to CROWD lines are paired together, others one by one; up to TABLE lines, the pairs that agree best come first;
#: of larger ones, about ROUND pairs at once.
CROWD, TABLE, ROUND = 8, 256, 1 << 15
#: Bytes below which a line has keys of short windows, and the factor up to which it has both kinds.
SHORT, SLACK = 64, 1.25
#: Cells of a step that pairs of texts make together: small enough for a processor's cache.
WIDTH = 1 << 16
#: Characters in a word of bits, pieces of texts that are looked for together and kinds of characters told apart then; from distances of FAR on,
#: tables are filled by antidiagonals, as there are few such pairs at a time.
PIECE, TOGETHER, KINDS, FAR = 64, 1024, 256, 256
#: The keys of most lines that are split wherever they go, at most; others hold less than one in HOT of all keys. A key is split so early if it has
#: more than WHOLE times the lines of a chunk.
HOT, SAMPLED, WHOLE = 65536, 64, 256
#: Chunks that a key is cut into, at most, while a chunk has no more than LARGEST lines and ROOM characters; so a line has COPIES - 1 entries a key.
COPIES, LARGEST, ROOM = 8, 1 << 16, 1 << 25
#: Rounds in which documents and keys are shuffled, at most, one for each PART lines and each SHARE lines; a round's share is on disk at a time.
ROUNDS, PART, SHARE = 4, 1 << 19, 1 << 21
STEP, CHUNK = 1.04, 1 << 16
#: White space but the line break to spaces.
BLANKS = bytes.maketrans(b"\t\r\x0b\x0c", b"    ")
#: An exclusive-or and an odd factor for each MinHash.
FLIPS, FACTORS = np.random.default_rng(12).integers(0, 2**32, (2, 2 * BANDS + CODES), np.uint32) | np.array([[0], [1]], np.uint32)
LONG, PAIRS = range(BANDS), range(2 * BANDS)
LOW = np.uint64((1 << BITS) - 1)


def normal_lines(text: bytes | None) -> list[bytes]:
    """The text's lines with A-Z as lower case, white space as one space, none at the ends."""
    lines = [x.strip(b" ") for x in (text or b"").lower().translate(BLANKS).split(b"\n")]
    return [b" ".join(x.split()) if b"  " in x else x for x in lines]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (Steele et al., 2014)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def parts_of(lines: list[bytes], most: int):
    """Slices of lines of about `most` bytes."""
    at = 0
    while at < len(lines):
        end, n = at, 0
        while end < len(lines) and (end == at or n + len(lines[end]) < most):
            n += len(lines[end]) + 16
            end += 1
        yield slice(at, end)
        at = end


def minima(lines: list[bytes], width: int, which) -> np.ndarray:
    """(lines, MinHashes) of the windows of `width` (8 or 16) bytes of lines that aren't empty; shorter lines are one window."""
    out = np.zeros((len(lines), len(which)), np.uint32)
    for part in parts_of(lines, CHUNK):
        own = [x.ljust(width, b"\n") for x in lines[part]]
        end = np.cumsum([len(x) for x in own])
        text = b"".join(own)
        codes = np.ndarray(len(text) - 7, "<u8", text, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
        if width > 8:
            codes = codes[: 8 - width] * np.uint64(0xBF58476D1CE4E5B9) + codes[width - 8 :]
        codes = (codes >> np.uint64(32)).astype(np.uint32)
        bounds = np.column_stack([np.r_[0, end[:-1]], end - width + 1]).ravel()[:-1]  # a line's windows, then those that reach into the next line
        for k, p in enumerate(which):
            out[part, k] = np.minimum.reduceat((codes ^ FLIPS[p]) * FACTORS[p], bounds)[::2]
    return out


def keys_of(lines: list[bytes], bits: int = 64) -> list[bytes]:
    """Of each line that isn't empty, the first `bits` of BANDS keys for each kind of windows that it has; a key's low bits number the band."""
    size = np.array([len(x) for x in lines])
    out = [b""] * len(lines)
    band = np.arange(BANDS, dtype=np.uint64)
    for long, those in ((True, size >= SHORT), (False, size < SHORT * SLACK)):
        at = np.flatnonzero(those).tolist()
        if at:
            own = [lines[k] for k in at]
            m = minima(own, 16, LONG).astype(np.uint64) + (np.uint64(1) << np.uint64(32)) if long else minima(own, 8, PAIRS).astype(np.uint64)
            if not long:
                m = m[:, ::2] << np.uint64(32) | m[:, 1::2]
            keys = mixed(mixed(m) + band) & ~LOW | band
            flat = (keys if bits == 64 else (keys >> np.uint64(64 - bits)).astype(f"<u{bits // 8}")).tobytes()
            step = BANDS * bits // 8
            for n, k in enumerate(at):
                out[k] += flat[n * step : (n + 1) * step]
    return out


def classes(lines: list[bytes]) -> np.ndarray:
    """Logarithms of the lengths, as a byte: those of lines similar enough differ by less than reach()."""
    return np.minimum(np.log([max(1, len(x.decode())) for x in lines]) / np.log(STEP), 255).astype(np.uint64)


def reach(similarity: float) -> float:
    return -np.log(similarity) / np.log(STEP) + 1


def all_lines(docs: DataFrame, words: int = WORDS, chars: int = CHARS) -> DataFrame:
    """(doc_id, row, line, fp, key, keys): the lines that aren't empty.

    fp and key: 120 bits of a hash of the normalised line, and in fp the class of its length; keys (bytes): those of keys_of(), null for lines
    that aren't searched for fuzzy ones and where the same line came shortly before.
    """

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            ids, rows, numbers, norms = [], [], [], []
            for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), raw_texts(batch)):
                for k, line in enumerate(normal_lines(text)):
                    if line:
                        ids.append(doc), rows.append(row), numbers.append(k), norms.append(line)
            if not ids:
                continue
            hashes = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x) for x in norms]), np.uint64).reshape(-1, 2)
            fp = hashes[:, 0] & ~np.uint64(255) | classes(norms)
            new = np.zeros(len(norms), bool)
            new[np.unique(fp, return_index=True)[1]] = True
            wide = [k for k in np.flatnonzero(new).tolist() if norms[k].count(b" ") + 1 >= words or len(norms[k].decode()) >= chars]
            keys = [None] * len(norms)
            for k, x in zip(wide, keys_of([norms[k] for k in wide])):
                keys[k] = x
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(numbers, pa.int32()), pa.array(fp.view(np.int64)), pa.array(hashes[:, 1].copy().view(np.int64)), pa.array(keys, pa.binary())], ["doc_id", "row", "line", "fp", "key", "keys"])

    return docs.mapInArrow(run, "doc_id long, row long, line int, fp long, key long, keys binary")


def entries(batch) -> tuple[np.ndarray, np.ndarray]:
    """(keys, fps): an entry for each key of the lines of a batch."""
    keys = batch.column("keys")
    size = np.diff(np.asarray(keys.offsets)) // 8 if hasattr(keys, "offsets") else np.array([len(x) // 8 for x in keys.to_pylist()], int)
    return np.frombuffer(b"".join(keys.to_pylist()), np.uint64), np.repeat(batch.column("fp").to_numpy().view(np.uint64), size)


def hot_keys(searched: DataFrame, limit: int) -> dict[int, int]:
    """Parts for the keys of more than `limit` lines, HOT at most, as a share of the lines shows."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(entries(batch)[0].view(np.int64))], ["k"])

    share = min(SAMPLED, limit)
    some = searched.where(F.pmod("key", F.lit(share)) == 0).select("fp", "keys").distinct().mapInArrow(run, "k long")
    count = stash(some.groupBy("k").count().where(F.col("count") * share > limit))
    n = count.count()
    least = count.approxQuantile("count", [1 - HOT / n], 0.0)[0] + 1 if n > HOT else 0
    out = {r.k: -(-r["count"] * share // limit) for r in count.where(F.col("count") >= least).collect()}  # HOT rows at most
    discard(count)
    return out


def chunked(keys: np.ndarray, fps: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of keys that are split: a chunk of a key meets each of its chunks under a key of its own."""
    x = mixed(fps + np.uint64(1)) % parts.astype(np.uint64)
    at = np.repeat(np.arange(len(keys)), parts)
    y = (np.arange(len(at)) - np.repeat(parts.cumsum() - parts, parts)).astype(np.uint64)
    pair = np.minimum(x[at], y) << np.uint64(32) | np.maximum(x[at], y)
    return mixed(keys[at] ^ mixed(pair + np.uint64(1))) & ~LOW | keys[at] & LOW, fps[at]


def in_chunks(k: int, size: np.ndarray, similarity: float, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): entries of one key's lines, which come by size, in chunks of `limit` lines at least. Two chunks meet under a key of their own if they hold lines of like length."""
    n = len(size)
    step = max(limit, min(-(-n // COPIES), LARGEST, int(ROOM // STEP ** float(size[-1]))))
    start = np.arange(0, n, step)
    stop = np.minimum(start + step, n)
    last = np.searchsorted(size[start], size[stop - 1] + reach(similarity), "right") - 1
    x = np.repeat(np.arange(len(start)), last - np.arange(len(start)))
    y = x + 1 + inside(last - np.arange(len(start)))
    alone = np.setdiff1d(np.arange(len(start)), np.r_[x, y])
    pair = np.r_[x, alone].astype(np.uint64) << np.uint64(32) | np.r_[y, alone].astype(np.uint64)
    keys = mixed(np.uint64(k) ^ mixed(pair + np.uint64(1))) & ~LOW | np.uint64(k) & LOW
    which = np.r_[x, y, alone]
    count = (stop - start)[which]
    return np.repeat(keys[np.r_[: len(x), : len(x), len(x) : len(pair)]], count), np.repeat(start[which], count) + inside(count)


def shared_keys(lines: DataFrame, similarity: float, limit: int, rounds: int = 1) -> list[DataFrame]:
    """(k, fp): the keys that a line shares with another one of like length; keys of more than about `limit` lines in chunks. A table for each share of the bands."""
    searched = lines.where(F.col("keys").isNotNull())
    hot = hot_keys(searched, limit * WHOLE)
    table_ = np.array(sorted(hot), np.int64)
    shared = lines.sparkSession.sparkContext.broadcast((table_, np.array([hot[k] for k in table_.tolist()], np.int64)))
    bits = max(8, (searched.count() * BANDS // rounds // (1 << 20)).bit_length())

    def deal(batches, turn):
        import pyarrow as pa

        known, parts = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            k, fp = entries(batch)
            if rounds > 1:
                own = (k & LOW) % np.uint64(rounds) == turn
                k, fp = k[own], fp[own]
            if len(known):
                at = np.minimum(np.searchsorted(known, k.view(np.int64)), len(known) - 1)
                split = known[at] == k.view(np.int64)
                ck, cf = chunked(k[split], fp[split], parts[at[split]])
                k, fp = np.r_[k[~split], ck], np.r_[fp[~split], cf]
            order = np.argsort(k)
            k, fp = k[order], fp[order]
            part = (k >> np.uint64(64 - bits)).astype(np.int32)
            s = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            offsets = pa.array(np.r_[s, len(k)].astype(np.int32) * 8)
            blobs = [pa.Array.from_buffers(pa.binary(), len(s), [None, offsets.buffers()[1], pa.py_buffer(x.tobytes())]) for x in (k, fp)]
            yield pa.RecordBatch.from_arrays([pa.array(part[s]), *blobs], ["part", "k", "fp"])

    def meet(batches):
        import pyarrow as pa

        for rows in groups(batches, ["part"]):
            k, fp = (np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint64) for c in ("k", "fp"))
            order = np.argsort(k)
            k, fp = k[order], fp[order]
            same = k[1:] == k[:-1]
            several = np.r_[False, same] | np.r_[same, False]
            k, fp = k[several], fp[several]
            size = (fp & np.uint64(255)).astype(np.int16)
            order = np.lexsort((fp, size, k))
            k, fp, size = k[order], fp[order], size[order]
            new = np.r_[True, (k[1:] != k[:-1]) | (fp[1:] != fp[:-1])][: len(k)]
            k, fp, size = k[new], fp[new], size[new]
            close = (k[1:] == k[:-1]) & (size[1:] - size[:-1] <= reach(similarity))
            keep = (np.r_[False, close] | np.r_[close, False])[: len(k)]
            k, fp, size = k[keep], fp[keep], size[keep]
            start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, int)
            many = np.diff(np.r_[start, len(k)])
            large = np.repeat(many > limit, many)
            ck, cf = [k[~large]], [fp[~large]]
            for s, n in zip(start[many > limit].tolist(), many[many > limit].tolist()):
                keys, at = in_chunks(int(k[s]), size[s : s + n], similarity, limit)
                ck.append(keys), cf.append(fp[s + at])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (ck, cf)], ["k", "fp"])

    def shared_in(turn):
        dealt = searched.select("fp", "keys").mapInArrow(lambda batches: deal(batches, turn), "part int, k binary, fp binary")
        return stash(dealt.repartition("part").sortWithinPartitions("part").mapInArrow(meet, "k long, fp long"))

    return [shared_in(turn) for turn in range(rounds)]


def groups(batches, keys: list[str]):
    """Tables of whole groups of rows, several groups in one where they are small; the rows come sorted by the keys."""
    import pyarrow as pa

    rest: list = []
    for batch in chain_last(batches):
        if batch is not None:
            now = pa.Table.from_batches([batch])
            own = [now.column(c).to_numpy() for c in keys]
            if all(x[0] == x[-1] for x in own) and (not rest or all(x[0] == rest[0].column(c)[0].as_py() for x, c in zip(own, keys))):
                rest.append(now)  # all of one group
                continue
            now = pa.concat_tables([*rest, now])
            own = [now.column(c).to_numpy() for c in keys]
            last = np.flatnonzero(np.any([x[1:] != x[:-1] for x in own], axis=0))[-1] + 1
            rest, now = [now.slice(last)], now.slice(0, last)
        elif rest:
            now = pa.concat_tables(rest)
        else:
            return
        yield now


def chain_last(batches):
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def turns(df: DataFrame, by: str, rounds: int) -> list[DataFrame]:
    """df in so many parts by hash of a column."""
    return [df.where(bucket(F.col(by), n=rounds) == k) for k in range(rounds)] if rounds > 1 else [df]


def united(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def of_lines(docs: DataFrame, lines: DataFrame, rounds: int, texts: bool) -> list[DataFrame]:
    """(fp, size, short, keys, codes) of lines (doc_id, row, line, fp), their keys (32 bits each) and MinHashes; with texts, also (doc_id, row, line, norm).

    Tables that the documents are made into in turn, so that only a part of them is shuffled at a time.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, rows, numbers, fps, norms = [], [], [], [], []
            for doc, row, text, asked in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), raw_texts(batch), batch.column("lines").to_pylist()):
                own = normal_lines(text)
                for x in asked:
                    ids.append(doc), rows.append(row), numbers.append(x["line"]), fps.append(x["fp"]), norms.append(own[x["line"]])
            if ids:
                read, keys = [x.decode() for x in norms], keys_of(norms, 32)
                codes = (minima(norms, 8, range(2 * BANDS, 2 * BANDS + CODES)) * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
                out = {"fp": pa.array(fps, pa.int64()), "size": pa.array([len(x) for x in read], pa.int32()), "short": pa.array([int(len(x) < SHORT) for x in norms], pa.int32())}
                out |= {"keys": pa.array(keys, pa.binary()), "codes": pa.array([x.tobytes() for x in codes], pa.binary())}
                if texts:
                    out |= {"doc_id": pa.array(ids, pa.int64()), "row": pa.array(rows, pa.int64()), "line": pa.array(numbers, pa.int32()), "norm": pa.array(read, pa.string())}
                yield pa.RecordBatch.from_pydict(out)

    types = "fp long, size int, short int, keys binary, codes binary" + ", doc_id long, row long, line int, norm string" * texts
    out = []
    for own, wanted in zip(turns(docs, "doc_id", rounds), turns(lines, "doc_id", rounds)):
        wanted = wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("line", "fp")).alias("lines"))
        once = own.join(wanted, ["doc_id", "row"]).select("doc_id", "row", "text", "lines").dropDuplicates(["doc_id", "row"])
        out.append(stash(once.mapInArrow(run, types)))
    return out


def same_ends(a: str, b: str) -> int:
    """How many characters a and b share at their start."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def codes_of(texts: list[str], height: int, start: int, step: int, fill: int) -> np.ndarray:
    """(height, texts): a text's characters down a column from row `start` on, in steps of 1 or -1; `fill` elsewhere."""
    out = np.full((height, len(texts)), fill, np.uint32)
    size = np.array([len(x) for x in texts])
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    inside = np.arange(len(flat)) - np.repeat(size.cumsum() - size, size)
    out[start + step * inside, np.repeat(np.arange(len(texts)), size)] = flat
    return out


def banded(a: list[str], b: list[str], most: np.ndarray) -> np.ndarray:
    """Whether the edit distance of each a (the shorter) and b is at most `most` (at least the difference of the lengths).

    All pairs advance together, one antidiagonal s = i + j of the table of distances at a time. Only diagonals j - i
    from -K to K are kept, as a way within `most` strays no further; even ones are rows of `even`, odd ones rows 1 to K of `odd`.
    """
    m, n = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    order = np.argsort(m + n, kind="stable")
    a, b, m, n, most = [a[k] for k in order.tolist()], [b[k] for k in order.tolist()], m[order], n[order], most[order]
    K = int(((most + n - m) // 2).max())
    K += K & 1
    height = int(n.max()) + 2 * K + 2
    T = height - K - 2
    left, right = codes_of(a, height, T - 1, -1, 1 << 30), codes_of(b, height, K, 1, 1 << 31)
    end, number, out = m + n, order, np.zeros(len(order), bool)
    far, kind = height + 1, np.int32  # more than any distance; a step adds one at most
    if max(left[left < 1 << 30].max(), right[right < 1 << 31].max()) < 0xFFFE:
        left, right = np.minimum(left, 0xFFFE).astype(np.uint16), np.minimum(right, 0xFFFF).astype(np.uint16)
    if 4 * far < 1 << 15:
        kind = np.int16
    even, odd = np.full((K + 1, len(a)), far, kind), np.full((K + 2, len(a)), far, kind)
    even[K // 2] = 0
    for s in range(1, int(end[-1]) + 1):
        h = (s + K) // 2  # K is even: of an odd s, half of s - 1 + K
        if s % 2:
            way = np.minimum(even[:-1], even[1:])
            way += 1
            own = odd[1:-1]
            own += (left[T - h : T - h + K] != right[h : h + K]).astype(kind)
            np.minimum(own, way, out=own)
        else:
            way = np.minimum(odd[:-1], odd[1:])
            way += 1
            even += (left[T - h : T - h + K + 1] != right[h - 1 : h + K]).astype(kind)
            np.minimum(even, way, out=even)
        done = int(np.searchsorted(end, s, "right"))
        if done:
            at, d = np.arange(done), (n - m)[:done]
            last = odd[1 + (d + K - 1) // 2, at] if s % 2 else even[(d + K) // 2, at]
            out[number[:done]] = last <= most[:done]
        live = None
        if s % 64 == 0:  # every way crosses one of the last two antidiagonals, and has the rest of the lengths' difference to go
            least = [(own + np.abs(np.arange(-len(own) + 1, len(own), 2)[:, None] - (n - m))).min(0) for own in (even, odd)]
            live = np.flatnonzero((np.minimum(*least) <= most) & (end > s))
            live = live if 4 * len(live) <= 3 * len(end) else None
        if live is None and done:
            live = np.arange(done, len(end))
        if live is not None:
            if not len(live):
                break
            take = slice(int(live[0]), None) if len(live) == len(end) - live[0] else live
            left, right, even, odd, end, number, m, n, most = left[:, take], right[:, take], even[:, take], odd[:, take], end[take], number[take], m[take], n[take], most[take]
    return out


def flat_codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


def inside(size: np.ndarray) -> np.ndarray:
    """0, 1, ... within each stretch of the sizes given."""
    return np.arange(size.sum()) - np.repeat(size.cumsum() - size, size)


def places(kind: np.ndarray, size: np.ndarray, kinds: int) -> np.ndarray:
    """(pieces, kinds): the bits that say where in a piece (PIECE characters at most, all in a row) a kind of character stands."""
    out = np.zeros((len(size), kinds), np.uint64)
    at, of = inside(size), np.repeat(np.arange(len(size)), size)
    turn = np.argsort(at, kind="stable")
    kind, of = kind[turn], of[turn]
    stop = np.r_[0, np.bincount(at, minlength=PIECE).cumsum()]
    for k in range(PIECE):
        own = slice(stop[k], stop[k + 1])
        out[of[own], kind[own]] |= np.uint64(1 << k)
    return out


def pieces_missed(a: list[str], b: list[str], at: list[int], before: list[int], after: list[int]) -> np.ndarray:
    """How many edits at least make a[at : at + PIECE] a part of b[at - before : at + PIECE + after], a word of bits a piece (Myers, 1999).

    Characters are told apart by their low bits alone, so there may be too few edits, never too many.
    """
    own = [x[p : p + PIECE] for x, p in zip(a, at)]
    text = [y[max(0, p - u) : p + PIECE + v] for y, p, u, v in zip(b, at, before, after)]
    order = np.argsort([-len(y) for y in text], kind="stable")
    own, text = [own[k] for k in order.tolist()], [text[k] for k in order.tolist()]
    size, length, n = np.array([len(x) for x in own]), np.array([len(y) for y in text]), len(own)
    where = places(flat_codes(own) % KINDS, size, KINDS).ravel()
    looked = np.zeros((int(length.max()), n), np.int32)
    looked[inside(length), np.repeat(np.arange(n), length)] = flat_codes(text) % KINDS
    looked += np.arange(n, dtype=np.int32) * KINDS
    last, one = (size - 1).astype(np.uint64), np.uint64(1)
    up, down = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    score, best = size.astype(np.int64), size.astype(np.int64)
    for row, m in zip(looked, np.searchsorted(-length, -np.arange(1, len(looked) + 1), "right").tolist()):
        up, down, last, score = up[:m], down[:m], last[:m], score[:m]
        eq = where.take(row[:m])
        v = eq | down
        h = eq & up
        h += up
        h ^= up
        h |= eq
        plus = ~(h | up)
        plus |= down
        h &= up
        score += ((plus >> last) & one).view(np.int64)
        score -= ((h >> last) & one).view(np.int64)
        np.minimum(best[:m], score, out=best[:m])
        plus <<= one
        h <<= one
        up = ~(plus | v)
        up |= h
        down = plus & v
    out = np.empty(n, np.int64)
    out[order] = best
    return out


def rising(x: np.ndarray) -> list[int]:
    """Places of a longest rising part of x."""
    least: list[int] = []
    where: list[int] = []
    before = []
    for k, v in enumerate(x.tolist()):
        p = bisect_left(least, v)
        before.append(where[p - 1] if p else -1)
        if p == len(least):
            least.append(v), where.append(k)
        else:
            least[p], where[p] = v, k
    out = []
    k = where[-1] if where else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def aligned(a: list[str], b: list[str], most: np.ndarray) -> np.ndarray:
    """Edits, not always the fewest, that make each a (the shorter) its b: ways through common windows, the first of a kind of a to the first of b and so on.

    From one window to the next, a way leaves its diagonal for the other one where that costs least.
    """
    n, m, l = len(a), np.array([len(x) for x in a]), np.array([len(x) for x in b])
    A, B = flat_codes(a), flat_codes(b)
    sa, sb = m.cumsum() - m, l.cumsum() - l
    own = []
    for text, size in ((A, m), (B, l)):
        h, of = text.astype(np.uint64), np.repeat(np.arange(n), size)
        for t in (1, 2, 4):  # windows of 2, 4 and 8 characters
            h = h * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ h >> np.uint64(32))[:-t] * np.uint64(0xBF58476D1CE4E5B9) + h[t:]
        at = np.flatnonzero((h >> np.uint64(62) == 0) & (of[: len(h)] == of[len(of) - len(h) :]))  # a fourth of the windows
        key = of[at].astype(np.uint64) << np.uint64(44) | h[at] >> np.uint64(18) & np.uint64((1 << 44) - 1)
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        count = np.diff(np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])) if len(key) else np.zeros(0, int)
        own.append((mixed(key + inside(count).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), at))
    (ka, ia), (kb, jb) = own
    _, x, y = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    ia, jb = ia[x], jb[y]
    order = np.argsort(ia)
    ia, jb = ia[order], jb[order]
    of = np.searchsorted(sa, ia, "right") - 1
    off, low = (jb - sb[of]) - (ia - sa[of]), (most - (l - m)) // 2
    same = (of[1:] == of[:-1]) & (off[1:] == off[:-1])
    good = (off >= -low[of]) & (off <= (low + l - m)[of]) & (np.r_[False, same] | np.r_[same, False])[: len(of)]
    good &= np.searchsorted(sb, jb, "right") - 1 == of
    ia, jb, of = ia[good], jb[good], of[good]
    good = rising(jb)
    ia, jb, of = ia[good], jb[good], of[good]
    count = np.bincount(of, minlength=n) + 2  # with both ends
    last = count.cumsum() - 1
    first = last - count + 1
    i, j, mid, go = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64), np.ones(count.sum(), bool), np.ones(count.sum(), bool)
    mid[first] = mid[last] = go[last] = False
    i[first], j[first], i[last], j[last], i[mid], j[mid] = sa, sb, sa + m, sb + l, ia, jb
    go = go[:-1]
    i, j, di, dj = i[:-1][go], j[:-1][go], np.diff(i)[go], np.diff(j)[go]
    size, cost = np.minimum(di, dj), np.abs(di - dj)
    some = np.flatnonzero(size)
    of = np.repeat(some, size[some])
    step = inside(size[some])
    x, y = i[of] + step, j[of] + step
    head, tail = (A[x] != B[y]).astype(np.int64), (A[x + (di - size)[of]] != B[y + (dj - size)[of]]).astype(np.int64)
    start, gain = size[some].cumsum() - size[some], (head - tail).cumsum()
    if len(some):
        cost[some] += np.add.reduceat(tail, start) + np.minimum(0, np.minimum.reduceat(gain, start) - np.r_[0, gain][start])
    return np.bincount(np.repeat(np.arange(n), count - 1), cost, minlength=n).astype(np.int64)


def in_words(a: list[str], b: list[str], most: np.ndarray) -> np.ndarray:
    """Like banded(), with the band's columns of PIECE differences as words of bits (Myers, 1999); for many pairs of short texts."""
    m, n, number, out = np.array([len(x) for x in a]), np.array([len(x) for x in b]), np.arange(len(a)), np.zeros(len(a), bool)
    low, high = int(((most - (n - m)) // 2).max()), int(((most + n - m) // 2).max())
    A, B = flat_codes(a), flat_codes(b)
    kind = np.zeros(int(max(A.max(), B.max())) + 1, np.int32)
    kind[A] = 1
    kind = kind.cumsum(dtype=np.int32) * kind  # 0 for characters that no a has
    kinds, width = int(kind.max()) + 1, int(n.max())
    left, right = np.zeros((len(a), int(m.max())), np.int32), np.zeros((width, len(a)), np.int32)
    left[np.repeat(number, m), inside(m)] = kind[A]
    right[inside(n), np.repeat(number, n)] = kind[B]
    at = start = 0
    corner, one = np.zeros(len(a), np.int64), np.uint64(1)
    plus_in = minus_in = np.zeros((0, len(a)), np.uint64)
    while len(m):
        size = np.minimum(PIECE, m - at)
        begin, end = max(0, at - low), min(width, at + PIECE + high)
        if begin > start:  # the value above the left edge
            corner = corner + plus_in[: begin - start].sum(0).view(np.int64) - minus_in[: begin - start].sum(0).view(np.int64)
        plus_in, minus_in = plus_in[begin - start :], minus_in[begin - start :]
        part = left[:, at : at + PIECE]
        where = places(part[np.arange(part.shape[1]) < size[:, None]], size, kinds).ravel()
        where.reshape(-1, kinds)[:, 0] = 0
        looked = right[begin:end] + np.arange(len(m), dtype=np.int32) * kinds
        last, up, down = (size - 1).astype(np.uint64), np.full(len(m), ~np.uint64(0)), np.zeros(len(m), np.uint64)
        plus_out, minus_out = np.empty(looked.shape, np.uint64), np.empty(looked.shape, np.uint64)
        more, less = np.ones(len(m), np.uint64), np.zeros(len(m), np.uint64)
        for t, row in enumerate(looked):
            if t < len(plus_in):
                p, q = plus_in[t], minus_in[t]
            else:
                p, q = more, less
            eq = where.take(row)
            v = eq | down
            eq |= q
            h = eq & up
            h += up
            h ^= up
            h |= eq
            plus = ~(h | up)
            plus |= down
            h &= up
            np.bitwise_and(plus >> last, one, out=plus_out[t])
            np.bitwise_and(h >> last, one, out=minus_out[t])
            plus <<= one
            plus |= p
            h <<= one
            h |= q
            up = ~(plus | v)
            up |= h
            down = plus & v
        way = (plus_out.view(np.int64) - minus_out.view(np.int64)).cumsum(0)
        way += corner + size
        done = m <= at + PIECE
        if done.any():
            out[number[done]] = way[n[done] - begin - 1, np.flatnonzero(done)] <= most[done]
        live = np.flatnonzero(~done & (np.minimum(way.min(0), corner + size) <= most))
        corner = corner[live] + PIECE
        m, n, most, number, left, right = m[live], n[live], most[live], number[live], left[live], right[:, live]
        plus_in, minus_in, at, start = plus_out[:, live], minus_out[:, live], at + PIECE, begin
    return out


def within(a: list[str], b: list[str], most: list[int]) -> np.ndarray:
    """Whether the edit distances of pairs of texts are at most `most`.

    What both ends share is cut off. Then pieces of the shorter text that the longer one lacks show that a distance is too great, a way that
    is cheap enough that it isn't; only what both leave open takes the whole table of distances.
    """
    out = np.zeros(len(a), bool)
    short, long, bounds, number = [], [], [], []
    for k, (x, y, d) in enumerate(zip(a, b, most)):
        if abs(len(x) - len(y)) > d:
            continue
        if x[:1] == y[:1]:
            i = same_ends(x, y)
            x, y = x[i:], y[i:]
        if x[-1:] == y[-1:]:
            i = same_ends(x[::-1], y[::-1])
            x, y = x[: len(x) - i], y[: len(y) - i]
        if max(len(x), len(y)) <= d:
            out[k] = True
        elif x and y:
            x, y = (x, y) if len(x) <= len(y) else (y, x)
            short.append(x), long.append(y), bounds.append(d), number.append(k)
    if not short:
        return out
    m, n, d, number = np.array([len(x) for x in short]), np.array([len(y) for y in long]), np.array(bounds), np.array(number)
    low = (d - (n - m)) // 2  # a way within d strays so far to one side, and by the difference of the lengths more to the other
    missed, at = np.zeros(len(m), np.int64), np.zeros(len(m), np.int64)

    def of(texts: list[str], those: np.ndarray) -> list[str]:
        return [texts[k] for k in those.tolist()]

    def parts(those: np.ndarray, cost: np.ndarray, limit: int):
        """those, by size, in parts whose costs sum up to about the limit."""
        those = those[np.argsort(n[those], kind="stable")]
        return [x for x in np.split(those, np.flatnonzero(np.diff(cost[those].cumsum() // limit)) + 1) if len(x)]

    def search(live: np.ndarray, share: float, width: int) -> None:
        """Looks for further pieces, while at least this share of the characters looked at is missed."""
        while len(live):
            count = np.minimum(width, -(-(m[live] - at[live]) // PIECE))
            whose = np.repeat(live, count)
            start = at[whose] + PIECE * inside(count)
            order = np.argsort(np.minimum(start + PIECE + (low + n - m)[whose], n[whose]) - np.maximum(0, start - low[whose]), kind="stable")
            for x in range(0, len(order), TOGETHER):
                own, s = whose[order[x : x + TOGETHER]], start[order[x : x + TOGETHER]]
                np.add.at(missed, own, pieces_missed(of(short, own), of(long, own), s.tolist(), low[own].tolist(), (low + n - m)[own].tolist()))
            at[live] += PIECE * count
            live = live[(missed[live] <= d[live]) & (at[live] < m[live]) & (missed[live] >= share * at[live])]
            width *= 2

    search(np.flatnonzero(d < FAR), 0.3, 1)
    rest = np.flatnonzero(missed <= d)
    cost = np.zeros(len(m), np.int64)
    for x in parts(rest, n, CHUNK):
        cost[x] = aligned(of(short, x), of(long, x), d[x])
    out[number[rest]] = cost[rest] <= d[rest]
    rest = rest[cost[rest] > d[rest]]
    for x in parts(rest[d[rest] < FAR], n, 8 * CHUNK):
        out[number[x]] = (in_words if len(x) >= PIECE else banded)(of(short, x), of(long, x), d[x])
    rest = rest[d[rest] >= FAR]
    search(rest, 0.2, 64)
    for x in parts(rest[missed[rest] <= d[rest]], d, WIDTH // 4):
        out[number[x]] = banded(of(short, x), of(long, x), d[x])
    return out


class Bucketed:
    """Lines sorted by their key k, as arrays: sizes, keys by kind of windows (lines, 2, BANDS; 0 for none) and MinHashes."""

    def __init__(self, rows, similarity: float):
        self.k, self.size, self.similarity = rows.column("k").to_numpy(), rows.column("size").to_numpy(), similarity
        self.codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(-1, CODES)
        self.keys = np.zeros((len(self.k), 2, BANDS), np.uint32)
        self.band = (self.k.view(np.uint64) & LOW).astype(np.int64)
        own = rows.column("keys").to_pylist()
        both = np.array([len(x) for x in own]) > 4 * BANDS
        kind = (rows.column("short").to_numpy() > 0).astype(int)
        flat = np.frombuffer(b"".join(x[: 4 * BANDS] for x in own), np.uint32).reshape(-1, BANDS)
        self.keys[np.arange(len(own)), np.where(both, 0, kind)] = flat
        if both.any():
            self.keys[both, 1] = np.frombuffer(b"".join(x[4 * BANDS :] for x in own), np.uint32).reshape(-1, BANDS)

    def alike(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs (i, j) of one key those that their sizes and MinHashes allow: i, j, the edit distance that they may have, how many MinHashes agree.

        A pair counts only if its first common key is in the band of the key, so it is compared in one bucket or, with both kinds of keys, two.
        """
        most = ((1 - self.similarity) * np.maximum(self.size[i], self.size[j]) + 1e-9).astype(int)
        ok = np.abs(self.size[i] - self.size[j]) <= most
        i, j, most = i[ok], j[ok], most[ok]
        agree = (self.codes[i] == self.codes[j]).sum(1, dtype=np.int16)
        ok = agree >= AGREE
        i, j, most, agree = i[ok], j[ok], most[ok], agree[ok]
        same = (self.keys[i] == self.keys[j]) & (self.keys[i] != 0)
        ok = same.reshape(len(i), 2 * BANDS).argmax(1) % BANDS == self.band[i]
        return i[ok], j[ok], most[ok], agree[ok]

    def pairs(self, skip):
        """(i, j, most) of candidates of one key, in parts: their edit distances may be up to `most`; skip(i, j) tells those that need not be looked at.

        A line first meets the line that it agrees with best, then the next two, four and so on, all lines at once; of keys of more than
        TABLE lines, a line, then two, four and so on meet all later ones, those with the most usual MinHashes first: a text and its copies are
        tied before two copies, which are further apart, would be compared in vain. All such keys advance together.
        """
        start = np.flatnonzero(np.r_[True, self.k[1:] != self.k[:-1]])
        many = np.diff(np.r_[start, len(self.k)])
        stop = np.repeat(start + many, many)
        found = []
        at = np.flatnonzero(np.repeat(many <= CROWD, many))
        for d in range(1, CROWD):
            at = at[at + d < stop[at]]
            found.append(self.alike(at, at + d))
        for s, n in zip(start[many > CROWD].tolist(), many[many > CROWD].tolist()):
            if n <= TABLE:
                i, j = np.triu_indices(n, 1)
                found.append(self.alike(i + s, j + s))
        i, j, most, agree = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-agree, i))
        i, j, most, width = i[order], j[order], most[order], 1
        while len(i):
            ok = ~skip(i, j)
            i, j, most = i[ok], j[ok], most[ok]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            now = rank < width
            if now.any():
                yield i[now], j[now], most[now]
            i, j, most, width = i[~now], j[~now], most[~now], 2 * width
        large = []
        for s, n in zip(start[many > TABLE].tolist(), many[many > TABLE].tolist()):
            usual = np.zeros(n, np.int64)
            for own in self.codes[s : s + n].T:
                usual += np.bincount(own, minlength=256)[own]
            large.append(s + np.argsort(-usual, kind="stable"))
        width = 1
        while large:
            found, rest = [], []
            for order in large:
                first = np.arange(min(width, max(1, ROUND // len(order)), len(order) - 1))
                later = len(order) - 1 - first
                i, j = np.repeat(order[first], later), order[np.repeat(first, later) + 1 + inside(later)]
                ok = ~skip(i, j)
                found.append(self.alike(i[ok], j[ok])[:3])
                if len(order) > len(first) + 1:
                    rest.append(order[len(first) :])
            i, j, most = (np.concatenate(x) for x in zip(*found))
            if len(i):
                yield i, j, most
            large, width = rest, 2 * width


def candidates(found: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """(k, fp): the lines that have a candidate under their key, found without their texts."""

    def run(batches):
        import pyarrow as pa

        for rows in groups(batches, ["k"]):
            seen = np.zeros(len(rows), bool)
            for i, j, _ in Bucketed(rows, similarity).pairs(lambda i, j: seen[i] & seen[j]):
                seen[i] = seen[j] = True
            if seen.any():
                yield from rows.select(["k", "fp"]).filter(pa.array(seen)).to_batches()

    return found.join(sketches, "fp").repartition("k").sortWithinPartitions("k").select("k", "fp", "size", "short", "keys", "codes").mapInArrow(run, "k long, fp long")


def tie(lines: Bucketed, norms: list[str]) -> np.ndarray:
    """For each line the first one that links of lines of one key connect it to."""
    root = np.arange(len(norms))
    for i, j, most in lines.pairs(lambda i, j: root[i] == root[j]):
        close = within([norms[x] for x in i.tolist()], [norms[x] for x in j.tolist()], most.tolist())
        if close.any():
            root = unite(root, i[close], j[close])
    return root


def fuzzy_links(close: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of lines, each a struct (doc_id, row, line), that connect what linked lines connect. close: (k, fp) of candidates."""

    def run(batches):
        import pyarrow as pa

        for rows in groups(batches, ["k"]):
            root = tie(Bucketed(rows, similarity), rows.column("norm").to_pylist())
            tied = np.flatnonzero(root != np.arange(len(root)))
            own = [rows.column(c).to_numpy() for c in ("doc_id", "row", "line")]
            yield pa.RecordBatch.from_arrays([pa.array(x[y]) for y in (tied, root[tied]) for x in own], ["d1", "r1", "l1", "d2", "r2", "l2"])

    parts = int(close.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # however few bytes, they are much work
    out = close.join(texts, "fp").repartition(parts, "k").sortWithinPartitions("k").mapInArrow(run, "d1 long, r1 long, l1 int, d2 long, r2 long, l2 int")
    return out.select(*[F.struct(F.col(f"d{k}").alias("doc_id"), F.col(f"r{k}").alias("row"), F.col(f"l{k}").alias("line")).alias(x) for k, x in ((1, "a"), (2, "b"))])


def repeated_lines(docs: DataFrame, words: int = WORDS, chars: int = CHARS, similarity: float = SIMILARITY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, row, line): occurrences that are not the first of their group. docs: doc_id long, row long, text string."""
    lines = stash(all_lines(docs, words, chars))
    n = lines.count()
    rounds, shares = min(ROUNDS, 1 + n // PART), min(ROUNDS, 1 + n // SHARE)
    found = shared_keys(lines, similarity, limit, min(rounds, 2))
    slim = stash(lines.drop("keys"))
    discard(lines)
    place = F.struct("doc_id", "row", "line")
    kinds = stash(slim.groupBy("fp", "key").agg(F.min(place).alias("first"), F.count("*").alias("n")))

    def firsts(entries: list[DataFrame]) -> DataFrame:
        return stash(kinds.join(united(entries).select("fp").distinct(), "fp", "left_semi").select("first.*", "fp"))

    wanted = firsts(found)
    sketches = of_lines(docs, wanted, rounds, False)
    discard(wanted)
    close = [stash(candidates(x, united(sketches), similarity)) for x in turns(united(found), "k", shares)]
    discard(*found, *sketches)
    wanted = firsts(close)
    texts = of_lines(docs, wanted, rounds, True)
    discard(wanted)
    links = [stash(fuzzy_links(x, united(texts), similarity)) for x in turns(united(close), "k", shares)]
    discard(*close, *texts)
    roots = connected_components(united(links))
    kept = kinds.join(roots, F.col("first") == F.col("node"), "left").where((F.col("n") > 1) | F.col("root").isNotNull()).select("fp", "key", F.coalesce("root", "first").alias("kept"))
    gone = stash(slim.join(kept, ["fp", "key"]).where(place != F.col("kept")).select("doc_id", "row", "line"))
    discard(slim, kinds, *links)
    return gone


def deduplicated(docs: DataFrame, n_lines: str = "n_lines", n_removed: str = "n_removed", **params) -> DataFrame:
    """docs with the repeated lines taken out of text, and how many lines it had and lost under the two names given, which no column of docs has.

    Null texts stay null, with 0 lines; empty texts have one line, which stays. Rows that share a doc_id are documents of their own, in
    the order of a hash of the text; equal rows count as one and keep the same lines. Rows without a doc_id stay as they are.
    """
    if {n_lines.lower(), n_removed.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError("a column has the name of a count")
    text = F.col("text").cast("string")
    plain = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    names = docs.columns
    ident, row, ident2, row2, gone = free([*docs.columns, n_lines, n_removed], "id", "row", "id2", "row2", "gone")
    lost = repeated_lines(plain, **params).groupBy(F.col("doc_id").alias(ident2), F.col("row").alias(row2)).agg(F.collect_set("line").alias(gone))
    own = docs.withColumn("text", text).withColumns({ident: F.col("doc_id").cast("long"), row: F.xxhash64(text)})
    both = own.join(lost, (F.col(ident) == F.col(ident2)) & (F.col(row) == F.col(row2)), "left").select(*docs.columns, gone)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            kept, counts, removed = [], [], []
            for text, out in zip(batch.column("text").to_pylist(), batch.column(gone).to_pylist()):
                own = [] if text is None else text.split("\n")
                counts.append(len(own))
                if out:
                    out = set(out)
                    own = [x for k, x in enumerate(own) if k not in out]
                    text = "\n".join(own)
                removed.append(counts[-1] - len(own))
                kept.append(text)
            yield pa.RecordBatch.from_arrays([*(pa.array(kept, pa.string()) if n == "text" else batch.column(n) for n in names), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], [*names, n_lines, n_removed])

    shape = T.StructType([*both.drop(gone).schema, *schema(**{n_lines: "long", n_removed: "long"})])
    return both.mapInArrow(run, shape)


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
