"""Plain helpers of the brute-force versions."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def row_hash(text):
    """The hash of the text by which rows of a doc_id are ordered."""
    if text is None:
        return 42
    import xxhash

    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("w%d" % r.randrange(vocabulary) for _ in range(n))


def odd_docs():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, copies and near copies."""
    r = random.Random(5)
    out = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "One"), (5, "one two three"), (6, "ünï cödé   nbsp"), (None, "no id here at all"), (7, "twice the same row"), (7, "twice the same row")]
    base = prose(1, 300).split()
    for i in range(20):
        copy = list(base)
        for _ in range(i % 4):
            copy[r.randrange(len(copy))] = "x%d" % r.randrange(50)
        out.append((10 + i, " ".join(copy)))
    out += [(40 + i, prose(100 + i, 30 + 7 * i)) for i in range(30)]
    out += [(80 + i, prose(7, 60)) for i in range(5)]
    out += [(90, "be " * 500), (91, "be " * 90), (92, prose(9, 6000)), (93, prose(1, 300) + " " + prose(9, 40))]
    return out


def frame(spark, rows, **extra):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()}).repartition(3)


def near(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most `most`, bit-parallel in one long number (Myers, 1999)."""
    if abs(len(a) - len(b)) > most:
        return False
    if not a or not b:
        return max(len(a), len(b)) <= most
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    m, n = len(a), len(b)
    full, top, up, down, score = (1 << m) - 1, 1 << (m - 1), (1 << m) - 1, 0, m
    for k, c in enumerate(b, 1):
        eq = at.get(c, 0)
        x = eq | down
        y = ((((eq & up) + up) ^ up) | eq) & full
        more, less = down | (full & ~(y | up)), up & y
        score += bool(more & top) - bool(less & top)
        more, less = (more << 1 | 1) & full, less << 1 & full
        up, down = less | (full & ~(x | more)), more & x
    return score <= most
