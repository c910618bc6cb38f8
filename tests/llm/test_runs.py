import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from relvane.llm import runs

from .brute import frame, odd_docs, words


def plain_runs(w, least=12):
    """Every longest stretch of equal words q apart, by smallest period, straight from the definition."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        start = None
        for i in range(n - q + 1):
            same = i < n - q and w[i] == w[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                if i - start + q >= max(least, 2 * q):
                    found.setdefault((start, i - start + q), q)
                start = None
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_collapsed(w, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def generated(r, n, kinds):
    w = ["w%d" % r.randrange(kinds) for _ in range(n)]
    if n and r.random() < 0.6:
        a = r.randrange(n)
        p = 1 + r.randrange(max(1, (n - a) // 3 + 1))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_of_small_alphabets_by_definition():
    r = random.Random(3)
    for _ in range(150):
        texts, least = [generated(r, r.randrange(0, 110), r.choice([1, 2, 3, 30])) for _ in range(5)], r.choice([2, 3, 12, 40])
        got = runs.runs_of([np.array([int(x[1:]) for x in t], np.int32) for t in texts], least)
        assert [[tuple(x) for x in g.tolist()] for g in got] == [plain_runs(t, least) for t in texts]


def test_extensions_by_comparison():
    r = random.Random(4)
    texts = [generated(r, n, 3) for n in (1, 2, 7, 60, 200)]
    symbols, at = [-1], []
    for k, t in enumerate(texts):
        at.append(len(symbols))
        symbols += [int(x[1:]) for x in t] + [-2 - k]
    g = runs.Grammar(np.array(symbols))
    assert len(g.top) == 2 * len(texts) + 1 and len(g.rounds) < 60
    pairs = [(o + i, o + j) for o, t in zip(at, texts) for j in range(len(t)) for i in range(j)]
    pairs = r.sample(pairs, 2000)
    i, j = (np.array(x) for x in zip(*pairs))
    ahead, behind = g.common(i, j), g.common(i, j, back=True)
    for a, b, f, k in zip(i.tolist(), j.tolist(), ahead.tolist(), behind.tolist()):
        assert symbols[a : a + f] == symbols[b : b + f] and symbols[a + f] != symbols[b + f]
        assert symbols[a - k : a] == symbols[b - k : b] and symbols[a - k - 1] != symbols[b - k - 1]


def test_long_texts_and_those_beyond_the_laid_out_grid(monkeypatch):
    r = random.Random(5)
    w = generated(r, 900, 400) + ["x%d" % (k % 7) for k in range(300)] + generated(r, 900, 400)
    codes = np.unique(w, return_inverse=True)[1].astype(np.int32)
    wanted = plain_runs(w)
    assert wanted and [tuple(x) for x in runs.runs_of([codes])[0].tolist()] == wanted
    monkeypatch.setattr(runs, "GRID", 500)
    assert [tuple(x) for x in runs.runs_of([codes])[0].tolist()] == wanted
    one = np.zeros(20_000, np.int32)
    assert runs.runs_of([one])[0].tolist() == [[0, 20_000, 1]]


def test_operator_on_odd_rows(spark):
    docs = odd_docs() + [(200, "a b\tc a\nb c a b c a b c a"), (201, "a b " * 5 + "a"), (201, "a b " * 6), (202, "x " + "p q r s t u v " * 2 + "y")]
    got = runs.periodic_runs(frame(spark, docs, runs=1, n_words="z", words=2)).collect()
    assert len(got) == len(docs)
    plain = []
    for i, t in docs:
        w = words(t)
        found = plain_runs(w)
        plain.append((i, len(w), found, plain_collapsed(w, found)))
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[3])
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got), key=key) == sorted(plain, key=key)
    assert runs.periodic_runs(frame(spark, [(1, "x")]).where("false")).collect() == []


def test_query_as_by_definition(spark, sf_dir, tmp_path):
    docs = [(i, t) for i, t in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if len(words(t)) < 900]
    docs += [(10_000, None), (10_001, ""), (10_002, "no " * 40), (10_010, "one"), (None, "b " * 30)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wanted = set()
    for i, t in docs:
        w, n = words(t), len(words(t))
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        found = plain_runs(w)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        row = (i, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest("".join("%d,%d,%d\n" % x for x in found)), digest(plain_collapsed(w, found)))
        wanted.add(row)
    got = runs.op11_runs(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"), ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(docs) and set(rows) == wanted
    assert sum(x[1] > 0 for x in rows) > 5


def test_nothing_is_shuffled(spark, sf_dir):
    plan = runs.op11_runs(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and re.search("MapInArrow", plan)
    assert runs.periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("label", F.lit(1))).columns == ["doc_id", "n_words", "runs", "collapsed"]
