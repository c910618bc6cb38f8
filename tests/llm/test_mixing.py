from collections import Counter, defaultdict

from pyspark.sql import functions as F

from relvane.llm import mixing

from .brute import odd_docs, words


def docs(spark, rows):
    rows = [(d, t, [None, "b", "a", "Z", "é"][(i * i) % 5] if i % 3 else "a") for i, (d, t) in enumerate(rows)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit(1), "target": F.lit("x"), "row": F.lit(2), "slot": F.lit(3)}).repartition(3)


def targets(rows):
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    order = sorted((s for s in size if s is not None), key=str) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(size.values()), set(size), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * size[s]}
        if not full:
            return size, out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * size[s]
            left -= out[s]
        open_ -= full
    return size, out


def test_taken_words_meet_the_targets(spark):
    rows, df = docs(spark, odd_docs())
    size, want = targets(rows)
    for block in (7, 2048):
        got = mixing.mix(df, block=block).collect()
        assert got and sorted(map(str, got)) == sorted(map(str, mixing.mix(df, block=block).collect()))
        taken, per_doc = Counter(), Counter()
        for r in got:
            assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-5
            taken[r.source] += r["words"]
            per_doc[r.source, r.row, r.size] += r["words"]
        assert all(abs(taken[s] - want[s]) <= 0.5 for s in size)
        assert all(n <= 2 * k[2] for k, n in per_doc.items())
        assert Counter((r[0], r[1]) for r in {(r.doc_id, r.source, r.row) for r in got}) == Counter((d, s) for d, _, s in rows)
        pieces = defaultdict(list)
        for r in got:
            if r.slot is not None:
                pieces[r.source, r["rank"]].append(r["words"])
        for s in size:  # all blocks but the last are of equal size
            n = [sum(pieces[s, k]) for k in range(sum(1 for x in pieces if x[0] == s))]
            assert all(x == block for x in n[:-1]) and (not n or 0 < n[-1] <= block)


def test_stretches_hold_their_shares(spark):
    rows = [(i, "w " * 10, "s%d" % (i % 3)) for i in range(3000)]
    t = mixing.source_targets(mixing.sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    got = sorted((r.slot, r.source) for r in mixing.schedule(t, 10).collect())
    share = {r.source: r.target / 45000 for r in t.collect()}
    for i in range(0, len(got) - 100, 500):
        n = Counter(s for _, s in got[i : i + 100])
        assert all(abs(n[s] - 100 * share[s]) < 8 for s in share)


def test_mixed_documents_keep_columns(spark):
    rows, df = docs(spark, odd_docs())
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    n = Counter(r.doc_id for r in out.collect())
    assert max(v for k, v in n.items() if k not in (None, 7)) <= 2 and n[1] == 1 and n[None] == 1


def test_rows_that_share_an_id_and_the_order_of_slots(spark):
    rows = [(i // 2, " ".join("w%d" % (i % 3) for _ in range(5 + i % 7)), "s%d" % (i % 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({k: F.lit(1) for k in ("id", "id2", "origin", "hash", "slots", "slot", "_id", "_times")})
    out = mixing.mixed_documents(df, block=10)
    assert out.columns == df.columns
    got = [(r.doc_id, r.text, r.source) for r in out.collect()]
    pieces = mixing.mix(df, block=10).where("words > 0").collect()
    text = {(d, s): t for d, t, s in rows}
    want = Counter((d, text[d, s], s) for d, s, _ in {(r.doc_id, r.source, r.epoch) for r in pieces})
    assert Counter(got) == want
    share = Counter(s for _, _, s in got)
    for k in range(0, len(got) - 60, 30):  # any stretch of the result holds the sources in their shares
        own = Counter(s for _, _, s in got[k : k + 60])
        assert all(abs(own[s] - 60 * n / len(got)) < 12 for s, n in share.items())


def test_empty_table_and_no_words(spark):
    _, df = docs(spark, [])
    assert mixing.mix(df).collect() == []
    got = mixing.mix(docs(spark, [(1, None), (2, "")])[1]).collect()
    assert [(r.size, r.target, r["words"]) for r in got] == [(0, 0.0, 0)] * 2
