import hashlib

from relvane.llm import substrings

from .brute import frame, odd_docs, prose, row_hash, words


def expected(rows):
    """By row: (doc_id, hash of the text, start) is a window's place."""
    first = {}
    texts = [(d, row_hash(t), words(t)) for d, t in rows]
    for d, h, ws in texts:
        for i in range(len(ws) - 19):
            key = tuple(ws[i : i + 20])
            if d is not None:
                first[key] = min(first.get(key, (d, h, i)), (d, h, i))
    out = []
    for d, h, ws in texts:
        gone = set()
        for i in range(len(ws) - 19):
            if d is not None and first[tuple(ws[i : i + 20])] < (d, h, i):
                gone |= set(range(i, i + 20))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def shared_passages():
    """Passages of many lengths and offsets, some one word short of a window, some that overlap."""
    p = prose(50, 200).split()
    rows = []
    for i in range(40):
        n = 17 + i
        rows.append((200 + i, " ".join([*prose(300 + i, i % 7).split(), *p[i : i + n], *prose(400 + i, i % 5).split(), *p[100 : 100 + n // 2]])))
    return rows


def test_words_stay_as_by_brute_force(spark):
    rows = odd_docs() + shared_passages()
    got = substrings.deduplicated(frame(spark, rows, lo=1, hi="x", n=2, spans=3)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got), key=str) == expected(rows)


def test_rows_that_share_an_id(spark):
    p, q = prose(70, 40), prose(71, 40)
    rows = [(1, p), (2, p), (2, q), (2, q), (3, q + " " + prose(72, 5))]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substrings.deduplicated(frame(spark, rows, row=1)).collect()), key=str)
    assert got == expected(rows) and sorted(r[2] for r in got) == [0, 0, 0, 40, 40]


def test_empty_table(spark):
    assert substrings.deduplicated(frame(spark, [])).collect() == []


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in substrings.op7_substrings(spark, sf_dir).collect()), key=str) == expected(rows)
