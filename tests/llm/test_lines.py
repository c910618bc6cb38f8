import random

from relvane.llm import lines

from .brute import components, frame, near, odd_docs, prose, row_hash


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def normal(line):
    return b" ".join(line.encode().lower().split()).decode()


def expected(rows, similarity=0.8):
    """(doc_id, text, lines, removed lines) by edit similarity alone; rows are told apart by doc_id and text, in the order the operator takes."""
    order = {(d, t): (d, row_hash(t)) for d, t in rows if d is not None}
    first = {}
    for d, t in rows:
        if d is not None:
            for k, line in enumerate((t or "").split("\n")):
                if n := normal(line):
                    first[n] = min(first.get(n, (*order[d, t], k)), (*order[d, t], k))
    norms = sorted(first, key=first.get)
    wide = [i for i, n in enumerate(norms) if n.count(" ") >= lines.WORDS - 1 or len(n) >= lines.CHARS]
    links = []
    for x, i in enumerate(wide):
        for j in wide[:x]:
            most = int((1 - similarity) * max(len(norms[i]), len(norms[j])) + 1e-9)
            if near(norms[i], norms[j], most):
                links.append((j, i))
    root = components(range(len(norms)), links)
    kept = {n: first[norms[root[i]]] for i, n in enumerate(norms)}
    out = []
    for d, t in rows:
        own = [] if t is None else t.split("\n")
        stay = [x for k, x in enumerate(own) if d is None or not normal(x) or kept[normal(x)] == (*order[d, t], k)]
        out.append((d, None if t is None else "\n".join(stay), len(own), len(own) - len(stay)))
    return sorted(out, key=str)


def line_docs():
    r = random.Random(2)
    base = [prose(i, 12 + 3 * i) for i in range(8)]
    rows = []
    for d in range(40):
        own = []
        for _ in range(r.randrange(1, 6)):
            x = list(r.choice(base))
            for _ in range(r.randrange(3)):
                x[r.randrange(len(x))] = r.choice("abc \t")
            own.append("".join(x).upper() if r.random() < 0.2 else "".join(x))
        own.append(r.choice(["", "}", "two words", prose(1000 + d, 15)]))
        rows.append((300 + d, "\n".join(own)))
    return rows


def removed(spark, rows, **params):
    got = lines.deduplicated(frame(spark, rows, line=1, key="k", fp=2, first="f"), "had", "lost", **params)
    assert got.columns == ["doc_id", "text", "line", "key", "fp", "first", "had", "lost"]
    return sorted(((r.doc_id, r.text, r.had, r.lost) for r in got.collect()), key=str)


def test_lines_stay_as_by_brute_force(spark):
    rows = [x for x in odd_docs() if len(x[1] or "") < 3000] + line_docs()
    want = expected(rows)
    for limit in (lines.LIMIT, 4):
        got = removed(spark, rows, limit=limit)
        assert [(x[0], x[2]) for x in got] == [(x[0], x[2]) for x in want] and all(x[3] <= y[3] for x, y in zip(got, want))  # no line goes without a link
        assert sum(x[3] for x in got) >= 0.98 * sum(x[3] for x in want) and sum(x != y for x, y in zip(got, want)) <= 2  # the search may miss one


def test_rows_that_share_an_id(spark):
    p, q = "\n".join(prose(i, 12) for i in range(6)), "\n".join(prose(50 + i, 12) for i in range(6))
    rows = [(1, p), (2, p), (2, q), (3, q + "\n" + prose(99, 12)), (2, q)]
    got = removed(spark, rows)
    assert got == expected(rows)
    assert [x[3] for x in got if x[1] == q] == [0, 0] and (3, prose(99, 12), 7, 6) in got


def test_clashing_names(spark):
    extra = {k: 1 for k in ("id", "id2", "row", "row2", "gone", "_id", "_gone", "_touched", "n_lines", "n_removed", "norm", "keys", "codes", "part", "k")}
    got = lines.deduplicated(frame(spark, [(1, "a b c\nx"), (2, "A b  c")], **extra), "had", "lost").collect()
    assert sorted((r.doc_id, r.text, r.had, r.lost, r["id"]) for r in got) == [(1, "a b c\nx", 2, 0, 1), (2, "", 1, 1, 1)]


def test_distance():
    r = random.Random(1)
    a, b = ([("".join(r.choice("abc\u00e9\U0001f600") for _ in range(r.randrange(12)))) for _ in range(1200)] for _ in range(2))
    most = [r.choice([0, 2, 5]) for _ in a]
    want = [distance(*x) <= m for *x, m in zip(a, b, most)]
    assert lines.within(a, b, most).tolist() == want == [near(*x) for x in zip(a, b, most)]


def test_distance_of_long_lines():
    r = random.Random(3)
    a, b, most, want = [], [], [], []
    for _ in range(60):
        x = "".join(r.choice("abcd ") for _ in range(r.randrange(100, 300)))
        y = list(x)
        for _ in range(r.randrange(90)):
            k = r.randrange(len(y))
            y[k : k + 1] = r.choice([["q"], [y[k], "z"]])
        y = "".join(y)
        d = distance(x, y)
        for m in {max(0, d - 1), d, d + 1, len(x) // 5}:
            a.append(x), b.append(y), most.append(m), want.append(d <= m)
    assert lines.within(a, b, most).tolist() == want == [near(*x) for x in zip(a, b, most)]
    assert lines.within(a[:1], b[:1], most[:1]).tolist() == want[:1]


def test_distance_of_very_long_lines():
    r = random.Random(4)
    x = "".join(r.choice("abcdefgh ") for _ in range(9000))
    y = list(x)
    for _ in range(700):
        y[r.randrange(len(y))] = "q"
    y, z = "".join(y), "".join(r.choice("ijklmnop") for _ in range(9000))
    d = sum(p != q for p, q in zip(x, y))
    assert lines.within([x, x, z, x], [y, z, y, x], [d, 1800, 1800, 0]).tolist() == [True, False, False, True]


def test_sketches_do_not_depend_on_the_chunk(monkeypatch):
    own = [prose(i, 3 + 40 * (i % 9)).encode() for i in range(60)] + [b"x", b" ".join(b"v%d" % i for i in range(900))]
    whole = lines.keys_of(own)
    monkeypatch.setattr(lines, "CHUNK", 64)
    assert whole == lines.keys_of(own) and all(len(x) in (8 * lines.BANDS, 16 * lines.BANDS) for x in whole)


def test_hot_keys_are_split(spark, monkeypatch):
    rows = [(i, prose(5, 30) + " " + prose(100 + i, 2)) for i in range(80)]
    monkeypatch.setattr(lines, "SAMPLED", 1)
    assert removed(spark, rows, limit=8) == expected(rows)


def test_lines_are_split_as_words_are():
    text = b"  Two\t words \r\n\n\x0bA\x0c\x0cb  c\n"
    assert lines.normal_lines(text) == [b" ".join(x.split()) for x in text.lower().split(b"\n")]
    assert lines.normal_lines(None) == [b""]


def test_very_long_lines(spark):
    x = prose(1, 8000)
    got = lines.deduplicated(frame(spark, [(1, x), (2, x + " more"), (3, x.upper())])).collect()
    assert sorted((r.doc_id, len(r.text)) for r in got) == [(1, len(x)), (2, 0), (3, 0)]


def test_empty_table(spark):
    assert lines.deduplicated(frame(spark, [])).collect() == []


def test_query(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {x[0]: x[2:] for x in expected([(r.doc_id, r.text) for r in docs.collect()])}
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in lines.op4_lines(spark, str(tmp_path)).collect()}
    assert set(got) == set(want) and all(got[d][0] == want[d][0] and got[d][1] <= want[d][1] for d in got)  # links are verified: none is wrong
    assert sum(x[1] for x in got.values()) >= 0.97 * sum(x[1] for x in want.values())
