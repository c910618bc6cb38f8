import hashlib
import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
sp = pytest.importorskip("sentencepiece")

from relvane.llm import sentencepiece_fst  # noqa: E402

from .brute import prose, row_hash, words  # noqa: E402
from .test_keep_first import kept  # noqa: E402
from .test_lines import expected as lines_expected  # noqa: E402
from .test_mixing import targets  # noqa: E402
from .test_quality import plain_ftrl  # noqa: E402


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with documents of all kinds: good and bad ones, copies, shared lines, nulls, empty texts, rows that share an id."""
    rows = []
    for i in range(60):
        good = "\n".join(prose(100 * i + k, 12 + k) for k in range(5))
        rows.append((i, good if i % 4 else prose(i, 50).upper().replace(" ", "!! "), "s%d" % (i % 3)))
    rows += [(100, rows[1][1], "s1"), (101, rows[2][1] + "\n" + prose(9000, 9), None), (102, rows[1][1].split("\n")[0] + "\n" + prose(9001, 80), "s2"), (103, None, "s0"), (104, "", "s1"), (105, "x", None)]
    rows += [(100, prose(9002, 90), "s0"), (100, prose(9002, 90), "s0"), (None, prose(9003, 30), "s1")]
    at = str(tmp_path_factory.mktemp("small"))
    spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")}).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, rows


def test_run_equals_brute_force(spark, small):
    at, rows = small
    label = {i: int(i % 4 > 0) for i in range(60)}
    docs = spark.read.parquet(f"{at}/documents.parquet")
    order = docs.where(F.col("doc_id").isin(list(label)) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0)).orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id", "text").collect()
    plain = plain_ftrl([(r.text, label[r.doc_id]) for r in order])
    good = [x for x in rows if plain(x[1]) >= 0.3]
    assert all(x[0] % 4 for x in good if x[0] is not None and x[0] < 60) and len(good) >= 45
    lined = lines_expected([(d, t) for d, t, _ in good])
    texts = []
    pool = [(d, t, s) for d, t, s in good]
    for d, t, n, m in lined:  # each result belongs to a row of its doc_id with as many lines
        for k, (e, u, s) in enumerate(pool):
            if e == d and (0 if u is None else len(u.split("\n"))) == n and set((t or "").split("\n")) <= set((u or "").split("\n")) | {""}:
                pool.pop(k)
                break
        if m == 0 or m < n:
            texts.append((d, t, s))
    stay = kept([(d, t) for d, t, _ in texts], rows=True)
    texts = [x for x in texts if x[0] is None or (x[0], x[1]) in stay]
    texts = [x for i, x in enumerate(texts) if x[0] is None or (x[0], x[1]) not in {(y[0], y[1]) for y in texts[:i]}]
    size, goal = targets(texts)
    want, before = Counter(), Counter()
    for d, t, s in sorted(texts, key=lambda x: (hashlib.md5(("mix|" + (str(x[0]) if x[0] is not None else "")).encode() if x[0] is not None else b"mix").hexdigest(), x[0] is not None, x[0] or 0, len(words(x[1])), row_hash(x[1]))):
        n, top = len(words(t)), math.floor(round(goal[s], 6) + 0.5)
        taken = sum(max(0, min(n, top - e * size[s] - before[s])) > 0 for e in (0, 1))
        want[d, t] += 1 if d is None or not n else taken
        before[s] += n
    library = sp.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    got = Counter((r.doc_id, None if r.ids is None else tuple(r.ids)) for r in corpus_pipeline.run(spark, at).collect())
    assert got == Counter({(d, None if t is None else tuple(library.encode(t))): n for (d, t), n in (+want).items()})


def test_stages_with_clashing_names(spark, small):
    at, _ = small
    names = ["id", "row", "gone", "_id", "_gone", "_touched", "slot", "slots", "n_lines", "n_removed", "score", "place", "hash"]
    docs = spark.read.parquet(f"{at}/documents.parquet").drop("n_chars").withColumns({k: F.lit(1) for k in names})
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, at)
        assert out.columns == docs.columns and out.count() > 0
        assert stage(spark, docs.limit(0), at).count() == 0


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_tables_of_spent_stages_go(spark, small, monkeypatch):
    at, _ = small
    made, whole = [], corpus_pipeline.stash
    monkeypatch.setattr(corpus_pipeline, "stash", lambda df: made.append(whole(df)) or made[-1])
    assert corpus_pipeline.run(spark, at).count() == made[-1].count()
    assert [os.path.exists(x.stash_path.removeprefix("file:")) for x in made] == [False, False, False, True]
