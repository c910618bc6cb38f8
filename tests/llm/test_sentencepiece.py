import random

import pytest

from relvane.llm import sentencepiece_fst as fst

from .brute import frame, odd_docs

sp = pytest.importorskip("sentencepiece")

TEXTS = ["", " ", "  a", "a ", "Hello  world\nfoo\tbar ﬁ Ⅷ", "日本語 ñ́", "a\x00b <s> </s><unk>", "x" * 3000, " " * 37 + "end", "\n\n\t \r\n", "thethethethethe" * 30, "▁x", "aaaaaaaaaaaaaaaa aaa", "1234567890 3.14159", "\U0001f600 emoji \U0001f468‍\U0001f469"]


@pytest.fixture(scope="module")
def library():
    return sp.SentencePieceProcessor(model_file=fst.MODEL)


def random_texts(n):
    r = random.Random(3)
    alphabets = ["abcdeinorst ", "the ing er and ▁", "éèüßñ aeiou", "{}();=\n\t x1", "中文日本 a"]
    return ["".join(r.choice(r.choice(alphabets)) for _ in range(r.randrange(1, 120))) for _ in range(n)]


def test_ids_equal_the_library(library):
    t = fst.Transducer(fst.read_model(fst.MODEL))
    for text in TEXTS + random_texts(1500):
        assert list(t.encode(text)) == library.encode(text), text
        assert t.decode(library.encode(text)) == library.decode(library.encode(text)), text


def test_ids_of_documents_equal_the_library(spark, sf_dir, library):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = fst.encoded(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == library.encode(rows[r.doc_id]) and r.decoded == rows[r.doc_id]


def test_odd_rows(spark, library):
    rows = odd_docs()
    got = fst.encoded(frame(spark, rows, ids=1, decoded="x")).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=str) == sorted(((d, None if t is None else library.encode(t), t) for d, t in rows), key=str)
    back = fst.decoded(fst.encoded(frame(spark, rows))).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(rows, key=str)
    assert fst.encoded(frame(spark, [])).collect() == []


def test_query(spark, sf_dir):
    got = fst.op10_sentencepiece(spark, sf_dir).collect()
    assert len(got) == 200 and all(r.n_ids == len(r.ids) for r in got)
