"""What line dedup writes and shuffles: few copies of a key's lines, texts of candidates alone, a part of the table at a time."""

import random

import numpy as np
import pytest

from relvane.llm import lines

from .brute import frame, prose
from .test_lines import expected, line_docs, removed


@pytest.mark.parametrize("spread", [1, 8, 60])
def test_lines_of_a_large_key_are_copied_a_bounded_number_of_times(spread):
    size = np.sort(np.random.default_rng(spread).integers(80, 80 + spread, 3000)).astype(np.int16)
    keys, at = lines.in_chunks((7 << 40) + 5, size, 0.8, 16)
    assert set((keys & lines.LOW).tolist()) == {5} and set(at.tolist()) == set(range(len(size)))
    assert np.bincount(at).max() < lines.COPIES and (spread < 60 or len(at) < 4 * len(size))
    met = np.zeros((len(size), len(size)), bool)
    for k in set(keys.tolist()):
        own = at[keys == k]
        assert len(set(own.tolist())) == len(own)
        met[np.ix_(own, own)] = True
    assert met[np.abs(size[:, None] - size) <= lines.reach(0.8)].all()


def test_long_lines_stay_in_small_chunks():
    keys, at = lines.in_chunks(0, np.full(40 * 1024, 255, np.int16), 0.8, 1024)
    assert np.unique(keys, return_counts=True)[1].max() <= 2 * lines.ROOM // lines.STEP**255


@pytest.mark.parametrize("rounds", [2, 4])
def test_rounds_change_nothing(spark, monkeypatch, rounds):
    rows = line_docs() + [(i, prose(5, 30) + " " + prose(100 + i, 2)) for i in range(40)]
    one = removed(spark, rows)
    for name, value in (("PART", 16), ("SHARE", 16), ("ROUNDS", rounds)):
        monkeypatch.setattr(lines, name, value)
    asked, whole = [], lines.of_lines
    monkeypatch.setattr(lines, "of_lines", lambda docs, wanted, n, texts: asked.append(n) or whole(docs, wanted, n, texts))
    assert removed(spark, rows) == one and asked == [rounds, rounds]
    assert sum(x[3] for x in one) >= 0.98 * sum(x[3] for x in expected(rows))


def test_keys_of_very_many_lines_are_split_before_they_meet(spark, monkeypatch):
    rows = [(i, prose(5, 30) + " " + prose(100 + i, 2)) for i in range(80)]
    for name, value in (("SAMPLED", 1), ("WHOLE", 1), ("PART", 30), ("SHARE", 60)):
        monkeypatch.setattr(lines, name, value)
    assert removed(spark, rows, limit=8) == expected(rows)


def test_texts_of_lines_without_candidates_are_not_fetched(spark, monkeypatch):
    r = random.Random(6)
    head = "the same start of many "
    rows = [(i, head + "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300))) for i in range(300)] + [(500 + i, prose(3, 20) + " x" * i) for i in range(2)]
    fetched, whole = {}, lines.of_lines
    monkeypatch.setattr(lines, "of_lines", lambda docs, wanted, n, texts: fetched.update({texts: wanted.count()}) or whole(docs, wanted, n, texts))
    got = lines.deduplicated(frame(spark, rows)).collect()
    assert [r.doc_id for r in got if r.n_removed] == [501]
    assert fetched[False] > 40 and fetched[True] < fetched[False] // 4
