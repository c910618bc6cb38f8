"""Bounds of edit distances, and how few pairs need the whole table."""

import random

import numpy as np
import pyarrow as pa

from relvane.llm import lines

from .brute import components, near, prose
from .test_lines import distance


def changed(r, x, edits):
    x = list(x)
    for _ in range(edits):
        k = r.randrange(len(x) or 1)
        x[k : k + 1] = r.choice([["q"], [], [*x[k : k + 1], "é"], [*x[k : k + 1], "世"]])
    return "".join(x) or "a"


def pairs(seed, n, alphabet="abcd é世\U0001f600"):
    r, out = random.Random(seed), []
    for k in range(n):
        x = "".join(r.choice(alphabet) for _ in range(r.randrange(1, 200))) * r.choice([1, 1, 3])
        y = changed(r, x, r.randrange(60)) if k % 3 else "".join(r.choice(alphabet) for _ in range(r.randrange(1, 400)))
        x, y = sorted((x, y or "a"), key=len)
        out.append((x, y, distance(x, y)))
    return out


def test_bounds_hold():
    a, b, d = zip(*pairs(5, 240))
    m, n, d = np.array([len(x) for x in a]), np.array([len(x) for x in b]), np.array(d)
    assert (lines.aligned(list(a), list(b), np.maximum(d, n - m)) >= d).all()
    low = (d - (n - m)) // 2
    missed = np.zeros(len(a), np.int64)
    for k in range(len(a)):
        at = list(range(0, int(m[k]), lines.PIECE))
        missed[k] = lines.pieces_missed([a[k]] * len(at), [b[k]] * len(at), at, [low[k]] * len(at), [low[k] + n[k] - m[k]] * len(at)).sum()
    assert (missed <= d).all()


def test_words_of_bits_give_the_distance():
    for seed, alphabet in ((6, "abcd é世\U0001f600"), (7, "ab")):
        rows = [(x, y, d, most) for x, y, d in pairs(seed, 120, alphabet) for most in {max(d - 1, len(y) - len(x)), d, d + 1, d + 40}]
        a, b, d, most = zip(*rows)
        got = lines.in_words(list(a), list(b), np.array(most)).tolist()
        assert got == [x <= y for x, y in zip(d, most)]
        assert got == lines.banded(list(a), list(b), np.array(most)).tolist()


def test_few_pairs_take_the_whole_table(monkeypatch):
    r, a, b, asked = random.Random(8), [], [], []
    for k in range(300):
        x = prose(k, 50)
        words = x.split()
        for _ in range(5):
            words[r.randrange(len(words))] = prose(r.randrange(10**6), 1)
        a.append(x), b.append(" ".join(words) if k % 2 else prose(1000 + k, 50))
    most = [max(len(x), len(y)) // 5 for x, y in zip(a, b)]
    for name in ("banded", "in_words"):
        whole = getattr(lines, name, None)
        if whole:
            monkeypatch.setattr(lines, name, lambda x, y, d, whole=whole: asked.extend(x) or whole(x, y, d))
    assert lines.within(a, b, most).tolist() == [near(*x) for x in zip(a, b, most)]
    assert len(asked) < 30


def test_large_keys_take_few_rounds(monkeypatch):
    n = lines.TABLE + 44
    norms = [prose(k, 6)[:30].ljust(30, "x") for k in range(n)]
    norms[7] = norms[200][:-1] + "?"
    rows = pa.table({"k": [0] * n, "size": [30] * n, "short": [1] * n, "keys": [b"\1" * 4 * lines.BANDS] * n, "codes": [b"\0" * lines.CODES] * n})
    asked, whole = [], lines.within
    monkeypatch.setattr(lines, "within", lambda a, b, most: asked.append(len(a)) or whole(a, b, most))
    root = lines.tie(lines.Bucketed(rows, 0.8), norms).tolist()
    want = components(range(n), [(i, j) for j in range(n) for i in range(j) if near(norms[i], norms[j], 6)])
    assert root == [want[k] for k in range(n)] and root[200] == 7
    assert len(asked) < 40 and sum(asked) >= n * (n - 1) // 2 - n
