"""Line dedup against edit similarity alone, and exact copies of short lines."""

import random

from relvane.llm import lines

from .brute import frame, near, prose

ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def changed(r, line, edits):
    x = list(line)
    for _ in range(edits):
        k = r.randrange(len(x))
        x[k : k + 1] = r.choice([[r.choice(ALPHABET)], [], [x[k], r.choice(ALPHABET)]])
    return " ".join("".join(x).split())


def reworded(r, line, n):
    ws = line.split()
    for _ in range(n):
        ws[r.randrange(len(ws))] = "".join(r.choice(ALPHABET) for _ in range(r.randrange(3, 9)))
    return " ".join(ws)


def pairs_of_lines(seed, n):
    """(kind, line, changed line) with an edit similarity of 0.8 at least, lines of 5 to 50 words."""
    r, out = random.Random(seed), []
    while len(out) < n:
        size = r.randrange(5, 51)
        a = " ".join("".join(r.choice(ALPHABET) for _ in range(r.randrange(2, 10))) for _ in range(size))
        kind = r.choice(["letter", "letters", "words"])
        b = changed(r, a, 1) if kind == "letter" else changed(r, a, max(1, int(r.random() * 0.2 * len(a)))) if kind == "letters" else reworded(r, a, max(1, int(r.random() * 0.2 * size)))
        if a != b and near(a, b, int(0.2 * max(len(a), len(b)) + 1e-9)):
            out.append((kind, a, b))
    return out


def test_recall_against_edit_similarity_alone(spark):
    made = pairs_of_lines(3, 900)
    rows = [(k, x) for i, (_, a, b) in enumerate(made) for k, x in ((2 * i, a), (2 * i + 1, b))]
    for limit in (lines.LIMIT, 4):
        gone = {r.doc_id for r in lines.deduplicated(frame(spark, rows), limit=limit).where("n_removed = 1").collect()}
        assert not {d for d in gone if d % 2 == 0}  # all other lines are unlike
        found = {kind: sum(2 * i + 1 in gone for i, m in enumerate(made) if m[0] == kind) / sum(m[0] == kind for m in made) for kind in ("letter", "letters", "words")}
        print(limit, found, len(gone) / len(made))
        assert found["letter"] >= 0.98 and found["words"] >= 0.98 and found["letters"] >= 0.62, found


def test_short_lines_go_as_exact_copies(spark):
    text = "}\nHome\n\nread more\n这是一个没有空格的句子所以只有一个词\n" + "QUJD" * 30
    got = lines.deduplicated(frame(spark, [(1, text), (2, text + "\n" + prose(1, 9)), (3, "home")])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, text), (2, "\n" + prose(1, 9)), (3, "")]


def test_lines_without_spaces_take_part_in_the_fuzzy_search(spark):
    x = "这是一个没有空格的句子所以只有一个词而且它相当长因此可以模糊比较"
    got = lines.deduplicated(frame(spark, [(1, x), (2, x + "了"), (3, "这")])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, x), (2, ""), (3, "这")]
