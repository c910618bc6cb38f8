import random
import re

import pytest

from relvane.llm import licenses

from .brute import frame, odd_docs, prose

NOTICES = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC", "This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}


@pytest.fixture(scope="module")
def model(spark):
    return licenses.train(frame(spark, [(i, prose(i, 40) + "\n" + prose(1000 + i, 12)) for i in range(200)]))


def test_planted_notices(spark, model):
    r = random.Random(4)
    rows, want = [], set()
    for i in range(200):
        own = [prose(5000 + i, 30), prose(6000 + i, 8)]
        if i % 2:
            notice = r.choice(sorted(NOTICES))
            at = r.randrange(3)
            own.insert(at, notice if i % 4 == 1 else f"{prose(7000 + i, 4)} {notice.upper()} {prose(8000 + i, 3)}")
            want.add((i, at, NOTICES[notice]))
        rows.append((i, "\n".join(own)))
    got = licenses.scan(frame(spark, rows, paragraph=1, family="x", row=2), model).collect()
    assert {(x.doc_id, x.paragraph, x.family) for x in got} == want and len(got) == len(want)
    assert all(x.similarity >= 0.8 and x.probability >= model.least for x in got)


def test_near_misses_are_left_alone(spark, model):
    rows = [(1, "the licensed driver was released under bail"), (2, "general public opinion, version control and the software"), (3, "Licensed under")]
    assert licenses.scan(frame(spark, rows), model).collect() == []


def grams(text):
    ws = re.findall(r"[^\W_]+(?:[.+-]+[^\W_]+)*", text.lower())
    return set(zip(ws, ws[1:]))


def matches(text):
    """By plain comparison with all templates."""
    return any(len(grams(t) & grams(text)) >= 0.8 * len(grams(t)) for ts in licenses.TEMPLATES.values() for t in ts)


def test_lines_that_match_a_template(spark, model):
    lines = ["Released under the MIT License", "Licensed under the MIT License, see LICENSE", "Released under the GPL", "released into the public domain - enjoy", "Licensed under CC BY 4.0", "# SPDX-License-Identifier: Apache-2.0",
             "a license to kill", "the mit license of the", "Use of this source code is governed by a BSD-style license", "Licensed under CC BY 3.0", *(t for ts in licenses.TEMPLATES.values() for t in ts)]
    got = licenses.scan(frame(spark, list(enumerate(lines))), model).collect()
    assert {r.doc_id for r in got} == {i for i, x in enumerate(lines) if matches(x)}
    family = {r.doc_id: r.family for r in got}
    at = len(lines) - sum(map(len, licenses.TEMPLATES.values()))
    own = [f for f, ts in licenses.TEMPLATES.items() for _ in ts]
    assert sum(family[at + i] == f for i, f in enumerate(own)) >= 0.9 * len(own)
    assert [family[i] for i in range(6)] == ["MIT", "MIT", "GPL", "public domain", "CC-BY", "Apache-2.0"]


def test_wrapped_notices(spark, model):
    notice = licenses.TEMPLATES["MIT"][2].split()
    wrapped = "\n".join(" * " + " ".join(notice[i : i + 9]) for i in range(0, len(notice), 9))
    rows = [(1, f"#!/bin/sh\n{wrapped}\n\n{prose(3, 60)}"), (2, f"{prose(4, 20)}\nReleased under\nthe ISC License\n{prose(5, 20)}"), (3, f"{prose(6, 9)}\nReleased under the GPL.\n{prose(7, 9)}")]
    got = sorted((r.doc_id, r.paragraph, r.family) for r in licenses.scan(frame(spark, rows), model).collect())
    assert got == [(1, 0, "MIT"), (2, 0, "ISC"), (3, 1, "GPL")]


def test_odd_rows(spark, model):
    assert licenses.scan(frame(spark, odd_docs()), model).collect() == []
    assert licenses.scan(frame(spark, []), model).collect() == []
    assert [x.family for x in licenses.scan(frame(spark, [(None, "Released under the MIT License.")] * 2), model).collect()] == ["MIT"]


def test_query_finds_all_notices(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = sorted((d.doc_id, k, NOTICES[line]) for d in docs for k, line in enumerate((d.text or "").split("\n")) if line in NOTICES)
    got = sorted((r.doc_id, r.paragraph, r.family) for r in licenses.op8_licenses(spark, sf_dir).collect())
    assert set(want) <= set(got) and len(got) <= len(want) + 1
