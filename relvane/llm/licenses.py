"""License scan (operator 8): a trained paragraph classifier whose predictions a template comparison confirms.
DataFrame, SQL and pyspark.ml (JVM) functions only.

A paragraph is a line, or a stretch of SPAN lines (one begins every SPAN / 2 lines) for notices that are wrapped over lines; comment marks count as
spaces. Its features are the word bigrams, lower case, that occur in any template (a vocabulary of fixed size). A multinomial
logistic regression is trained on mutilated copies of the templates, which lack every fifth bigram or one end, and, as class
"unknown", on paragraphs of a bounded sample of the corpus that resemble no template. The least family probability that counts is
calibrated on other mutilated copies and on held-out paragraphs of that sample. A prediction is confirmed if the paragraph holds enough of the
bigrams of one of the family's templates. Scoring explodes all bigrams of all paragraphs and joins the few that a template knows with
their weights and templates: the sparse dot product is a sum by paragraph. Texts that cannot match a template are left out before.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import add, or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, stash, table

UNKNOWN = "unknown"
#: Documents of the corpus that training reads, about, for class "unknown"; share of its paragraphs that is for calibration only, by hash.
SAMPLE, HELD = 1000, 5
SIMILARITY, LEAST, FALSE_RATE, SPAN = 0.8, 0.5, 0.001, 12

#: Notices by which public licences are applied, and paragraphs of their texts.
TEMPLATES = {
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "Artistic": ["This is free software; you can redistribute it and/or modify it under the terms of the Artistic License", "Released under the Artistic License 2.0.", "SPDX-License-Identifier: Artistic-2.0"],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "Use, modification and distribution are subject to the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-NC-SA": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License", "SPDX-License-Identifier: EPL-2.0"],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPL.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Released under the LGPL.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
        "SPDX-License-Identifier: MIT",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "public domain": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "Released into the public domain.",
        "CC0 1.0 Universal Public Domain Dedication",
        "SPDX-License-Identifier: CC0-1.0",
        "SPDX-License-Identifier: Unlicense",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "SPDX-License-Identifier: Zlib",
    ],
}


#: What separates words: anything but letters and digits, and but full stops, plus and minus signs inside a word.
BETWEEN = r"[^\p{L}\p{N}.+-]+|[.+-]+(?![\p{L}\p{N}.+-])|(?<![\p{L}\p{N}.+-])[.+-]+"


def words_of(text):
    """Lower-case runs of letters, digits and inner marks, as one array."""
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def bigrams(words):
    """Bigrams joined by a space, with the ends marked, so that one word has two."""
    padded = F.concat(F.array(F.lit("^")), words, F.array(F.lit("$")))
    pairs = F.arrays_zip(F.slice(padded, F.lit(1), F.size(padded) - 1).alias("a"), F.slice(padded, F.lit(2), F.size(padded) - 1).alias("b"))
    return F.transform(pairs, lambda p: F.concat_ws(" ", p["a"], p["b"]))


def paragraphs(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, row, paragraph, many, text): each line of each text, and each stretch of lines under the number of its first; row tells rows
    apart that share a doc_id, many says whether it is a stretch."""
    text = F.col("text").cast("string")
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), F.split(text, "\n").alias("_l"))
    one = lines.select("doc_id", "row", F.posexplode("_l").alias("paragraph", "text"), F.lit(False).alias("many"))
    starts = F.when(F.size("_l") > 1, F.sequence(F.lit(0), F.greatest(F.size("_l") - 2, F.lit(0)), F.lit(span // 2)))
    several = lines.select("doc_id", "row", F.explode(starts).alias("paragraph"), "_l").select("doc_id", "row", "paragraph", F.array_join(F.slice("_l", F.col("paragraph") + 1, span), " ").alias("text"), F.lit(True).alias("many"))
    return one.unionByName(several).select("doc_id", "row", "paragraph", "many", "text")


def templates(spark: SparkSession, given: dict | None = None) -> DataFrame:
    """(id, family, grams): a row for each template; the bigrams at the ends, which hold marks of the ends, are left out."""
    rows = [(i, f, t) for i, (f, t) in enumerate((f, t) for f, ts in (given or TEMPLATES).items() for t in ts)]
    grams = F.array_distinct(bigrams(words_of(F.col("text"))))
    return spark.createDataFrame(rows, "id int, family string, text string").select("id", "family", F.filter(grams, lambda g: ~g.startswith("^ ") & ~g.endswith(" $")).alias("grams"))


def anchors(given: dict | None = None, at_least: float = SIMILARITY) -> list[str]:
    """Words of which any paragraph holds one that matches a template.

    A match misses at most (1 - at_least) of a template's bigrams; a template's anchors touch more of them than that. So a text
    without any anchor has no match, and the scan need not take it apart.
    """
    out: list[str] = []
    for text in (t for ts in (given or TEMPLATES).values() for t in ts):
        words = re.findall(r"[^\W_]+(?:[.+-]+[^\W_]+)*", text.lower())
        left = set(zip(words, words[1:]))
        need, touched = (1 - at_least) * len(left) + 1e-9, 0
        for w in sorted(set(words), key=lambda w: (w not in out, -len(w), w)):
            if touched > need:
                break
            hit = {b for b in left if w in b}
            if hit:
                out.append(w)
                touched += len(hit)
                left -= hit
    return sorted(set(out))


def any_of(text, words: list[str]):
    low = F.lower(text)
    return reduce(or_, [F.contains(low, F.lit(w)) for w in words])


class Model:
    """Weights of bigrams by class and the templates that hold them (gram, w array, ids array), biases, classes, the calibrated least
    probability, and (id, family, number of bigrams) of the templates."""

    def __init__(self, classes, biases, weights, least, known):
        self.classes, self.biases, self.weights, self.least, self.known = classes, biases, weights, least, known

    def probabilities(self, rows: DataFrame, sums: list[str]) -> DataFrame:
        """rows with the softmax over the classes in place of each sum of weights."""
        total = rows.withColumns({c: F.round(c, 9) + F.lit(b) for c, b in zip(sums, self.biases)})
        powers = total.withColumn("top", F.greatest(*sums) if len(sums) > 1 else F.col(sums[0])).withColumns({c: F.exp(F.col(c) - F.col("top")) for c in sums})
        return powers.withColumn("top", reduce(add, map(F.col, sums))).withColumns({c: F.col(c) / F.col("top") for c in sums}).drop("top")


def train(docs: DataFrame, given: dict | None = None, sample: int = SAMPLE) -> Model:
    """The classifier; of docs it reads about `sample`, those whose hashes are below a bound that follows from their number."""
    spark = docs.sparkSession
    known = cut(templates(spark, given))
    classes = [UNKNOWN, *sorted(given or TEMPLATES)]
    vocabulary = [r[0] for r in known.select(F.explode("grams").alias("g")).distinct().orderBy("g").collect()]
    bound = int(min(1.0, sample / max(1, docs.count())) * (1 << 30))
    few = docs.where(F.pmod(F.xxhash64("doc_id", F.col("text").cast("string")), F.lit(1 << 30)) < bound)
    negative = paragraphs(few).where(F.trim("text") != "").select("text", F.array_distinct(bigrams(words_of(F.col("text")))).alias("grams"))
    negative = stash(negative)
    fixed = F.broadcast(known.select("id", F.size("grams").alias("n"), F.explode("grams").alias("gram")))  # of fixed size
    alike = negative.select("text", F.explode("grams").alias("gram")).join(fixed, "gram").groupBy("text", "id").agg(F.count("*").alias("both"), F.max("n").alias("n")).where("both >= 0.5 * n")
    near = negative.join(alike.select("text").distinct(), "text", "left_anti")  # paragraphs that hold half of a template teach nothing
    negative = cut(near.select("grams", (F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0).alias("held")))
    label = F.array_position(F.array(*map(F.lit, classes)), F.col("family")).cast("double") - 1
    lacks = lambda r: F.when(F.size("grams") > 4, F.filter("grams", lambda g, i: i % 5 != r)).otherwise(F.col("grams"))
    part = lambda a, b: F.slice("grams", F.floor(F.size("grams") * a).cast("int") + 1, F.greatest(F.lit(1), F.ceil(F.size("grams") * (b - a)).cast("int")))
    positive = known.select(label.alias("label"), F.explode(F.array(lacks(0), lacks(1), lacks(3), part(0, 0.7), part(0.3, 1))).alias("grams"))
    rows = positive.withColumn("weight", F.lit(20.0)).unionByName(negative.where(~F.col("held")).select(F.lit(0.0).alias("label"), "grams", F.lit(1.0).alias("weight")))
    vector = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features").setBinary(True)
    fit = LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-3, maxIter=60).fit(vector.transform(rows))
    n = fit.numClasses
    w = dict(zip(vocabulary, fit.coefficientMatrix.toArray().T.tolist()))
    inside = {r.g: sorted(r.ids) for r in known.select("id", F.explode("grams").alias("g")).groupBy("g").agg(F.collect_set("id").alias("ids")).collect()}
    weights = spark.createDataFrame([(g, w[g], inside[g]) for g in vocabulary], "gram string, w array<double>, ids array<int>")
    model = Model(classes[:n], fit.interceptVector.toArray().tolist(), cut(weights), LEAST, [(r.id, r.family, r.n) for r in known.select("id", "family", F.size("grams").alias("n")).orderBy("id").collect()])
    wrong = scored(negative.where("held").withColumn("id", F.xxhash64("grams")), model, ["id"]).where(F.col("family") != UNKNOWN)
    right = scored(known.select(F.col("id").cast("long").alias("id"), F.col("family").alias("own"), F.explode(F.array(lacks(2), lacks(4))).alias("grams")).withColumn("id", F.col("id") * 2 + F.pmod(F.xxhash64("grams"), F.lit(2))), model, ["id", "own"]).where(F.col("family") == F.col("own"))
    bad = wrong.agg(F.count("*"), F.max("probability")).first()
    good = right.agg(F.percentile_approx("probability", 0.05)).first()[0]
    if bad[0] > FALSE_RATE * max(1, negative.where("held").count()):  # above the wrong ones, but not above what mutilated notices reach
        model.least = max(LEAST, min(bad[1], good if good is not None else 1.0))
    return model


def scored(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """keys, hits (for each known bigram the templates that hold it), family and probability, for rows that hold any known bigram."""
    weights = F.broadcast(model.weights)  # of fixed size
    hits = rows.select(*keys, F.explode(F.array_distinct("grams")).alias("gram")).join(weights.select("gram"), "gram", "left_semi")
    hits = hits.distinct().join(weights, "gram")  # equal rows count once
    n = len(model.classes)
    sums = hits.groupBy(*keys).agg(F.flatten(F.collect_list("ids")).alias("hits"), *[F.sum(F.col("w")[i]).alias(f"w{i}") for i in range(n)])
    names = [f"w{i}" for i in range(n)]
    p = model.probabilities(sums, names)  # columns, as a lambda would compute them anew for each element
    p = p.withColumn("best", F.array_max(F.array(*[F.struct(F.col(c).alias("p"), F.lit(-i).alias("i")) for i, c in enumerate(names)])))
    # cut, as a later filter would be pushed down through all of this and compute it for each class anew
    return cut(p.select(*keys, "hits", F.element_at(F.array(*map(F.lit, model.classes)), 1 - F.col("best.i")).alias("family"), F.col("best.p").alias("probability")))


def scan(docs: DataFrame, model: Model, given: dict | None = None, at_least: float = SIMILARITY) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity): the paragraphs that are licence notices.

    family is a family that the classifier predicts with the calibrated probability and whose templates confirm it, or "unknown" where a
    template matches but the classifier doesn't agree. similarity is the largest share of a template's bigrams that the paragraph holds. A
    notice that is wrapped over lines goes under the number of the first line of a stretch that holds it, once for each family and row; where a single
    line of the stretch holds it, the line alone is given. Null and empty texts have no paragraphs. Rows of docs with equal doc_id and text count once.
    """
    words = anchors(given, at_least)
    rows = paragraphs(docs.where(any_of(F.col("text").cast("string"), words))).where(any_of(F.col("text"), words))
    keys = ["doc_id", "row", "paragraph", "many"]
    found = scored(rows.select(*keys, bigrams(words_of(F.col("text"))).alias("grams")), model, keys)
    known = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(f).alias("f"), F.lit(n).alias("n")) for i, f, n in model.known])
    match = F.array_max(F.transform(known, lambda t: F.struct((F.size(F.filter("hits", lambda h: h == t["id"])) / t["n"]).alias("s"), (t["f"] == F.col("family")).alias("own"), t["f"].alias("f"))))
    found = found.withColumn("m", match).where(F.col("m.s") >= at_least)
    sure = (F.col("probability") >= model.least) & F.col("m.own")
    found = found.select(*keys, F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"), F.round("probability", 6).alias("probability"), F.round("m.s", 6).alias("similarity"), F.col("m.f").alias("template"))
    found = cut(found)
    lines = found.where(~F.col("many"))
    half = F.floor(F.col("paragraph") / (SPAN // 2)).cast("int")  # the stretches that hold a line begin there or one earlier
    span = F.explode(F.transform(F.sequence(F.greatest(F.lit(0), half - 1), half), lambda x: x * (SPAN // 2)))
    held = lines.select("doc_id", "row", span.alias("paragraph"), "template").distinct()
    same = [held["doc_id"].eqNullSafe(found["doc_id"]), held["row"] == found["row"], held["paragraph"] == found["paragraph"], held["template"] == found["template"]]
    wrapped = found.where("many").join(held, same, "left_anti").groupBy("doc_id", "row", "template").agg(F.min(F.struct("paragraph", "family", "probability", "similarity")).alias("x"))
    out = lines.select("doc_id", "paragraph", "family", "probability", "similarity").unionByName(wrapped.select("doc_id", "x.*"))
    return out.withColumn("paragraph", F.col("paragraph").cast("long"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, train(docs))
