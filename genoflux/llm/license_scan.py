"""Licence scan: a trained paragraph classifier confirmed by template comparison.

Training (small, on the driver): the templates below, and variants of them with
words left out, against ordinary and near-miss paragraphs, give a sparse
logistic regression over word 1- and 2-grams, one weight per n-gram and family
with ``unknown`` as a class of its own. Its temperature and the least
probability of a family are set on variants that were kept out of the fit, so
that near-misses stay unknown.

Scanning uses DataFrame functions only. A paragraph is a block of lines between
blank lines that holds evidence: a licence's name, or a word such as "warranty"
(``ANCHOR``, at any width of white space or marks). A block without is unknown by
definition. Its units are scored: every anchored line
alone, with the lines beside it, all lines from the first to the last anchored
one, and the whole block, so that a wrapped notice is read in full and a notice
in a block of other text is not lost in it. The n-grams of a unit meet the weight
table (its size is fixed by the templates, so it is broadcast), scores are summed
per unit and class, and a softmax gives the family. A prediction is confirmed if
the unit holds enough of one template's 3-grams or consists of them; else it is
reported as unconfirmed. Units of several lines count if they are confirmed, or
if their block has no other finding. A paragraph gives one finding per family,
at its first line.

Defined cases: null texts have no paragraphs; every row of the input gives one
row of the result, repeated rows too; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, table, text_of

#: Short notices as they stand in files and headers, by family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
        "Licensed under Apache 2.0.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Licensed under MIT.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "Licensed under GPL v3.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under LGPL v2.1.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "Licensed under AGPL v3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution.",
        "Licensed under the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
        "Released under CC0 1.0.",
    ],
}
NEAR_MISSES = [
    "The court held that copyright in the letters had passed to her estate.",
    "He lost his driver license and his permission to park on the public road.",
    "No warranty claim was filed, and the version of events was disputed.",
    "All rights reserved by the publisher; contact us for a license to use the photographs.",
    "Copyright 2019 the authors. All rights reserved.",
    "The general public may visit the foundation; copies of the terms are free of charge.",
    "The software was licensed to the bank under a private agreement.",
    "A liquor license is required under the law of the state.",
    "You must obtain permission from the school before you use this file.",
    "The redistribution of wealth and the use of force were the terms of the debate.",
    "Licensed under",
    "Licensed under the terms of the agreement.",
    "Released under the terms below.",
    "The tools are free software of many kinds.",
    "The goods are sold as is, and the seller gives no warranty.",
    "The Apache riders crossed the river, and the gnu grazed on the plain.",
    "The painting is in the public domain of memory, said the owner of the copyright.",
    "Licensed under the zlib License.",
    "This code is licensed under the Python Software Foundation License, version 2.",
    "Released under the Microsoft Public License.",
    "Fonts are licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Academic Free License version 3.0.",
    "You may use this library under the terms of the Common Development and Distribution License 1.0.",
]
ORDINARY = ["the weather was fine and we walked along the river", "a short note about cooking rice and beans", "she opened the door and looked at the garden", "mit der und von für das ist nicht auf sich", "mit einer erlaubnis und der version von morgen", ""]
#: Words and names, one of which a paragraph of a family holds.
NOT_AFTER, NOT_BEFORE = "(?<![a-z0-9])", "(?![a-z0-9])"
STEMS = ["licen", "copyright", "redistribut", "warrant", "merchantab", "noninfring", "permission", "spdx", "mozilla", "apache", "affero", "unencumbered", "gpl"]
PHRASES = {"public domain": "domain", "creative commons": "commons", "free software": "software", "eclipse public": "eclipse", "\"as is\"": "\"as"}
NAMES_ALONE = NOT_AFTER + "(?:" + "|".join([*[f"{name}{NOT_BEFORE}" for name in ("gnu", "mpl", "isc", "under mit", "cc by")], "bsd", "epl-", "cc0"]) + ")"


def anywhere(pattern: str) -> str:
    """For texts in any case, with words apart by anything but letters and digits, line breaks too."""
    return "(?i)" + pattern.replace(" ", "[^a-z0-9]+")


ANCHOR = anywhere("|".join([*STEMS, *PHRASES, NAMES_ALONE]))
BLANK = r"\n[^\S\n]*(?=\n)"
WORD = r"[a-z0-9.+-]*[a-z0-9]"
UNKNOWN = "unknown"
CLASSES = [UNKNOWN, *TEMPLATES]
CONTAINED = 0.6
#: A unit of fewer 3-grams does not confirm a template by consisting of its words.
LEAST_OWN = 3
#: Characters of texts with evidence in a task, on average.
TASK_CHARS = 1 << 20
#: A notice with at most so many words that name its family keeps them in its variants.
NAMES = 3


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def grams(words: list[str], sizes=(1, 2)) -> set[str]:
    return {" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)}


@functools.cache
def train(seed: int = 5) -> dict:
    """Weights (n-gram -> one per class), bias, temperature and least probability."""
    rng = np.random.default_rng(seed)
    samples: list[tuple[list[str], int]] = []
    # A word of one family only names it: without such a word a notice could be another family's.
    owners: dict[str, set[int]] = {}
    for label, texts in [(0, NEAR_MISSES + ORDINARY), *enumerate(TEMPLATES.values(), start=1)]:
        for word in {w for text in texts for w in words_of(text)}:
            owners.setdefault(word, set()).add(label)
    for label, texts in [(0, NEAR_MISSES + ORDINARY), *enumerate(TEMPLATES.values(), start=1)]:
        for text in texts:
            words = words_of(text)
            own = {w for w in words if label and owners[w] == {label}}
            stays = own if len(own) <= NAMES else set()
            samples.append((words, label))
            for share in (0.05, 0.1, 0.15, 0.2) * 3:
                samples.append(([w for w in words if rng.random() > share or w in stays], label))
    vocabulary = {g: i for i, g in enumerate(sorted(set().union(*(grams(w) for w, _ in samples))))}
    x = np.zeros((len(samples), len(vocabulary)), dtype=np.float32)
    for k, (words, _) in enumerate(samples):
        for g in grams(words):
            x[k, vocabulary[g]] = 1.0
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    y = np.eye(len(CLASSES))[[label for _, label in samples]]
    kept_out = np.arange(len(samples)) % 4 == 3
    w, b = np.zeros((len(vocabulary), len(CLASSES))), np.zeros(len(CLASSES))

    def softmax(z):
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    fit_x, fit_y, x = x[~kept_out], y[~kept_out], x[kept_out]
    for _ in range(600):
        d = softmax(fit_x @ w + b) - fit_y
        w -= 8.0 * (fit_x.T @ d / len(d) + 2e-5 * w)
        b -= 8.0 * d.mean(axis=0)
    z, truth = x @ w + b, y[kept_out].argmax(axis=1)
    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0), key=lambda t: -np.log(softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean())
    p = softmax(z / temperature)
    wrong = p[:, 1:].max(axis=1)[(truth == 0) | (p[:, 1:].argmax(axis=1) + 1 != truth)]
    least = float(np.clip(wrong.max(initial=0.0) + 0.02, 0.5, 0.95))
    return {"weights": {g: w[i] for g, i in vocabulary.items()}, "bias": b, "temperature": temperature, "least": least}


def gram_column(words: Column, sizes: tuple[int, ...]) -> Column:
    """Distinct n-grams of an array of words."""
    out = []
    for n in sizes:
        parts = words
        for k in range(1, n):
            parts = F.zip_with(parts, F.slice(words, F.lit(k + 1), F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
        out.append(F.slice(parts, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0))))
    return F.array_distinct(F.concat(*out))


def evident(text: Column) -> Column:
    """Whether ``ANCHOR`` finds something; most texts are settled by plain searches, at a third of the time."""
    plain = [*STEMS, *PHRASES.values()]
    maybe = F.exists(F.array(F.lower(text)), lambda x: functools.reduce(Column.__or__, [F.contains(x, F.lit(w)) for w in plain]))
    return (maybe | text.rlike(anywhere(NAMES_ALONE))) & text.rlike(ANCHOR)


def paragraphs(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Units of the anchored blocks of ``docs`` (one row per ``key``): key, block, unit,
    wide (0 a line, 1 lines around an anchor, 2 the block), line (from 0), words."""
    # A piece ends where a blank line follows; each separator holds one line break.
    pieces = docs.where(evident(text_of(text_col))).select(key, F.posexplode(F.split(text_of(text_col), BLANK, -1)).alias("block", "__piece"))
    breaks = F.length("__piece") - F.length(F.translate("__piece", "\n", "")) + 1
    first = F.coalesce(F.sum(breaks).over(Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = pieces.withColumn("__first", first).where(F.col("__piece").rlike(ANCHOR)).withColumn("__lines", F.split("__piece", "\n", -1))
    n = F.size("__lines")
    found = F.filter(F.transform("__lines", lambda x, i: F.when(x.rlike(ANCHOR), i)), lambda i: i.isNotNull())
    blocks = blocks.withColumn("__at", F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(0))))

    def unit(wide: int, at: Column, lo: Column, hi: Column) -> Column:
        lo, hi = F.greatest(lo, F.lit(0)), F.least(hi, n - 1)
        return F.struct(F.lit(wide).alias("wide"), at.alias("at"), lo.alias("lo"), hi.alias("hi"))

    alone = F.transform("__at", lambda i: unit(0, i, i, i))
    around = F.flatten(F.transform("__at", lambda i: F.array(*[unit(1, i, i + a, i + b) for a, b in ((-1, 0), (0, 1), (-1, 1))])))
    head = F.get("__at", F.lit(0))
    whole = F.array(unit(1, head, head, F.array_max("__at")), unit(2, head, F.lit(0), n - 1))
    units = F.array_distinct(F.concat(alone, F.filter(F.concat(around, whole), lambda u: u["lo"] < u["hi"])))
    each = blocks.select(key, "block", "__first", "__lines", F.posexplode(units).alias("unit", "__u"))
    text = F.concat_ws(" ", F.slice("__lines", F.col("__u.lo") + 1, F.col("__u.hi") - F.col("__u.lo") + 1))
    return each.select(
        key, "block", "unit", F.col("__u.wide").alias("wide"), (F.col("__first") + F.col("__u.at")).cast("int").alias("line"),
        F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)).alias("words"),
    )


def classified(paras: DataFrame, key: list[str], model: dict) -> DataFrame:
    """key, line, family, probability, confirmed: one row per paragraph that is not unknown."""
    spark = paras.sparkSession
    table_rows = [(g, *[float(v) for v in w]) for g, w in model["weights"].items()]
    names = [f"w{i}" for i in range(len(CLASSES))]
    weights = spark.createDataFrame(table_rows, "gram string, " + ", ".join(f"{n} double" for n in names))
    each = paras.select(*key, "line", F.explode(gram_column(F.col("words"), (1, 2))).alias("gram"))
    summed = each.join(F.broadcast(weights), "gram", "left").groupBy(*key, "line").agg(F.count("*").alias("n"), *[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names])
    logits = [(F.col(n) / F.sqrt("n") + F.lit(float(b))) / F.lit(float(model["temperature"])) for n, b in zip(names, model["bias"], strict=True)]
    # Step by step: written into each other, the odds of every class would repeat the logits of all in each.
    odds = summed.select(*key, "line", F.array(*logits).alias("__z")).withColumn("__top", F.array_max("__z"))
    odds = odds.withColumn("__odds", F.transform("__z", lambda z: F.exp(z - F.col("__top")))).withColumn("__total", F.aggregate("__odds", F.lit(0.0), lambda a, o: a + o))
    names_of = F.array(*[F.lit(c) for c in CLASSES])
    each_class = F.transform("__odds", lambda o, i: F.struct((-o / F.col("__total")).alias("p"), F.get(names_of, i).alias("c")))
    guess = odds.withColumn("__best", F.array_min(each_class)).select(*key, "line", F.col("__best.c").alias("family"), (-F.col("__best.p")).alias("probability"))
    guess = guess.where((F.col("family") != UNKNOWN) & (F.col("probability") >= model["least"]))

    shapes = [(f, i, g, len(gs)) for f, texts in TEMPLATES.items() for i, t in enumerate(texts) for gs in [grams(words_of(t), (min(3, len(words_of(t))),))] for g in sorted(gs)]
    templates = spark.createDataFrame(shapes, "family string, template int, gram string, size int")
    own = paras.withColumn("__n", F.least(F.size("words"), F.lit(3)))
    small = own.select(*key, "line", F.explode(F.when(F.col("__n") == 3, gram_column(F.col("words"), (3,))).when(F.col("__n") == 2, gram_column(F.col("words"), (2,))).otherwise(F.array_distinct("words"))).alias("gram"), F.greatest(F.size("words") - 2, F.lit(1)).alias("__own"))
    shared = small.join(F.broadcast(templates), "gram").groupBy(*key, "line", "family", "template").agg(F.count("*").alias("c"), F.first("size").alias("size"), F.first("__own").alias("own"))
    close = shared.where((F.col("c") >= CONTAINED * F.col("size")) | ((F.col("own") >= LEAST_OWN) & (F.col("c") >= CONTAINED * F.col("own")))).select(*key, "line", "family").distinct().withColumn("confirmed", F.lit(True))
    return guess.join(close, [*key, "line", "family"], "left").withColumn("confirmed", F.coalesce("confirmed", F.lit(False)))


def settled(units: DataFrame) -> DataFrame:
    """__text_key, line, family, confirmed: one row per block and family."""
    block, spot = Window.partitionBy("__text_key", "block"), Window.partitionBy("__text_key", "block", "line")
    sure = (F.col("wide") == 0) | F.col("confirmed")
    # A line that is confirmed with its neighbours is not also another, unconfirmed family.
    near = F.max("confirmed").over(spot)
    known = units.withColumn("__any", F.max(sure).over(block)).withColumn("__near", near)
    kept = known.where(F.col("confirmed") | ((F.col("wide") == 0) & ~F.col("__near")) | ((F.col("wide") == 2) & ~F.col("__any")))
    return kept.groupBy("__text_key", "block", "family").agg(F.min("line").alias("line"), F.max("confirmed").alias("confirmed"))


def scan(docs: DataFrame, text_col: str = "text", model: dict | None = None) -> DataFrame:
    """doc_id, families, n_paragraphs (findings, one per paragraph and family), n_confirmed,
    findings (line:family:confirmed, by line).

    Rows that share id and text are found alike; findings join back by both.
    """
    model = model or train()
    given = docs.select("doc_id", text_of(text_col).alias("text")).withColumn("__text_key", F.sha2("text", 256))
    one = materialize(given.where(evident(F.col("text"))).dropDuplicates(["__text_key"]).select("__text_key", "text"), "licence-texts")
    # A character costs far more than its byte here, so tasks follow the characters.
    tasks = one.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // TASK_CHARS + 1
    one = one.repartition(max(tasks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "__text_key")
    units = classified(paragraphs(one, "__text_key"), ["__text_key", "block", "unit", "wide"], model)
    found = settled(units)
    listed = found.groupBy("__text_key").agg(
        F.array_sort(F.collect_list(F.struct("line", "family", "confirmed"))).alias("f"), F.count("*").alias("n"), F.count_if("confirmed").alias("c"), F.array_sort(F.collect_set("family")).alias("families")
    )
    # Written, so that rows of one text that is very frequent join to a plain table.
    listed = materialize(listed, "licences")
    text = F.transform("f", lambda s: F.concat_ws(":", s["line"].cast("string"), s["family"], F.when(s["confirmed"], "confirmed").otherwise("unconfirmed")))
    return given.drop("text").join(listed, "__text_key", "left").select(
        "doc_id",
        F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"),
        F.coalesce("n", F.lit(0)).alias("n_paragraphs"),
        F.coalesce("c", F.lit(0)).alias("n_confirmed"),
        F.coalesce(F.array_join(text, ","), F.lit("")).alias("findings"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op8_license_scan": op8_license_scan}
ORACLE_SQL: dict[str, str] = {}
