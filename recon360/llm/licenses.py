"""Licence notices in documents by a trained paragraph classifier.

A multinomial logistic regression with an L1 penalty over hashed word 1-grams and 2-grams tells the
licence families from ``unknown``. It is trained here on passages of licence texts and on paragraphs of
the corpus. The probability a family must reach is calibrated on other paragraphs of the corpus, and a
prediction is confirmed by comparing the paragraph with the texts of the family. DataFrame operations
only; the regression is Spark's own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recon360.llm.common import let, pick, text_hash
from recon360.sources.store import TableStore, constant_rows

UNKNOWN = "unknown"
BUCKETS = 1 << 14
# Words of the training passages, each half a passage after the one before it.
PASSAGE_WORDS = (12, 24)
# Weight of the unknown class, where every family weighs one.
UNKNOWN_WEIGHT = 3.0
# Share of corpus paragraphs without a licence that may pass the calibrated probability.
FALSE_ALARMS = 0.001
# Share of 2-grams a paragraph and a text of its family must have in common, of the shorter of both.
CONFIRMED = 0.6

# Passages of the licences and the notices that refer to them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Licensed under the 3-clause BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v2 or later.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "CC": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Released into the public domain under CC0 1.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of "
        "this license, visit http://creativecommons.org/licenses/by-nc/4.0/ or send a letter to Creative Commons.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any "
        "means without the prior written permission of the publisher.",
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly "
        "prohibited.",
    ),
}

# Sentences with words of the notices that are none.
OTHER_SENTENCES = (
    "She renewed her driving licence at the office on Monday.",
    "The museum is open to the general public, free of charge, on the first Sunday of the month.",
    "The source of the river was found in the mountains.",
    "The company sells software to hospitals and schools.",
    "The Apache helicopter flew over the valley.",
    "He studied at MIT before he moved to Berkeley.",
    "The author holds the copyright and lives in Vienna.",
    "Permission to enter the building is given at the gate.",
    "The first version of the program was written in 1994.",
    "A fishing license is required under state law.",
    "The foundation provides software and training without charge.",
    "The warranty covers parts and labour for two years.",
    "Common creative methods include sketching and writing.",
    "The terms of the contract were published last week.",
    "The distribution of income has changed since then.",
)


def paragraphs(text: Column) -> Column:
    """Lines of a text that hold a word, in any script; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[\p{L}\p{N}]"))


def words(paragraph: Column) -> Column:
    return F.array_remove(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), "")


def bigrams(of: Column) -> Column:
    """Pairs of neighbouring words in an array of words."""
    def pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        return F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))

    return let(of, pairs)


def with_terms(df: DataFrame, paragraph: str) -> DataFrame:
    """``df`` plus its word pairs and the hashed vector of words and pairs."""
    both = let(words(F.col(paragraph)), lambda w: F.struct(w.alias("words"), bigrams(w).alias("pairs")))
    out = df.withColumn("_both", both)
    out = out.withColumns({"pairs": F.col("_both.pairs"), "terms": F.concat("_both.words", "_both.pairs")}).drop("_both")
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="terms", outputCol="vector").transform(out).drop("terms")


def templates(spark: SparkSession) -> DataFrame:
    """(family, pairs) of the licence texts."""
    rows = constant_rows(spark, [{"family": f, "passage": t} for f, texts in TEMPLATES.items() for t in texts])
    return rows.select("family", F.array_distinct(bigrams(words(F.col("passage")))).alias("pairs"))


def _passages(spark: SparkSession) -> DataFrame:
    """(family, paragraph): the texts and windows of their words, and sentences of none."""
    rows = constant_rows(spark, [{"family": f, "paragraph": t} for f, texts in TEMPLATES.items() for t in texts])
    split = rows.withColumn("w", F.split("paragraph", r"\s+"))
    cut = []
    for n in PASSAGE_WORDS:
        starts = F.sequence(F.lit(0), F.greatest(F.size("w") - F.lit(n), F.lit(0)), F.lit(n // 2))
        cut.append(F.transform(starts, lambda i, n=n: F.concat_ws(" ", F.slice("w", i + 1, n))))
    windows = split.select("family", F.explode(F.concat(*cut)).alias("paragraph"))
    none = constant_rows(spark, [{"family": UNKNOWN, "paragraph": t} for t in OTHER_SENTENCES])
    return rows.unionByName(windows).unionByName(none).distinct()


@dataclass
class Scanner:
    families: list[str]  # position in the probabilities; the first is unknown
    model: LogisticRegressionModel
    least: float  # probability a family must reach

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` (with vector) plus family and probability; ``unknown`` unless a family reaches the least."""
        scored = self.model.transform(df).withColumn("_p", vector_to_array("probability"))
        best = F.array_max(F.slice("_p", 2, len(self.families) - 1))
        named = F.get(F.array(*map(F.lit, self.families)), F.array_position("_p", F.col("_best")).cast("int") - 1)
        return (
            scored.withColumn("_best", best)
            .withColumn("family", F.when(F.col("_best") >= self.least, named).otherwise(F.lit(UNKNOWN)))
            .withColumnRenamed("_best", "likelihood")
            # a filter on the family stays above this, so that the model runs once per row
            .withColumn("_row", F.monotonically_increasing_id())
            .drop("_p", "probability", "rawPrediction", "prediction")
        )


def agreement(pairs: Column, template: Column, common: Column | None = None) -> Column:
    """Share of common 2-grams, of the shorter of both sides. ``common``: those pairs alone that may be the template's."""
    shorter = F.least(F.size(pairs), F.size(template))
    both = F.array_intersect(template, pairs if common is None else common)
    return F.coalesce(F.try_divide(F.size(both), shorter), F.lit(0.0))


def corpus_paragraphs(docs: DataFrame, most: int | None = None) -> DataFrame:
    """(paragraph): every different one once, or about ``most`` of them, chosen by a hash."""
    lines = docs.select(F.explode(paragraphs(F.col("text"))).alias("paragraph"))
    if most is None:
        return lines.distinct()
    n = lines.select(F.xxhash64("paragraph").alias("h")).distinct().count()
    spread = F.pmod(F.xxhash64("paragraph"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return lines.where(spread < min(1.0, most / max(1, n))).distinct()


def _quantile(likelihoods: DataFrame, share: float) -> float | None:
    """The quantile of ``likelihood`` to six digits, between 0.5 and 0.99, over counts of so many values at most."""
    value = F.round(F.least(F.greatest("likelihood", F.lit(0.5)), F.lit(0.99)), 6)
    counts = likelihoods.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.expr(f"percentile(value, {share}, n)").alias("q")).first()["q"]


def paragraph_vectors(docs: DataFrame, store: TableStore) -> DataFrame:
    """(key, vector, fit) of every different paragraph, written once for ``train`` and ``scan``.

    ``fit`` is true for the half that trains, false for the half that calibrates, and null for paragraphs
    that agree with a licence text, which do neither. ``key`` is a hash; paragraphs may share one.
    """
    spark = docs.sparkSession
    seen = with_terms(corpus_paragraphs(pick(docs, "doc_id", "text")), "paragraph")
    texts = [t["pairs"] for t in templates(spark).collect()]  # the fixed texts
    # few pairs are of any text; what is no more than those cannot agree with most of the texts
    theirs = sorted({pair for t in texts for pair in t})
    seen = seen.withColumn("common", F.array_distinct(F.filter("pairs", lambda pair: pair.isin(theirs))))

    def alike(t: Column) -> Column:
        least = F.least(F.size("pairs"), F.size(t)) * F.lit(CONFIRMED / 2)
        return (F.size("common") >= least) & (agreement(F.col("pairs"), t, F.col("common")) >= CONFIRMED / 2)

    known = F.array(*[F.array(*map(F.lit, t)) for t in texts])
    plain = F.when(F.size("common") > 0, ~F.exists(known, alike)).otherwise(F.lit(True))
    half = F.pmod(F.xxhash64("paragraph", F.lit("half")), F.lit(2)) == 0
    return store("plain", seen.select(F.xxhash64("paragraph").alias("key"), "vector", F.when(plain, half).alias("fit")))


def train(docs: DataFrame, store: TableStore, seen: DataFrame | None = None) -> Scanner:
    """Fit on the licence passages and half of the corpus's different paragraphs, calibrate on the other half.

    Paragraphs that agree with a licence text are left out of both. An empty corpus leaves the passages
    alone. ``seen`` are the corpus's ``paragraph_vectors``, if they are there already.
    """
    spark = docs.sparkSession
    seen = paragraph_vectors(docs, store) if seen is None else seen
    plain = seen.select(F.lit(UNKNOWN).alias("family"), "vector", "fit")
    families = [UNKNOWN, *TEMPLATES]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    passages = store("passages", with_terms(_passages(spark), "paragraph").select("family", "vector"))
    examples = passages.unionByName(plain.where("fit").select("family", "vector")).withColumn("label", label)
    sizes = store("sizes", examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")))
    weight = F.when(F.col("label") == 0, F.lit(UNKNOWN_WEIGHT)).otherwise(F.lit(1.0)) / F.col("n") * 1000
    weighted = examples.join(F.broadcast(sizes), "label").withColumn("weight", weight)
    regression = LogisticRegression(
        featuresCol="vector", labelCol="label", weightCol="weight", family="multinomial", maxIter=30, regParam=0.0005,
        elasticNetParam=0.5,
    )
    scanner = Scanner(families, regression.fit(weighted.select("vector", "label", "weight")), 0.5)
    quantile = _quantile(scanner.predict(plain.where("not fit").drop("family")), 1 - FALSE_ALARMS)
    scanner.least = max(0.5, min(0.99, quantile or 0.0))
    return scanner


def scan(docs: DataFrame, scanner: Scanner, store: TableStore, seen: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_licensed, families, n_unconfirmed, likelihood.

    n_licensed counts paragraphs that a family's text confirms, ``families`` names those families in
    order, n_unconfirmed counts predictions that no text confirms, ``likelihood`` is the highest
    probability of a confirmed paragraph (null without one). A null or empty text has no paragraphs;
    null ids and repeated rows give a row each; other columns are ignored. ``seen`` are the documents'
    ``paragraph_vectors``, if they are there already: then only lines with the key of a paragraph in which
    a family is predicted are looked at again.
    """
    rows = pick(docs, "doc_id", "text").withColumn("_hash", text_hash(F.col("text")))
    lines = rows.select("doc_id", "_hash", F.posexplode(paragraphs(F.col("text"))).alias("place", "paragraph"))
    if seen is not None:
        likely = store("likely", scanner.predict(seen).where(F.col("family") != UNKNOWN).select("key").distinct())
        # written, as the filter on the family would move below the join and the model run on every line
        lines = store("lines", lines.withColumn("key", F.xxhash64("paragraph")).join(likely, "key", "left_semi").drop("key"))
    found = scanner.predict(with_terms(lines, "paragraph")).where(F.col("family") != UNKNOWN)
    hits = store("hits", found.select("doc_id", "_hash", "place", "family", "likelihood", F.array_distinct("pairs").alias("pairs")))
    texts = templates(docs.sparkSession).withColumnRenamed("pairs", "template")
    compared = hits.distinct().join(F.broadcast(texts), "family").groupBy("doc_id", "_hash", "place", "family", "likelihood")
    judged = compared.agg((F.max(agreement(F.col("pairs"), F.col("template"))) >= CONFIRMED).alias("sure"))
    each = store(
        "licensed",
        judged.groupBy(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h")).agg(
            F.count_if("sure").alias("n_licensed"),
            F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("sure"), F.col("family"))))).alias("families"),
            F.count_if(~F.col("sure")).alias("n_unconfirmed"),
            F.max(F.when(F.col("sure"), F.col("likelihood"))).alias("likelihood"),
        ),
    )
    counted = rows.select("doc_id", "_hash", F.size(paragraphs(F.col("text"))).cast("long").alias("n_paragraphs"))
    same = counted["doc_id"].eqNullSafe(each["_id"]) & (counted["_hash"] == each["_h"])
    return counted.join(each, same, "left").select(
        "doc_id",
        "n_paragraphs",
        F.coalesce("n_licensed", F.lit(0).cast("long")).alias("n_licensed"),
        F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce("n_unconfirmed", F.lit(0).cast("long")).alias("n_unconfirmed"),
        "likelihood",
    )
