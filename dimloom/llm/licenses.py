"""Licence scans: a trained paragraph classifier, confirmed by templates. DataFrame functions only.

A paragraph is a line that holds a word. Its lower-cased word 1- and 2-grams
are hashed into ``FEATURES`` counts; a multinomial logistic regression with a
sparse penalty names a licence family or none. It is fitted on notices made
from ``NOTICES`` and ``NAMES`` and on a bounded sample of the corpus's own
paragraphs as the unknown class (``UNKNOWN_ROWS``, chosen by hash, without
those that name a licence). The chance of a known family at which a
paragraph counts as one is calibrated on all paragraphs of the corpus that
name no licence, by one aggregate: at most ``FALSE_SHARE`` of them may pass,
and it is ``LEAST`` at least. A
prediction is confirmed if the paragraph shares enough words with a template
of its family.

Defined results: null, empty and wordless texts have no paragraphs; rows
that repeat an id each get what all rows of the id hold; an empty table
gives an empty result (the classifier then knows no unknown paragraphs).
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimloom.llm.lines import computed
from dimloom.operators.ids import materialize

FEATURES = 1 << 13
UNKNOWN_ROWS = 3_000
FALSE_SHARE = 0.002
LEAST = 0.5
#: Shares of common words (of the paragraph, of the template) that confirm a family.
OF_PARAGRAPH, OF_TEMPLATE = 0.6, 0.9
WORD = r"[\p{L}\p{N}]+"
UNKNOWN = "unknown"
#: Paragraphs with these words are not taken as samples of the unknown class.
NAMING = r"(?i)licen[sc]|copyright|copyleft|\brights\b|warrant|public domain"

#: Short names by family (fixed values).
NAMES = {
    "apache": ["the Apache License, Version 2.0", "Apache License 2.0", "the Apache 2.0 license"],
    "mit": ["the MIT License", "the MIT licence", "the terms of the MIT License"],
    "gpl": ["the GNU General Public License, version 3", "the GNU General Public License, version 2 or later", "the GNU GPL v3", "the GPLv2"],
    "lgpl": ["the GNU Lesser General Public License, version 2.1", "the GNU LGPL v3"],
    "bsd": ["the BSD 3-Clause License", "the BSD 2-Clause License", "a BSD-style license"],
    "mpl": ["the Mozilla Public License, version 2.0", "the MPL 2.0"],
    "cc-by": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0": ["CC0 1.0", "the Creative Commons CC0 1.0 Universal public domain dedication"],
}
#: How a name becomes a notice.
LEADS = ["Licensed under", "This work is licensed under", "Released under", "Distributed under", "This program is released under", "This project is available under", "The code is covered by"]
#: Whole notices by family (fixed values).
NOTICES = {
    "apache": ["Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one."],
    "proprietary": ["All rights reserved.", "Copyright 2024 The Authors. All rights reserved.", "© 2023 All rights reserved. No part of this publication may be reproduced without written permission.",
                    "All rights reserved. Unauthorized copying of this file is strictly prohibited.", "Confidential and proprietary. All rights reserved."],
}
#: Paragraphs that name a licence or a right and grant nothing (fixed values).
DECOYS = ["The driver lost his license last year.", "A fishing licence is needed on the lake.", "The license plate was found by the road.", "Copyright law differs from country to country.",
          "They marched for equal rights and fair pay.", "The apache people lived in the south.", "She studied at MIT for three years.", "The warranty ends after two years.",
          "Rights of way are reserved for walkers.", "He reserved all the rooms on the right.", "The public license office opens at nine.", "This work is hard and the version is old."]


def families() -> list[str]:
    return sorted({*NAMES, *NOTICES})


def words_of(text: Column) -> Column:
    """Lower-cased words."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def with_grams(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``words`` and ``grams`` (the words and the pairs of neighbours)."""
    df = computed(df, "words", F.coalesce(words_of(F.col(text)), F.array().cast("array<string>")))
    pairs = F.transform("words", lambda w, i: F.when(i > 0, F.concat_ws(" ", F.col("words")[i - 1], w)))
    return computed(df, "grams", F.concat("words", F.filter(pairs, lambda p: p.isNotNull())))


def constants(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """(family, notice) rows, made by Spark."""
    return spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(a).alias("family"), F.lit(b).alias("notice")) for a, b in rows])).alias("x")).select("x.*")


def notices(spark: SparkSession) -> DataFrame:
    named = [(family, f"{lead} {name}.") for family, names in NAMES.items() for name in names for lead in LEADS]
    whole = [(family, n) for family, some in NOTICES.items() for n in some for _ in range(4)]
    return constants(spark, named + whole + [(UNKNOWN, d) for d in DECOYS])


def paragraphs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, paragraph, notice): the lines that hold a word."""
    return (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.posexplode(F.split(f"`{text}`", "\n", -1)).alias("paragraph", "notice"))
            .where(F.col("notice").rlike(WORD)))


class Classifier:
    """A fitted model, the order of its families and the calibrated chance of a known one."""

    def __init__(self, model: LogisticRegressionModel, classes: list[str], least: float):
        self.model, self.classes, self.least = model, classes, least

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``grams``) with ``chances`` by class."""
        counted = hashing().transform(df)
        return self.model.transform(counted).withColumn("chances", vector_to_array("probability")).drop("features", "rawPrediction", "probability", "prediction")


def hashing() -> HashingTF:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)


def known_chance(chances: str) -> Column:
    return 1 - F.col(chances)[0]


def sampled(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(notice, order): at most ``UNKNOWN_ROWS`` distinct paragraphs that name no licence, those of the smallest hashes.

    Hashes are spread evenly, so the number of distinct ones says below which
    about that many lie: no more than those few paragraphs are ever moved.
    """
    unnamed = paragraphs(docs, doc_id, text).where(~F.col("notice").rlike(NAMING)).select("notice", F.xxhash64("notice", F.lit(11)).alias("order"))
    n = unnamed.agg(F.approx_count_distinct("order", 0.02)).first()[0]
    share = min(1.0, 1.25 * UNKNOWN_ROWS / max(n, 1))
    top = int(share * (1 << 64)) - (1 << 63) - 1
    return unnamed.where(F.col("order") <= F.lit(min(top, (1 << 63) - 1))).distinct().orderBy("order", "notice").limit(UNKNOWN_ROWS)


def fit(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """Fitted on the made notices and the sample of unknown paragraphs, and not yet calibrated."""
    sample = materialize(sampled(docs, doc_id, text), "licence-sample")
    classes = [UNKNOWN, *families()]
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")) - 1
    half = F.pmod(F.shiftright("order", 8), F.lit(2))
    rows = notices(spark).union(sample.where(half == 0).select(F.lit(UNKNOWN).alias("family"), "notice"))
    rows = with_grams(rows, "notice").withColumn("label", label.cast("double"))
    model = LogisticRegression(family="multinomial", maxIter=30, regParam=2e-3, elasticNetParam=0.3).fit(hashing().transform(rows).select("label", "features"))
    return Classifier(model, classes, LEAST)


def scored(docs: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, float | None]:
    """The paragraphs whose chance is ``LEAST`` or more (written), and the chance that ``FALSE_SHARE`` of those without a licence's words pass.

    One pass scores every paragraph, once, and counts on its way those without
    such words. All that could pass are among the written ones, so the chance at
    which too many do is a quantile of these; None if even ``LEAST`` lets few pass.
    """
    seen = Observation()
    chance, unnamed = known_chance("chances"), ~F.col("notice").rlike(NAMING)
    rows = classifier.score(with_grams(paragraphs(docs, doc_id, text), "notice")).select("doc_id", "paragraph", "notice", "words", "chances")
    rows = materialize(rows.observe(seen, F.count_if(unnamed).alias("n")).where(chance >= LEAST), "licence-scored")
    may, passing = FALSE_SHARE * seen.get["n"], rows.where(unnamed)
    count = passing.count()
    if count <= may:
        return rows, None
    return rows, passing.agg(F.percentile_approx(chance, 1 - may / count, 10_000)).first()[0]


def train(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """Fit on the made notices and at most ``UNKNOWN_ROWS`` paragraphs, and calibrate the unknown class on all of them."""
    return trained(spark, docs, doc_id, text)[0]


def trained(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[Classifier, DataFrame]:
    """``train``, and the scored paragraphs of ``docs``, which a scan of the same documents need not score again."""
    known = fit(spark, docs, doc_id, text)
    rows, cut = scored(docs, known, doc_id, text)
    known.least = max(LEAST, cut or 0.0)
    return known, rows


def license_paragraphs(docs: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text", rows: DataFrame | None = None) -> DataFrame:
    """(doc_id, paragraph, notice, family, probability, similarity, confirmed): the paragraphs that count as a licence.

    ``rows`` are the scored paragraphs of ``docs``, if there are (``trained``).
    """
    rows = scored(docs, classifier, doc_id, text)[0] if rows is None else rows
    known = F.slice("chances", 2, len(classifier.classes) - 1)
    named = (rows.where(known_chance("chances") >= classifier.least)
             .select("doc_id", "paragraph", "notice", F.array_distinct("words").alias("words"), F.element_at(F.array(*[F.lit(c) for c in classifier.classes[1:]]), F.array_position(known, F.array_max(known)).cast("int")).alias("family"),
                     known_chance("chances").alias("probability")))
    # the templates are constants, one row for each family
    texts = notices(docs.sparkSession).distinct()
    templates = with_grams(texts, "notice").groupBy("family").agg(F.collect_list(F.array_distinct("words")).alias("templates"))
    met = computed(named.join(F.broadcast(templates), "family", "left"), "shares", F.transform("templates", lambda t: F.struct(
        (F.size(F.array_intersect("words", t)) / F.size("words")).alias("here"), (F.size(F.array_intersect("words", t)) / F.size(t)).alias("there"))))
    likeness = F.array_max(F.transform("shares", lambda s: F.least(F.greatest(s["here"] / OF_PARAGRAPH, s["there"] / OF_TEMPLATE), F.lit(2.0))))
    return met.select("doc_id", "paragraph", "notice", "family", "probability", likeness.alias("similarity"), F.coalesce(likeness >= 1, F.lit(False)).alias("confirmed"))


def license_scan(docs: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text", rows: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_paragraphs, n_notices, families): one row per row; ``families`` the confirmed ones, sorted, or null."""
    found = (license_paragraphs(docs, classifier, doc_id, text, rows).where("confirmed").groupBy("doc_id")
             .agg(F.count(F.lit(1)).alias("n_notices"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"))
             .withColumnRenamed("doc_id", "_id"))
    counted = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.size(F.filter(F.split(f"`{text}`", "\n", -1), lambda p: p.rlike(WORD))), F.lit(0)).cast("long").alias("n_paragraphs"))
    counted = counted.withColumn("n_paragraphs", F.greatest("n_paragraphs", F.lit(0).cast("long")))
    return counted.join(found, counted["doc_id"].eqNullSafe(found["_id"]), "left").select("doc_id", "n_paragraphs", F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"), "families")
