"""Licence scans: a trained paragraph classifier, in DataFrame functions and Spark ML.

A paragraph is a line of a text, or a run of two and more lines between blank
ones (a notice wrapped over lines); both are scored, and come out if found. Its words and pairs of neighbouring words
are the features of a multinomial logistic regression over licence families and
"none", trained on variants of the templates below and on a bounded sample of
the corpus' paragraphs (those unlike every template, that hold no larger part
of one and no word of ``NAMES``, are "none"). The largest family probability that a held-out part of
the sample gets, though it is none, sets the cutoff; a paragraph under it that
is no clear "none" either is the class "unknown", and so is one that has none of
the words by which the family's nearest template differs from other families'.
The words a prediction shares with that template (Jaccard of the word sets)
confirm it, unless it has a word of ``CONTRARY`` (share alike, lesser, another
version, not) that the template has not.

The model decides on every paragraph of every text: those without a word that
weighs for any family are none whatever else they hold (``needed_words``), and
the others are scored. Fitting reads at most ``SAMPLE``
paragraphs, half of them with a long word of the templates; they are taken from
those with the smallest hashes.

Defined results: null, empty and blank texts have no paragraphs; repeated rows
get rows each; a null doc_id stays null; without rows there are no results.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
import zlib

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsdesk.llm.common import partitions, settled

SAMPLE, FEATURES, VARIANTS, CONFIRMED = 4000, 20_000, 12, 0.5
DRAWN = 64  # paragraphs looked at for each one of the sample
NONE, UNKNOWN = "none", "unknown"

# Notices of the licences, as their publishers word them.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "This project is licensed under the terms of the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
            "to deal in the Software without restriction."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "Licensed under the BSD 3-Clause License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0, public domain dedication."],
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without permission.",
                            "Tous droits réservés.", "Alle Rechte vorbehalten.", "Todos los derechos reservados."],
}


# The licences' short names, and notices that hold one.
SHORT = {
    "MIT": ["MIT"],
    "Apache-2.0": ["Apache", "Apache-2.0"],
    "GPL-3.0": ["GPL-3.0-or-later", "GPL-3.0-only", "GPLv3", "GPLv3 or later"],
    "BSD": ["BSD", "BSD-3-Clause", "BSD-2-Clause"],
    "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC-BY": ["CC-BY-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC-BY-ND": ["CC-BY-ND-4.0"],
    "GPL-2.0": ["GPL-2.0-or-later", "GPL-2.0-only", "GPLv2"],
    "LGPL": ["LGPL-3.0-or-later", "LGPL"],
    "AGPL-3.0": ["AGPL-3.0-or-later", "AGPLv3"],
    "MPL-2.0": ["MPL-2.0", "MPL 2.0"],
    "CC0": ["CC0-1.0"],
}
NAMES = ["gnu", "gpl", "gplv3", "spdx", "bsd", "cc0", "mpl", "lgpl", "agpl"]  # words of no other use
# Words that make one licence another, or deny it.
CONTRARY = ["sa", "sharealike", "nd", "noderivatives", "noderivs", "nc", "noncommercial", "lesser", "lgpl", "affero", "agpl", "agplv3",
            "gplv2", "gplv3", "2", "3", "2.0", "3.0", "not", "never", "nicht", "pas", "no"]
NOTICES = ["{}", "SPDX-License-Identifier: {}", "Code is {}.", "{}-licensed", "Licensed under {}", "Distributed under {}",
           "Distributed under the {} license", "{}-Lizenz", "Licence {}", "Licencia {}"]


def notices() -> list[tuple[str, str]]:
    """(family, template): the templates, and the notices of the short names."""
    return ([(f, t) for f, ts in TEMPLATES.items() for t in ts]
            + [(f, n.format(x)) for f, names in SHORT.items() for x in names for n in NOTICES])


def words(text) -> Column:
    """Lower-case words of letters, digits and inner dots; licence as license."""
    cut = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?![\p{L}\p{N}])|(?<![\p{L}\p{N}])\.", " ")
    return F.filter(F.split(F.replace(cut, F.lit("licenc"), F.lit("licens")), " "), lambda w: w != "")


def grams(w: str) -> Column:
    pairs = F.transform(w, lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))
    return F.concat(w, F.filter(pairs, lambda p: p.isNotNull()))


def _templates(spark: SparkSession) -> DataFrame:
    """family, template, words, and own: the words with a letter that no other
    family's templates have."""
    found = [(f, t, set(re.findall(r"[^\W_]+(?:\.[^\W_]+)*", t.lower()))) for f, t in notices()]
    rows = [(f, t, sorted(x for x in w if re.search(r"[^\W\d_]", x) and not any(x in v for g, _, v in found if g != f))) for f, t, w in found]
    return spark.createDataFrame(rows, "family string, template string, own array<string>").withColumn("words", words("template"))


def _variants(spark: SparkSession) -> DataFrame:
    """The templates with some words left out, the same ones each time."""
    rows = []
    for f, t in notices():
        w = t.split()
        rows += [(f, " ".join(x for i, x in enumerate(w) if v == 0 or len(w) < 4 or zlib.crc32(f"{t}{v}{i}".encode()) % 10 >= 2)) for v in range(VARIANTS)]
    return spark.createDataFrame(rows, "family string, text string").select("family", words("text").alias("words"))


def evidence() -> list[str]:
    """The templates' words of six letters and more, and their short names."""
    found = {w.strip(".,:;()\"").lower() for _, t in notices() for w in t.replace("/", " ").replace("-", " ").split()}
    return sorted({w for w in found if len(w) >= 6 and w.isalpha()} | {*NAMES, "mit", "cc", "rights"})


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (number of its first line), lines (how many), text."""
    d = docs.select(F.col("doc_id").cast("long"), F.split(F.col("text").cast("string"), "\n").alias("split"))
    blank = F.filter(F.transform("split", lambda x, i: F.when(x.rlike(r"^\s*$"), i)), lambda i: i.isNotNull())
    d = d.withColumn("ends", F.concat(F.array(F.lit(-1)), blank, F.array(F.size("split"))))
    runs = F.transform("ends", lambda e, i: F.struct((e + 1).alias("paragraph"), (F.get("ends", i + 1) - e - 1).alias("lines")))
    d = d.withColumn("runs", F.filter(runs, lambda r: r["lines"] > 1))
    single = F.transform("split", lambda x, i: F.struct(i.alias("paragraph"), F.lit(1).alias("lines"), x.alias("text")))
    run = F.transform("runs", lambda r: F.struct(r["paragraph"].alias("paragraph"), r["lines"].alias("lines"),
                                                 F.array_join(F.slice("split", r["paragraph"] + 1, r["lines"]), " ").alias("text")))
    return d.select("doc_id", F.explode(F.concat(single, run)).alias("x")).select("doc_id", "x.*")


def paragraph_words(docs: DataFrame, needed: list[str] | None = None) -> DataFrame:
    """doc_id, paragraph, lines, words of the paragraphs that have a word, and
    one of ``needed`` if given. A text is split into words once: those of a run
    are those of its lines."""
    d = docs.select(F.col("doc_id").cast("long"), F.split(F.col("text").cast("string"), "\n").alias("split"))
    blank = F.filter(F.transform("split", lambda x, i: F.when(x.rlike(r"^\s*$"), i)), lambda i: i.isNotNull())
    d = d.select("doc_id", F.transform("split", words).alias("said"), F.concat(F.array(F.lit(-1)), blank, F.array(F.size("split"))).alias("ends"))
    runs = F.filter(F.transform("ends", lambda e, i: F.struct((e + 1).alias("paragraph"), (F.get("ends", i + 1) - e - 1).alias("lines"))),
                    lambda r: r["lines"] > 1)
    single = F.transform("said", lambda w, i: F.struct(i.alias("paragraph"), F.lit(1).alias("lines"), w.alias("words")))
    run = F.transform(runs, lambda r: F.struct(r["paragraph"].alias("paragraph"), r["lines"].alias("lines"),
                                               F.flatten(F.slice("said", r["paragraph"] + 1, r["lines"])).alias("words")))
    fits = (lambda x: F.size(x["words"]) > 0) if needed is None else (lambda x: F.exists(x["words"], lambda w: w.isin(needed)))
    return d.select("doc_id", F.explode(F.filter(F.concat(single, run), fits)).alias("x")).select("doc_id", "x.*")


def needed_words(counter: CountVectorizerModel, model: LogisticRegressionModel, none: int) -> list[str] | None:
    """Words of which a paragraph must have one to be anything but none, or None
    if there is no such bound. A gram counts for a family where its weight is
    over that for none; without such a gram every family is at most as likely,
    next to none, as for a paragraph without features. Of a pair the rarer word
    is taken: no pair is there without it."""
    weight, start = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    e = [math.exp(x - start[none]) for x in start]
    if e[none] / sum(e) <= 0.5:
        return None
    vocabulary = list(counter.vocabulary)  # by falling frequency
    rank = {g: i for i, g in enumerate(vocabulary)}
    more = weight.max(axis=0) > weight[none]
    return sorted({max(g.split(" "), key=lambda w: rank.get(w, len(rank))) for g, m in zip(vocabulary, more.tolist()) if m})


def _likeness(a, b) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - common)


def _sample(docs: DataFrame, sample: int) -> DataFrame:
    """words of at most ``sample`` distinct paragraphs."""
    found = paragraphs(docs).select("text", F.xxhash64("text").alias("hash")).where(~F.col("text").rlike(r"^\s*$"))
    share = min(1.0, DRAWN * sample / max(1, found.count()))
    drawn = found.where(F.pmod("hash", F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select(words("text").alias("words"))
    drawn = settled(drawn.where(F.size("words") > 0).distinct().withColumn("hash", F.xxhash64("words")), "license-drawn")
    told = F.arrays_overlap("words", F.array(*map(F.lit, evidence())))
    half = [drawn.where(x).orderBy("hash", "words").limit(sample // 2) for x in (told, ~told)]
    return half[0].unionByName(half[1]).select("words")


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[CountVectorizerModel, LogisticRegressionModel, list[str], float]:
    """The features' and the families' model, the families, and the cutoff of
    the unknown class."""
    spark = docs.sparkSession
    t = _templates(spark).select("family", F.array_distinct("words").alias("words"), grams("words").alias("grams"))
    t = t.agg(F.collect_list(F.struct("family", "words", "grams")).alias("templates"))
    # a bounded sample against the templates; the family is the nearest one's
    drawn = settled(_sample(docs, sample), "license-sample").repartition(partitions(spark)).withColumn("g", F.array_distinct(grams("words")))
    # what no template has can be in no intersection
    drawn = settled(drawn.crossJoin(F.broadcast(t)).select(  # one row
        "words", F.arrays_overlap("words", F.array(*map(F.lit, NAMES))).alias("says"), F.size("g").alias("n_grams"), F.size(F.array_distinct("words")).alias("n_words"),
        F.array_intersect("g", F.flatten("templates.grams")).alias("both")), "license-shared").crossJoin(F.broadcast(t))
    of = lambda x: F.size(F.array_intersect("both", x))
    near = drawn.withColumn("best", F.array_max(F.transform("templates", lambda x: F.struct(
        (of(x["words"]) / (F.col("n_words") + F.size(x["words"]) - of(x["words"]))).alias("like"), x["family"].alias("family")))))
    near = near.withColumn("part", F.array_max(F.transform("templates", lambda x: of(x["grams"]))) / F.col("n_grams"))
    drawn = settled(near.select(F.when(F.col("best.like") >= 0.8, F.col("best.family"))
                                .when((F.col("best.like") < 0.34) & (F.col("part") < 0.5) & ~F.col("says"), F.lit(NONE))
                                .alias("family"), "words").where("family is not null"), "license-labelled")
    held = F.pmod(F.xxhash64("words"), F.lit(4)) == 0
    rows = _variants(spark).unionByName(drawn.where(~held)).unionByName(spark.createDataFrame(
        [(NONE, [])] * VARIANTS * len(TEMPLATES), "family string, words array<string>"))
    names = [*TEMPLATES, NONE]
    label = F.array_position(F.array(*map(F.lit, names)), F.col("family")).cast("double") - 1
    rows = rows.select(label.alias("label"), grams("words").alias("grams")).coalesce(8).cache()
    try:
        counter = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=FEATURES, minDF=2, binary=True).fit(rows)
        model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60).fit(counter.transform(rows))
    finally:
        rows.unpersist()
    model = model.setRawPredictionCol("").setPredictionCol("")
    test = probabilities(drawn.where(held & (F.col("family") == NONE)), counter, model)
    worst = test.agg(F.max(F.array_max(F.slice("p", 1, len(names) - 1)))).first()[0]
    return counter, model, names, min(0.95, max(0.5, worst or 0.0))


def probabilities(rows: DataFrame, counter: CountVectorizerModel, model: LogisticRegressionModel) -> DataFrame:
    """The rows with p: the probabilities of the families and of none."""
    found = model.transform(counter.transform(rows.withColumn("grams", grams("words"))))
    return found.withColumn("p", vector_to_array("probability")).drop("grams", "features", "probability")


def scan(docs: DataFrame) -> DataFrame:
    """Per licence paragraph: doc_id, paragraph (line number from 0), lines,
    family (or unknown), probability, likeness (to its nearest template),
    confirmed."""
    counter, model, names, cutoff = train(docs)
    s = probabilities(paragraph_words(docs, needed_words(counter, model, len(names) - 1)), counter, model)
    # a generator, not a filter: a filter would move below and repeat the scoring
    s = s.select("doc_id", "paragraph", "lines", "words", F.explode(F.filter(
        F.array("p"), lambda p: F.get(p, F.lit(len(names) - 1)) <= 0.5)).alias("p")).where(F.size("words") > 0)
    family = F.slice("p", 1, len(names) - 1)
    s = s.withColumn("probability", F.array_max(family)).withColumn(
        "family", F.get(F.array(*map(F.lit, names)), F.array_position(family, F.array_max(family)).cast("int") - 1))
    told = settled(s.drop("p").withColumn("row", F.monotonically_increasing_id()), "license-found")
    near = told.join(F.broadcast(_templates(docs.sparkSession).select("family", "own", F.col("words").alias("t"))), "family")
    # what makes another licence of it, or denies it, must be in the template
    fits = F.size(F.array_except(F.array_intersect("words", F.array(*map(F.lit, CONTRARY))), "t")) == 0
    named = (F.size("own") == 0) | F.arrays_overlap("words", "own")
    out = near.groupBy("row", "doc_id", "paragraph", "lines", "family", "probability").agg(
        F.max(F.struct(_likeness("words", "t").alias("likeness"), named.alias("named"), fits.alias("fits"))).alias("best")).select("*", "best.likeness")
    sure = (F.col("probability") >= cutoff) & F.col("best.named")
    return out.select("doc_id", "paragraph", "lines", F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("family"),
                      F.round("probability", 6).alias("probability"), F.round("likeness", 6).alias("likeness"),
                      (sure & (F.col("likeness") >= CONFIRMED) & F.col("best.fits")).alias("confirmed"))
