"""Licence scans: a trained paragraph classifier, with an unknown class, confirmed by templates.

Features are binary word 1- to 3-grams that occur in the templates below; a multinomial logistic
regression with an L1 penalty leaves few of them with a weight. It is trained here, on the
templates, on parts of them that still name their licence, and on DISTRACTORS and lines without a
cue as the unknown class. Its threshold is calibrated on lines that were not in training and are not
licences: others without a cue, and those with a cue. None of them has three words in a row with any
template, as the lines of a wrapped notice have. A family counts only if its probability is above
what all but 1 in 1,000 of either reach with their likeliest family, and above 1/2. All such lines
of all texts are taken, each different one once: of those without a cue half for training and half
for calibration, by their hash. So that they do not outweigh the templates, those in training
weigh together as much as `background` / 2 of them, if they are more. Lines are features when they
are shuffled, and training and calibration run over all partitions. Probabilities are rounded to
six digits, as sums over partitions differ behind them from run to run.

A candidate is a line with one of the CUES, also one whose words go on in the next line. No
template is without a cue. It is judged twice:

1. By itself: a prediction is confirmed by template comparison: the line must hold
   `overlap_percent` of the word pairs of one of the family's templates, or of one of its short
   notices.
2. If that fails, as part of a wrapped notice. Its neighbours are the REACH words before and
   after it (as many as the longest template has), over line ends, blank lines and comment
   marks. A template is laid where most of the line's own pairs put it; the pairs that lie in
   their place, give or take a quarter of its length, must be `overlap_percent` of it. The
   classifier then judges the words of that place, and must predict the template's family. The
   notice counts once, at the line where it begins, however many of its lines have a cue, and not
   at all if one of them was confirmed by itself.

Neither counts if the words judged say that the licence is not given (NEGATIONS), or name a
relative of it that is another licence, or another version (RIVALS): a notice that names both
counts for neither by these words.

The test for cues runs on whole texts first, so texts without a cue are never split.
DataFrame, SQL and ML operations only; the templates' bounded tables are the only broadcast.

Nulls: a null text has no paragraph; a null id stays null. Repeated rows (same id and text) have
equal results. An empty table gives an empty result, other columns are not read, and lines of any
length are judged whole.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.scratch import Scratch

UNKNOWN = "unknown"
BACKGROUND = 2_000

# Public licence notices, each as short as it is used, and what is like them.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 2.",
        "Licensed under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU AGPL v3.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "EPL": (
        "Licensed under the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ),
    "Artistic": (
        "Licensed under the Artistic License 2.0.",
        "SPDX-License-Identifier: Artistic-2.0",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions",
    ),
    "MPL": (
        "Licensed under the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "public-domain": (
        "This work is dedicated to the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "reserved": (
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced or transmitted without prior written permission.",
    ),
}
#: Pairs of words that mark a relative of the family, or a version, that its templates are not for.
RIVALS = {
    "GPL": ("gnu affero", "gnu agpl", "identifier agpl", "gnu lesser", "gnu library", "gnu lgpl", "identifier lgpl", "gnu free"),
    "LGPL": ("gnu affero", "gnu agpl", "identifier agpl"),
    "AGPL": ("gnu lesser", "gnu library", "gnu lgpl", "identifier lgpl"),
    "Apache": ("version 1.0", "version 1.1", "license 1.0", "license 1.1", "apache 1.0", "apache 1.1"),
    "MPL": ("v 1.0", "v 1.1", "version 1.0", "version 1.1", "license 1.0", "license 1.1", "mpl 1.0", "mpl 1.1"),
    "CC-BY": (
        "by sa", "by nc", "by nd", "attribution sharealike", "attribution noncommercial", "attribution noderivatives",
        "attribution noderivs",
    ),
    "CC-BY-SA": ("by nc", "by nd", "attribution noncommercial", "attribution noderivatives", "attribution noderivs"),
    "CC-BY-ND": ("by sa", "by nc", "attribution sharealike", "attribution noncommercial"),
    "CC-BY-NC": (
        "by sa", "by nd", "nc sa", "nc nd", "noncommercial sharealike", "noncommercial noderivatives", "noncommercial noderivs",
    ),
    "CC-BY-NC-SA": ("nc nd", "noncommercial noderivatives", "noncommercial noderivs"),
    "CC-BY-NC-ND": ("nc sa", "noncommercial sharealike"),
}
NEGATIONS = tuple(
    f"{no} {said}"
    for no in ("not", "never", "longer", "neither", "nor")
    for said in ("licensed", "released", "distributed", "dedicated", "covered", "subject", "under", "made")
) + ("isn t", "aren t", "wasn t")
DISTRACTORS = (
    "You need a driving licence to rent a car here.",
    "The museum holds a licence to serve drinks until midnight.",
    "He lost his licence after the accident.",
    "The public is free to use the software of the library.",
    "Permission to park is granted by the office.",
    "The work is in the public library.",
    "The general public may use the hall without restriction.",
    "Terms and conditions of the contract were published.",
    "A copy of the report was distributed to the board.",
    "The fishing license costs ten dollars at the counter.",
    "Version 3 of the plan was released in May.",
    "The rights of the members are reserved for the meeting.",
)
CUES = ("licen[cs]e", "licensed", "copyright", "public domain", "redistribut", "hereby granted", "all rights reserved")
CUE = "(?i)" + "|".join(CUES)
#: A cue in a text, and in the words around a line's end, which is marked by a bar.
CUE_ANYWHERE = CUE.replace(" ", r"[^\p{L}\p{N}]+")
CUE_OVER_END = r"\b(public \| domain|hereby \| granted|all \| rights reserved|all rights \| reserved)\b"
_WORD = r"[^\p{L}\p{N}.]+|\.(?![0-9])"
REACH = max(len(re.findall(r"[^\W_]+", t)) for texts in TEMPLATES.values() for t in texts)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _WORD), lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    last = F.size(words) - n + 1
    return F.when(
        last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
    ).otherwise(F.array().cast("array<string>"))


def features_of(words: Column) -> Column:
    return F.array_distinct(F.concat(words, _grams(words, 2), _grams(words, 3)))


def _refused(family: Column, words: Column) -> Column:
    """Whether the words deny the licence, or name a relative of the family."""
    none = F.array().cast("array<string>")
    of_family = F.create_map(*(c for f, pairs in RIVALS.items() for c in (F.lit(f), F.array(*map(F.lit, pairs)))))
    marks = F.concat(F.array(*map(F.lit, NEGATIONS)), F.coalesce(F.element_at(of_family, family), none))
    return F.arrays_overlap(_grams(words, 2), marks)


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    frame = spark.createDataFrame(rows, "family string, text string").withColumn("words", words_of(F.col("text")))
    return frame.select("family", "text", "words", F.array_distinct(_grams(F.col("words"), 2)).alias("pairs"))


def _known_grams(words: Column, n: int, vocabulary: list[str]) -> Column:
    """The runs of n words that the vocabulary has. Only where a word begins one is a run made."""
    known = [g for g in vocabulary if g.count(" ") == n - 1]
    starts = sorted({g.split(" ")[0] for g in known})
    run = lambda w, i: F.concat_ws(" ", w, *(F.get(words, i + k) for k in range(1, n)))
    return F.filter(F.transform(words, lambda w, i: F.when(w.isin(starts), run(w, i))), lambda g: g.isin(known))


def _training(templates: DataFrame) -> DataFrame:
    """(label text, words): templates, and their parts of three quarters and a half; DISTRACTORS."""
    size = F.size("words")
    parts = F.array(
        F.col("words"),
        F.slice("words", F.lit(1), F.greatest(F.lit(3), (size * 3 / 4).cast("int"))),
        F.slice("words", F.greatest(F.lit(1), (size / 4).cast("int") + 1), size),
        F.when(size > 12, F.slice("words", F.lit(1), (size / 2).cast("int"))),
        F.when(size > 12, F.slice("words", (size / 2).cast("int") + 1, size)),
    )
    known = templates.select("family", F.explode(parts).alias("words")).where("words is not null")
    spark = templates.sparkSession
    other = spark.createDataFrame([(t,) for t in DISTRACTORS], "text string")
    return known.union(other.select(F.lit(UNKNOWN), words_of(F.col("text"))))


class LicenceModel:
    """The classifier, its families by number (the unknown one last), and the probability that counts."""

    def __init__(self, vocabulary: CountVectorizerModel, regression, families: list[str], threshold: float) -> None:
        self.vocabulary, self.regression, self.families, self.threshold = vocabulary, regression, families, threshold

    def predict(self, paragraphs: DataFrame) -> DataFrame:
        """Adds family, its probability and the largest one of a known family to rows that have `words`."""
        return self.score(self.vocabulary.transform(paragraphs.withColumn("grams", features_of(F.col("words")))), paragraphs.columns)

    def score(self, counted: DataFrame, kept: list[str]) -> DataFrame:
        """The same for rows that have `features`."""
        chances = F.transform(vector_to_array("probability"), lambda p: F.round(p, 6))
        scored = self.regression.transform(counted).withColumn("chances", chances)
        names = F.array(*map(F.lit, self.families))
        return scored.select(
            *kept,
            F.element_at(names, F.col("prediction").cast("int") + 1).alias("family"),
            F.array_max("chances").alias("probability"),
            F.array_max(F.slice("chances", 1, len(self.families) - 1)).alias("known"),
        )


def _vocabulary(templates: DataFrame) -> list[str]:
    grams = templates.select(F.explode(features_of(F.col("words"))).alias("gram")).distinct().orderBy("gram")
    return [r["gram"] for r in grams.collect()]


def _counter(vocabulary: list[str]) -> CountVectorizerModel:
    counter = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features")
    counter.setBinary(True)
    return counter


def train(background: DataFrame, cued: DataFrame, vocabulary: list[str], most: int) -> LicenceModel:
    """A model from the templates and two tables of lines that are no licences: those without a cue
    (text_hash, features) and with one (text). In training the first weigh as much as `most` / 2 rows."""
    spark = background.sparkSession
    half = F.pmod("text_hash", F.lit(2)) == 0
    families = [*TEMPLATES, UNKNOWN]
    numbers = F.map_from_arrays(F.array(*map(F.lit, families)), F.array(*(F.lit(float(i)) for i in range(len(families)))))
    counter = _counter(vocabulary)
    own = counter.transform(
        _training(_templates(spark)).select(
            F.element_at(numbers, F.col("family")).alias("label"), features_of(F.col("words")).alias("grams")
        )
    ).select("label", "features", F.lit(1.0).alias("weight"))
    taught = background.where(half)
    weight = min(1.0, most / 2 / max(1, taught.count()))
    unknown = taught.select(F.lit(float(len(families) - 1)).alias("label"), "features", F.lit(weight).alias("weight"))
    regression = LogisticRegression(
        family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60, standardization=False, weightCol="weight"
    )
    model = regression.fit(own.coalesce(1).unionByName(unknown))
    first = LicenceModel(counter, model, families, 0.5)
    others = first.score(background.where(~half), []).select(F.lit(False).alias("cued"), "known")
    others = others.unionByName(first.predict(cued.select(words_of(F.col("text")).alias("words"))).select(F.lit(True).alias("cued"), "known"))
    return LicenceModel(counter, model, families, max(0.5, _reached(others) or 0.0))


def _reached(others: DataFrame, one_in: int = 1_000) -> float | None:
    """What all but one in `one_in` of the rows of either kind (cued, known) do not pass, if it is above
    1/2. Rows are counted by probability, of which there are half a million above 1/2, with six digits."""
    counts = others.groupBy("cued", F.greatest("known", F.lit(0.5)).alias("known")).agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("cued")
    total, above = F.sum("n").over(of), F.sum("n").over(of.orderBy(F.desc("known")))
    counts = counts.select("known", (above > F.floor(total / one_in)).alias("passed"))
    return counts.where("passed").agg(F.max("known")).first()[0]


def paragraphs_with_cues(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, at, text, before, after): lines that hold a cue; `at` counts lines from
    0, `before` and `after` are the (at, word) of the REACH words on either side."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("text")))
    said = F.filter(lines, lambda s: s["text"].rlike(r"[\p{L}\p{N}]"))
    texts = documents.where(F.col(text_col).rlike(CUE_ANYWHERE)).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text, F.length(text)).alias("text_hash"), said.alias("lines")
    )
    ends = lambda s, i: F.concat_ws(
        " ",
        F.reverse(F.slice(F.reverse(words_of(s["text"])), 1, 2)),
        F.lit("|"),
        F.slice(words_of(F.get("lines", i + 1)["text"]), 1, 2),
    )
    half = lambda s: s["text"].rlike(r"(?i)(public|hereby|\ball|\ball\P{L}+rights)[^\p{L}\p{N}]*$")
    cued = lambda s, i: s["text"].rlike(CUE) | (half(s) & F.coalesce(ends(s, i).rlike(CUE_OVER_END), F.lit(False)))
    marked = F.transform("lines", lambda s, i: F.when(cued(s, i), i))
    rows = texts.select("doc_id", "text_hash", "lines", F.explode(F.filter(marked, lambda i: i.isNotNull())).alias("i"))
    tagged = lambda s: F.transform(words_of(s["text"]), lambda w: F.struct(s["at"].alias("at"), w.alias("word")))
    none = F.array().cast("array<struct<at:int,word:string>>")
    near = lambda some, joined: F.aggregate(
        some, none, lambda held, s: F.when(F.size(held) >= REACH, held).otherwise(joined(held, tagged(s)))
    )
    first = F.greatest(F.lit(0), F.col("i") - REACH)
    back = F.reverse(F.slice("lines", first + 1, F.col("i") - first))
    before = near(back, lambda held, more: F.concat(more, held))
    after = near(F.slice("lines", F.col("i") + 2, F.lit(REACH)), lambda held, more: F.concat(held, more))
    line = F.get("lines", F.col("i"))
    return rows.select(
        "doc_id", "text_hash", line["at"].alias("at"), line["text"].alias("text"), before.alias("before"), after.alias("after")
    ).withColumns(
        {
            "before": F.slice("before", F.greatest(F.lit(1), F.size("before") - REACH + 1), F.lit(REACH)),
            "after": F.slice("after", F.lit(1), F.lit(REACH)),
        }
    ).dropDuplicates(["doc_id", "text_hash", "at"])


def _laid(lines: DataFrame, forms: DataFrame, overlap_percent: int) -> DataFrame:
    """(doc_id, text_hash, at, form_family, first, last, words, n_held): templates that lie over a
    line of `lines` (with before, after and words), the lines they reach, the words there and how
    many pairs are held."""
    part = lambda side, name: F.transform(side, lambda x: x[name])
    rows = lines.select(
        "doc_id", "text_hash", "at", F.size("before").alias("a"), (F.size("before") + F.size("words")).alias("b"),
        F.concat(part("before", "at"), F.transform("words", lambda w: F.col("at")), part("after", "at")).alias("ats"),
        F.concat(part("before", "word"), "words", part("after", "word")).alias("near"),
    ).withColumn("all", _grams(F.col("near"), 2))
    rows = rows.crossJoin(forms).withColumn("n", F.size("pairs"))
    held = F.size(F.array_intersect("pairs", "all"))
    rows = rows.where(held * 100 >= F.col("n") * overlap_percent)
    places = F.transform("all", lambda p, q: F.struct(q.alias("q"), F.array_position("pairs", p).alias("of")))
    places = F.transform(F.filter(places, lambda p: p["of"] > 0), lambda p: F.struct(p["q"].alias("q"), (p["q"] - p["of"] + 1).alias("d")))
    rows = rows.withColumn("places", places)
    mine = F.filter("places", lambda p: (p["q"] >= F.col("a") - 1) & (p["q"] < F.col("b")))
    rows = rows.withColumn("mine", F.array_sort(F.transform(mine, lambda p: p["d"]))).where(F.size("mine") > 0)
    slack = F.greatest(F.lit(2), F.floor(F.col("n") / 4).cast("int"))
    rows = rows.withColumn("d", F.get("mine", F.floor(F.size("mine") / 2).cast("int"))).withColumn("slack", slack)
    rows = rows.withColumn("places", F.filter("places", lambda p: F.abs(p["d"] - F.col("d")) <= F.col("slack")))
    kept = F.array_distinct(F.transform("places", lambda p: F.get("all", p["q"])))
    rows = rows.where(F.size(kept) * 100 >= F.col("n") * overlap_percent)
    start = F.greatest(F.lit(0), F.col("d") - F.col("slack")).cast("int")
    stop = (F.col("d") + F.col("n") + 1 + F.col("slack")).cast("int")
    first, last = F.get("places", F.lit(0))["q"], F.element_at("places", -1)["q"] + 1
    return rows.select(
        "doc_id", "text_hash", "at", "form_family",
        F.get("ats", first).alias("first"), F.get("ats", last).alias("last"),
        F.slice("near", start + 1, stop - start).alias("words"), F.size(kept).alias("n_held"),
    )


def _background(documents: DataFrame, vocabulary: list[str], text_col: str) -> DataFrame:
    """(text_hash, features): the different lines without a cue that have no three words in a row with
    any template."""
    words = F.col("words")
    lines = F.filter(
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]") & ~x.rlike(CUE)
    )
    # Words are made before the explosion: a filter behind it cannot move below and make them once for each word.
    line = F.transform(lines, lambda x: F.struct(F.xxhash64(x, F.length(x)).alias("text_hash"), words_of(x).alias("words")))
    rows = documents.select(F.explode(line).alias("line")).select("line.*")
    rows = rows.where(F.size(_known_grams(words, 3, vocabulary)) == 0)
    grams = F.concat(*(_known_grams(words, n, vocabulary) for n in (1, 2)))
    counted = _counter(vocabulary).transform(rows.select("text_hash", grams.alias("grams")))
    return counted.select("text_hash", "features").dropDuplicates(["text_hash"])


def _cued(lines: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The different lines with a cue that have no three words in a row with any template."""
    known = F.array(*(F.lit(g) for g in vocabulary if g.count(" ") == 2))
    return lines.select("text").where(~F.arrays_overlap(_grams(words_of(F.col("text")), 3), known)).distinct()


def scan_licences(
    documents: DataFrame,
    background: int = BACKGROUND,
    overlap_percent: int = 60,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a document: doc_id, n_candidates (lines with a cue), n_confirmed (notices),
    families (of confirmed notices, sorted, joined by commas), paragraphs (`line:family`, joined;
    the line where the notice begins), probability (the largest)."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "licences")
    lines = scratch.keep(paragraphs_with_cues(documents, id_col, text_col), "candidates")
    vocabulary = _vocabulary(_templates(spark))
    others = scratch.keep(_background(documents, vocabulary, text_col), "background")
    model = train(others, scratch.keep(_cued(lines, vocabulary), "cued"), vocabulary, background)
    predicted = model.predict(lines.withColumn("words", words_of(F.col("text"))))
    pairs = predicted.withColumn("own", _grams(F.col("words"), 2))
    forms = F.broadcast(_templates(spark).groupBy("family").agg(F.collect_list("pairs").alias("forms")))
    held = lambda form: F.size(F.array_intersect(form, "own")) * 100 >= F.size(form) * overlap_percent
    judged = pairs.join(forms, "family", "left").withColumn(
        "confirmed",
        (F.col("family") != UNKNOWN)
        & (F.col("probability") >= model.threshold)
        & F.coalesce(F.exists("forms", held), F.lit(False))
        & ~_refused(F.col("family"), F.col("words")),
    )
    judged = scratch.keep(judged.drop("own", "forms", "text"), "judged")
    each = F.broadcast(_templates(spark).select(F.col("family").alias("form_family"), "pairs"))
    laid = scratch.keep(_laid(judged.where(~F.col("confirmed")), each, overlap_percent), "laid")
    notices = model.predict(laid).where(
        (F.col("family") == F.col("form_family"))
        & (F.col("probability") >= model.threshold)
        & ~_refused(F.col("family"), F.col("words"))
    )
    # Of a family's templates over one line, short ones within long ones too, the fullest counts.
    best = F.max(F.struct("n_held", "first", "last", "probability")).alias("best")
    notices = notices.groupBy("doc_id", "text_hash", "at", "family").agg(best).select("doc_id", "text_hash", "family", "best.*")
    notices = notices.groupBy("doc_id", "text_hash", "first", "family").agg(
        F.max("last").alias("last"), F.max("probability").alias("probability")
    )
    own = ["doc_id", "text_hash"]
    alone = F.when(F.col("confirmed"), F.struct("at", "family", "probability"))
    over = F.struct(F.col("first").alias("at"), "family", "probability", "last")
    found = (
        judged.select(*own, alone.alias("alone"))
        .unionByName(notices.select(*own, over.alias("over")), allowMissingColumns=True)
        .groupBy(*own)
        .agg(
            F.count(F.when(F.col("over").isNull(), 1)).alias("n_candidates"),
            F.collect_list("alone").alias("alone"),
            F.collect_list("over").alias("over"),
        )
    )
    # A notice one of whose lines is confirmed by itself is there already.
    met = lambda n: F.exists(
        "alone", lambda x: (x["family"] == n["family"]) & x["at"].between(n["at"], n["last"])
    )
    more = F.transform(
        F.filter("over", lambda n: ~met(n)), lambda n: F.struct(n["at"].alias("at"), n["family"].alias("family"), n["probability"].alias("probability"))
    )
    found = found.select(*own, "n_candidates", F.array_sort(F.concat("alone", more)).alias("said"))
    found = found.select(
        *own, "n_candidates",
        F.size("said").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("said", lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform("said", lambda x: F.concat_ws(":", x["at"], x["family"])), ",").alias("paragraphs"),
        F.array_max(F.transform("said", lambda x: x["probability"])).alias("probability"),
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text, F.length(text)).alias("text_hash"))
    found = found.withColumnRenamed("doc_id", "f_doc_id").withColumnRenamed("text_hash", "f_text_hash")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_doc_id")) & (F.col("text_hash") == F.col("f_text_hash")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return joined.select("doc_id", zero("n_candidates"), zero("n_confirmed"), empty("families"), empty("paragraphs"), "probability")
