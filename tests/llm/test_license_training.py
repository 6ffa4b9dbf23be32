"""op4 learns from, and is calibrated on, all lines that are no licences."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from sedimenta.llm import license_scan as ls


def test_every_line_is_taken(spark):
    texts = ["\n".join(f"line {i} of text {t} says the words of the public" for i in range(7)) for t in range(60)]
    texts += [texts[0], None, "", " \n.", "a copyright line\nfree of charge to any person here\nand one more line"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    vocabulary = ls._vocabulary(ls._templates(spark))
    got = ls._background(frame, vocabulary, "text")
    assert got.count() == 7 * 60 + 1  # no cue, and no three words in a row of a template
    cued = spark.createDataFrame([(f"copyright of song {i}",) for i in range(50)] * 2, "text string")
    assert ls._cued(cued, vocabulary).count() == 50
    model = ls.train(got, ls._cued(cued, vocabulary), vocabulary, 2)
    assert model.threshold >= 0.5 and len(model.families) == len(ls.TEMPLATES) + 1


def test_known_grams_are_those_of_the_features(spark):
    vocabulary = ls._vocabulary(ls._templates(spark))
    texts = [t for some in ls.TEMPLATES.values() for t in some] + [*ls.DISTRACTORS, "the", "of the license you may obtain a"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select(ls.words_of(F.col("text")).alias("words"))
    grams = F.concat(*(ls._known_grams(F.col("words"), n, vocabulary) for n in (1, 2, 3)))
    for r in frame.select(grams.alias("few"), ls.features_of(F.col("words")).alias("all")).collect():
        assert set(r.few) == set(r.all) & set(vocabulary)


def test_the_threshold_is_that_of_all_rows(spark):
    random.seed(5)
    data = [(c, round(random.random() * (0.9 if c else 0.7), 6)) for c in (True, False) for _ in range(4000)]
    want = max(sorted(k for c, k in data if c == kind)[-5] for kind in (True, False))
    assert ls._reached(spark.createDataFrame(data, "cued boolean, known double")) == want
    assert ls._reached(spark.createDataFrame([(True, 0.1)], "cued boolean, known double")) == 0.5
    assert ls._reached(spark.createDataFrame([], "cued boolean, known double")) is None
