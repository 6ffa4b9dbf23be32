"""Collocations against counts of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from sedimenta.llm.collocations import count_phrases, mine_collocations

SCHEMA = "doc_id long, text string, lang string, rank int, n int, phrase string, w1 string, slice long"


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def brute_counts(rows, most=4):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for words in pieces(text):
            totals[lang or "und"] += len(words)
            for size in range(1, most + 1):
                counts.update((lang or "und", tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    return counts, totals


def brute(rows, least, top, most=4):
    counts, totals = brute_counts(rows, most)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = (lang, words[i : i + size])
                longer[key] = max(longer[key], a)
    out = {}
    for (lang, words), a in candidates.items():
        if 100 * longer[lang, words] >= 80 * a:
            continue
        cuts = [(2000000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted(
        (lang, i, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, found in out.items()
        for i, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)
    )


def rows(seed=11, count=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "ÉÉ", "a", "b", "x\x00y", "new", "york", "Z" * 20, "ß", "w v", "中"]
    phrases = ["new york city", "of the", "a b a b", "é ß é", "the the the the the"]
    out = []
    for i in range(count):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", "\x0b", ".", " . "]) for p in parts)
        out.append((i, None if i % 29 == 0 else text, None if i % 7 == 0 else rng.choice(["en", "en", "de", "und"]), 1, 2, "p", "w", 3))
    return [*out, out[3], out[3], (None, "the new york", "fr", 1, 2, "p", "w", 3), (900, "", "es", 1, 2, "p", "w", 3)]


def ordered(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("least, top, most", [(30, 2000, 4), (5, 7, 4), (2, 2000, 3), (3, 2000, 5)])
def test_collocations(spark, least, top, most):
    table = rows()
    got = ordered(mine_collocations(spark.createDataFrame(table, SCHEMA).repartition(4), most, least, top))
    want = brute(table, least, top, most)
    assert len(want) > 10 and got == want


def test_counts_in_several_slices_and_buckets(spark, monkeypatch):
    import sedimenta.llm.collocations as module

    monkeypatch.setattr(module, "BUCKET_BYTES", 3_000)
    table = rows(12)
    counts, totals = brute_counts(table)
    got = ordered(count_phrases(spark.createDataFrame(table, SCHEMA).repartition(6), least=9).drop("words"))
    want = [(lang, " ".join(w), n) for (lang, w), n in counts.items() if n >= 9] + [(lang, "", n) for lang, n in totals.items() if n]
    assert got == sorted(want)


def test_a_long_text_and_long_words(spark):
    text = "x" * 5_000_000 + " " + "b a " * 300_000 + ("ab" * 600_000 + " c ") * 3
    table = [(1, text, "en", 1, 1, "", "", 1), (2, "c b", "en", 1, 1, "", "", 1)]
    got = [(r.phrase, r.a, r.l, r.r, r.n) for r in mine_collocations(spark.createDataFrame(table, SCHEMA)).collect()]
    want = [(phrase, a, l, r, n) for _, _, phrase, a, l, r, n, _ in brute(table, 30, 2000)]
    assert sorted(got) == sorted(want)


def test_ties_are_ordered_by_bytes(spark):
    text = ". ".join(f"{a} {b}" for a, b in [("z", "y"), ("a", "b"), ("é", "b2"), ("P", "q")]) + ". "
    table = [(1, text * 30, "en", 1, 1, "", "", 1)]
    got = [(r["rank"], r.phrase, r.score) for r in mine_collocations(spark.createDataFrame(table, SCHEMA)).orderBy("rank").collect()]
    assert got == [(1, "a b", 1000000), (2, "p q", 1000000), (3, "z y", 1000000), (4, "é b2", 1000000)]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mine_collocations(none).collect() == []
    assert mine_collocations(spark.createDataFrame([(1, None, None, 1, 1, "", "", 1)], SCHEMA)).collect() == []
