"""Phrases whose words keep company: top-order marginalisation.

Every word starts one longest window: its own column and lead columns for the words after it in
the same piece, padded where the piece ends. Only these windows are counted; ROLLUP over the
columns then sums them to all their prefixes, which are all phrases of one to `most` words, and
to the words of each language. No other length is ever listed.

Windows are cut before they are counted where no frequent phrase is lost. A phrase met `least`
times has only words, pairs and triples met as often, so a window ends before its first pair or
triple that is rarer. Which ones are is found by hash:

1. texts are dealt into slices of some megabytes, written once, so both passes see the same;
2. each slice sends the distinct hashes of its words, pairs and triples with their counts to
   `buckets` groups, and gets back those that are frequent in the whole corpus. A slice sends a
   hash once, so a word or passage of a third of the corpus is one entry of each slice;
3. each slice counts its cut windows, by the words themselves. Spark adds them up.

Hashes only decide what need not be counted: equal hashes of different phrases keep a window
longer than needed. Every count that is used is a count of words; phrases met `least` times or
more are counted whole, the others are left out. Counts of words that are rarer go into the
number of words of their language.

The score of a phrase of a occurrences cut into a first part of l and a rest of r is
floor(2000000 * a / (l + r)), in decimal numbers; its lowest cut counts, the earliest of equals.
A phrase that lies in a longer candidate with 80 % of its occurrences is left out.

Nulls: a null text is empty, a null language is `und`. Repeated rows count each time. Equal
scores are ordered by count, then by the phrase's bytes. Empty tables give an empty result,
other columns are not read, texts are read whole. Upper-case letters other than A-Z stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.scratch import Scratch
from sedimenta.llm.words import Words, column, find_words, grams, mix, slices

MOST, LEAST, TOP = 4, 30, 2000
SLICE_BYTES = 2 << 20
#: Bytes of text a group of hashes comes from: some three million hashes.
BUCKET_BYTES = 16 << 20
#: Phrases of up to so many words are looked up by hash.
FILTERED = 3

BREAKS = (*b".,;:!?", *range(0x0A, 0x0E))
IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[list(BREAKS)] = True
INSIDE = ~IS_BREAK
INSIDE[[0x09, 0x20]] = False


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the number of their slice."""
    number = TaskContext.get().partitionId() << 32
    for batch in slices(batches, most=SLICE_BYTES):
        numbers = pa.array(np.full(batch.num_rows, number))
        yield pa.RecordBatch.from_arrays([numbers, column(batch, "lang"), column(batch, "text")], ["slice", "lang", "text"])
        number += 1


class _Slice:
    """The words of a slice, where pieces go on, and hashes of its phrases."""

    def __init__(self, langs: pa.Array, texts: pa.Array) -> None:
        self.words: Words = find_words(texts, INSIDE, fold=True)
        encoded = langs.dictionary_encode()
        self.langs = encoded.dictionary
        row = self.words.row
        self.lang = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
        told = np.array([xxhash.xxh3_64_intdigest(x) for x in self.langs.to_pylist()], dtype=np.uint64)
        self.hashes = mix(self.words.hashes() ^ told[self.lang]) if len(row) else np.zeros(0, np.uint64)
        breaks = np.cumsum(IS_BREAK[self.words.data])
        follows = np.zeros(len(row), dtype=bool)
        follows[:-1] = (row[1:] == row[:-1]) & (breaks[self.words.start[1:]] == breaks[self.words.end[:-1] - 1])
        self.follows = follows

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of `length` words of one piece start, and their hashes."""
        at = np.ones(len(self.hashes), dtype=bool)
        for j in range(length - 1):
            at[: len(at) - j] &= self.follows[j:]
            at[len(at) - j :] = False
        at = np.flatnonzero(at)
        return at, grams(self.hashes, length, seed=length)[at] if len(at) else np.zeros(0, np.uint64)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _send(buckets: int, filtered: int, least: int) -> Callable:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (sent(n, _Slice(column(rows, "lang"), column(rows, "text"))) for n, rows in _runs(batch))

    def sent(number: int, part: _Slice) -> pa.RecordBatch:
        found = np.concatenate([part.phrases(n)[1] for n in range(1, filtered + 1)])
        hashes, counts = np.unique(found, return_counts=True)
        counts = np.minimum(counts, least).astype(np.min_scalar_type(least))
        short = hashes.astype(np.uint32)
        to = _bucket(hashes, buckets)
        edges = [0, *(np.flatnonzero(np.diff(to)) + 1).tolist(), len(to)]
        spans = [(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(to[a]) for a, _ in spans], pa.int64()),
                pa.array([number] * len(spans), pa.int64()),
                pa.array([short[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            ["bucket", "slice", "hashes", "counts"],
        )

    return send


def _frequent(least: int) -> Callable[[pa.Table], pa.Table]:
    """Of the hashes of one group, those met `least` times in all, for each slice that has them."""

    def frequent(group: pa.Table) -> pa.Table:
        kind = np.min_scalar_type(least)
        sent = [np.frombuffer(x.as_py(), np.uint32) for x in group["hashes"]]
        counts = np.concatenate([np.frombuffer(x.as_py(), kind) for x in group["counts"]])
        distinct, which = np.unique(np.concatenate(sent), return_inverse=True)
        often = np.bincount(which, weights=counts, minlength=len(distinct))[which] >= least
        back, at = [], 0
        for hashes in sent:
            back.append(hashes[often[at : at + len(hashes)]].tobytes())
            at += len(hashes)
        return pa.table({"slice": group["slice"], "bucket": group["bucket"], "hashes": pa.array(back, pa.binary())})

    return frequent


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one slice that follow each other. A slice may come in several runs."""
    numbers = column(batch, "slice").to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield int(numbers[a]), batch.slice(a, b - a)


def _spelled(words: Words) -> pa.DictionaryArray:
    """The words themselves, as places in a list of different ones."""
    lengths = words.end - words.start
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    letters = words.data[np.arange(offsets[-1]) + np.repeat(words.start - offsets[:-1], lengths)]
    kind, wide = (pa.string(), np.int32) if offsets[-1] < 2**31 else (pa.large_string(), np.int64)
    return pa.Array.from_buffers(
        kind, len(words), [None, pa.py_buffer(offsets.astype(wide)), pa.py_buffer(letters)]
    ).dictionary_encode()


def _tally(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different row, and how often it comes."""
    code = columns[0]
    for c in columns[1:]:
        code = np.unique(code, return_inverse=True)[1] * (int(c.max(initial=0)) + 1) + c
    _, at, counts = np.unique(code, return_index=True, return_counts=True)
    return at, counts


def _windows(buckets: int, filtered: int, most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The windows of a slice, with what is known to be frequent in it."""

    def windows(texts: pa.Table, notes: pa.Table) -> pa.Table:
        part = _Slice(*(pa.concat_arrays(texts[c].chunks) for c in ("lang", "text")))
        codes = [
            np.frombuffer(hashes.as_py(), np.uint32).astype(np.uint64) | np.uint64(bucket.as_py() << 32)
            for bucket, hashes in zip(notes["bucket"], notes["hashes"], strict=True)
        ]
        known = np.sort(np.concatenate([np.zeros(0, np.uint64), *codes]))
        return pa.Table.from_batches([_count(part, known, buckets, filtered, most)])

    return windows


def _count(part: _Slice, known: np.ndarray, buckets: int, filtered: int, most: int) -> pa.RecordBatch:
    """The windows of a slice, cut, each with its number."""

    def often(hashes: np.ndarray) -> np.ndarray:
        codes = (_bucket(hashes, buckets) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))
        at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
        return known[at] == codes if len(known) else np.zeros(len(codes), dtype=bool)

    length = np.zeros(len(part.hashes), dtype=np.int64)
    for n in range(1, most + 1):
        reached = length >= n - 1
        if n <= filtered:
            at, hashes = part.phrases(n)
            fits = np.zeros(len(length), dtype=bool)
            fits[at] = often(hashes)
        else:  # both shorter windows in it are frequent, and share all words but the outer ones
            fits = np.append(reached[1:], False)
        length[reached & fits] = n
    spelled = _spelled(part.words)
    word = spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    parts = []
    for fewest, upto in ((0, 1), (2, most)):
        at = np.flatnonzero((length >= fewest) & (length <= upto))
        leads = [np.where(length[at] > j, word[np.minimum(at + j, len(word) - 1)], 0) for j in range(upto)]
        first, counts = _tally([part.lang[at], *leads])
        leads = [x[first] for x in leads] + [np.zeros(len(first), np.int64)] * (most - upto)
        parts.append((part.lang[at][first], leads, counts))
    words = pa.concat_arrays([pa.array([""], spelled.dictionary.type), spelled.dictionary]).cast(pa.string())
    columns = [words.take(pa.array(np.concatenate([p[1][j] for p in parts]))) for j in range(most)]
    langs = part.langs.take(pa.array(np.concatenate([p[0] for p in parts])))
    counts = pa.array(np.concatenate([p[2] for p in parts]).astype(np.int64))
    return pa.RecordBatch.from_arrays([langs, *columns, counts], ["lang", *_names(most), "n"])


def _names(most: int) -> list[str]:
    return [f"w{j + 1}" for j in range(most)]


def count_phrases(
    documents: DataFrame, most: int = MOST, least: int = LEAST, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(lang, phrase, words, f): phrases of up to `most` words met `least` times, words joined by
    one space; words = 0 has the number of all words of the language."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "phrases")
    texts = documents.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    dealt = scratch.keep(texts.mapInArrow(_deal, "slice long, lang string, text string"), "slices")
    size = dealt.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, filtered = max(1, size // BUCKET_BYTES), min(FILTERED, most)
    sent = dealt.mapInArrow(_send(buckets, filtered, least), "bucket long, slice long, hashes binary, counts binary")
    notes = sent.groupBy("bucket").applyInArrow(_frequent(least), "slice long, bucket long, hashes binary")
    names = _names(most)
    schema = ", ".join(["lang string", *(f"{w} string" for w in names), "n long"])
    windows = dealt.groupBy("slice").cogroup(notes.groupBy("slice")).applyInArrow(_windows(buckets, filtered, most), schema)
    counted = windows.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    summed = counted.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    words = F.lit(most) - F.bit_count("level")
    last = F.coalesce(*(F.col(w) for w in reversed(names)), F.lit("."))  # the last column not summed over
    found = summed.where(F.col("lang").isNotNull() & (last != "") & ((F.col("f") >= least) | (words == 0)))
    return scratch.keep(
        found.select("lang", F.concat_ws(" ", *names).alias("phrase"), words.cast("int").alias("words"), "f"), "phrases"
    )


def mine_collocations(
    documents: DataFrame,
    most: int = MOST,
    least: int = LEAST,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    phrases = count_phrases(documents, most, least, text_col, lang_col)
    candidates = phrases.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    split = F.split("phrase", " ")
    cut = lambda k: F.struct(
        k.cast("int").alias("k"),
        F.array_join(F.slice(split, F.lit(1), k.cast("int")), " ").alias("left"),
        F.array_join(F.slice(split, (k + 1).cast("int"), (F.col("words") - k).cast("int")), " ").alias("right"),
    )
    cuts = candidates.select(
        "lang", "phrase", "a", F.inline(F.transform(F.sequence(F.lit(1), F.col("words") - 1), cut))
    )
    parts = lambda side, name: phrases.where("words >= 1").select(
        F.col("lang"), F.col("phrase").alias(side), F.col("f").alias(name)
    )
    scored = cuts.join(parts("left", "l"), ["lang", "left"]).join(parts("right", "r"), ["lang", "right"])
    wide = lambda c: f"cast({c} as decimal(20, 0))"
    scored = scored.withColumn("score", F.expr(f"(cast(2000000 as decimal(7, 0)) * {wide('a')}) div ({wide('l')} + {wide('r')})"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = lambda size, at: F.array_join(F.slice(split, at, size), " ")
    within = candidates.where("words > 2").select(
        "lang",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("words") - 1),
                    lambda size: F.transform(
                        F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: inner(size.cast("int"), at.cast("int"))
                    ),
                )
            )
        ).alias("phrase"),
        F.col("a").alias("longer"),
    )
    longest = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(longest, ["lang", "phrase"], "left").where(
        F.expr(f"longer is null or 100 * {wide('longer')} < 80 * {wide('a')}")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
