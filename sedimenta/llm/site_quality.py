"""Document quality by hierarchical empirical Bayes: what the text says, and where it stands.

A logistic regression on the hashed words, word beginnings and word shapes that a text has,
fitted on at most `sample` labelled documents (those with the smallest hash of their id, spread
over all), gives each document's evidence, a log likelihood ratio. Features that good and bad
documents have about equally often are left out, and each is scaled by its log ratio in the two,
so a few telling words count alike in a short and in a long text. Host and path within host have posteriors from all labels:
counts of good and labelled documents, by grouped aggregation, where a host is shrunk towards
the global share and a path towards its host. How strongly is estimated from the spread of
hosts, and of paths within hosts, beyond what chance explains (method of moments). A site
without labels has its parent's value. Evidence and the path's posterior odds add up, and a
document is kept if the result is at least `threshold`.

Good is what the caller's label column says (true, false; null: not labelled). Sources stand
for hosts and languages for paths where documents carry no address.

Nulls: a null or empty text has no evidence (0); a null host or path is a site like others; a
null id matches no label. Repeated rows are judged alike, repeated labels each count. Without
usable labels of both kinds, evidence is 0 and all sites have the share 1/2. An empty table gives
an empty result. Other columns are not read. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.scratch import Scratch
from sedimenta.llm.words import FOLD, Words, column, find_words, mix, slices

BITS = 20
SAMPLE = 8_000
PREFIXES = (4, 5)
_SHAPES = 256
_WIDTH = (1 << BITS) + _SHAPES

_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_CAPITAL = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_MARK = np.array([b in b"#*$%&|<>" for b in range(256)])


def _share(flags: np.ndarray, words: Words) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags[words.data], dtype=np.int64)])
    return sums[words.end] - sums[words.start]


def _numbered(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """For each word the numbers of its features, one row a kind: its folded letters, its shape,
    and its first bytes (-1 where it is no longer than they are)."""
    words = find_words(texts)
    if not len(words):
        return words, np.zeros((2 + len(PREFIXES), 0), dtype=np.int64)
    length = words.end - words.start
    capital, letters = _share(_CAPITAL, words), _share(_LETTER, words)
    last = words.data[words.end - 1]
    plain = words.hashes()
    same = np.zeros(len(words), dtype=bool)
    same[1:] = plain[1:] == plain[:-1]
    shape = (
        (capital > 0).astype(np.int64)
        + 2 * ((capital > 1) & (2 * capital > length))
        + 4 * (_share(_DIGIT, words) > 0)
        + 8 * (_share(_MARK, words) > 0)
        + 16 * (letters == 0)
        + 32 * (last == ord("!"))
        + 64 * (last == ord("."))
        + 128 * same
    )
    # Closing marks do not make another word.
    end = words.end.copy()
    for _ in range(3):
        end -= ((end - words.start) > 1) & ~(_LETTER[words.data[end - 1]] | _DIGIT[words.data[end - 1]])
    folded = FOLD[words.data]
    kinds = [_numbered(Words(folded, words.start, end, words.first).hashes()), (1 << BITS) + shape]
    for size in PREFIXES:
        first_bytes = Words(folded, words.start, np.minimum(words.start + size, end), words.first)
        kinds.append(np.where(end - words.start > size, _numbered(mix(first_bytes.hashes(), size)), -1))
    return words, np.stack(kinds)


def _rows(texts: pa.Array) -> Iterator[np.ndarray]:
    """The numbers of the features that each text has."""
    words, kinds = features(texts)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        found = np.unique(kinds[:, a:b])
        yield found[found >= 0]


def log_ratios(in_good: np.ndarray, in_bad: np.ndarray, n_good: int, n_bad: int, least: int = 3, chi: float = 15.0) -> np.ndarray:
    """How much more often good texts have a feature, as a smoothed log ratio; 0 for features of
    fewer than `least` texts and those whose chi-square, corrected for continuity, is below `chi`."""
    if not n_good or not n_bad:
        return np.zeros(len(in_good))
    found, share = in_good + in_bad, n_good / (n_good + n_bad)
    apart = np.maximum(np.abs(in_good - found * share) - 0.5, 0)
    telling = apart * apart >= chi * found * share * (1 - share)
    ratio = np.log((in_good + 1) / (n_good + 2)) - np.log((in_bad + 1) / (n_bad + 2))
    return np.where((found >= least) & telling, ratio, 0.0)


def fit(rows: list[np.ndarray], good: np.ndarray, ratios: np.ndarray, penalty: float = 1.0, steps: int = 150) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam over all rows; a row lists the features a text has, as places
    in `ratios`, and a feature's value is its ratio. Returns what each feature and what every
    text adds to the log likelihood ratio of good."""
    share = good.mean() if len(good) else 0.5
    if not len(ratios) or not 0 < share < 1:
        return np.zeros(len(ratios)), 0.0
    place = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value, width = ratios[place], len(ratios)
    prior = float(np.log(share / (1 - share)))
    # The last parameter is the bias, which has no penalty.
    now, mean, spread = np.append(np.zeros(width), prior), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        odds = np.bincount(row, value * now[place], minlength=len(rows)) + now[-1]
        error = (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - good) / len(rows)
        slope = np.append(np.bincount(place, value * error[row], minlength=width) + penalty / len(rows) * now[:-1], error.sum())
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope * slope
        now -= 0.1 * mean / (1 - 0.9**step) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return now[:-1] * ratios, float(now[-1] - prior)


def _places(chosen: np.ndarray) -> np.ndarray:
    """A feature number's place among the chosen ones; -1 for all others (and for number -1)."""
    table = np.full(_WIDTH + 1, -1, dtype=np.int64)
    table[chosen] = np.arange(len(chosen))
    return table


def _evidence(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, weights, bias = shared.value
        table = _places(chosen)
        for part in slices(batches):
            words, kinds = features(column(part, "text"))
            place = table[kinds]
            kind, word = np.nonzero(place >= 0)
            width = max(len(weights), 1)
            pairs = np.unique(words.row[word] * width + place[kind, word])
            odds = np.bincount(pairs // width, weights[pairs % width], minlength=part.num_rows)
            odds = np.where(words.counts > 0, odds + bias, 0.0)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "host"), column(part, "path"), pa.array(odds, pa.float64())],
                names=["doc_id", "host", "path", "evidence"],
            )

    return run


def learn(packed: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """The chosen features' numbers, their weights and the bias, from rows (good, number). Read
    row by row, first to choose features, then to keep these alone: the driver holds two counts
    a feature number and the chosen features of the sample."""
    counts, n = np.zeros((2, _WIDTH)), [0, 0]
    for r in packed.toLocalIterator():
        counts[r["good"], np.frombuffer(r["number"], "<i4")] += 1
        n[r["good"]] += 1
    ratios = log_ratios(counts[1], counts[0], n[1], n[0])
    chosen = np.flatnonzero(ratios)
    table, rows, answers = _places(chosen), [], []
    for r in packed.toLocalIterator() if len(chosen) else ():
        place = table[np.frombuffer(r["number"], "<i4")]
        rows.append(place[place >= 0])
        answers.append(r["good"])
    weights, bias = fit(rows, np.array(answers, dtype=float), ratios[chosen])
    return chosen, weights, bias


def _strength(sites: DataFrame, parent) -> float:
    """How many labels a parent's share is worth: from the spread of `good / n` around it."""
    spread = F.col("n") * F.pow(F.col("good") / F.col("n") - parent, 2)
    chance = parent * (1 - parent)
    row = sites.agg(
        F.sum("n").alias("n"), F.sum(spread).alias("spread"), F.sum(chance).alias("chance"), F.sum(F.col("n") * chance).alias("within")
    ).first()
    if not row["n"] or not row["within"]:
        return 1.0
    between = (row["spread"] - row["chance"]) / row["n"]
    return float(min(max(row["within"] / row["n"] / max(between, 1e-9) - 1, 1.0), 1e6))


def judge_quality(
    documents: DataFrame,
    labels: DataFrame,
    good: str = "good",
    threshold: float = 0.5,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    host_col: str = "source",
    path_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """One row a document: doc_id, evidence, host_share, site_share, quality, kept. `labels` has
    the id and a boolean column `good`."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "quality")
    source = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.col(path_col).cast("string").alias("path"),
        F.col(text_col).alias("text"),
    )
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(good).cast("int").alias("good")).where(
        F.col("doc_id").isNotNull() & F.col("good").isNotNull()
    )
    chosen = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(sample))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = list(_rows(column(part, "text")))
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"),
                    column(part, "good"),
                    pa.array([r.astype("<i4").tobytes() for r in rows], pa.binary()),
                ],
                names=["doc_id", "good", "number"],
            )

    drawn = source.join(chosen, "doc_id").select("doc_id", "good", "text")
    packed = drawn.mapInArrow(pack, "doc_id long, good int, number binary").orderBy("doc_id", "good", "number").limit(2 * sample)
    model = spark.sparkContext.broadcast(learn(scratch.keep(packed, "sample")))

    labelled = source.select("doc_id", "host", "path").join(known, "doc_id")
    paths = scratch.keep(labelled.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    share = (total["good"] + 0.5) / (total["n"] + 1) if total["n"] else 0.5
    by_host = _strength(hosts, F.lit(share))
    host_share = ((F.col("good") + by_host * share) / (F.col("n") + by_host)).alias("host_share")
    hosts = scratch.keep(hosts.select(F.col("host").alias("__host"), host_share), "hosts")
    inner = paths.join(hosts, F.col("host").eqNullSafe(F.col("__host"))).drop("__host")
    by_path = _strength(inner, F.col("host_share"))
    site_share = ((F.col("good") + by_path * F.col("host_share")) / (F.col("n") + by_path)).alias("site_share")
    sites = scratch.keep(
        inner.select(F.col("host").alias("__site"), F.col("path").alias("__path"), site_share), "sites"
    )

    judged = source.mapInArrow(_evidence(model), "doc_id long, host string, path string, evidence double")
    placed = judged.join(hosts, F.col("host").eqNullSafe(F.col("__host")), "left").join(
        sites, F.col("host").eqNullSafe(F.col("__site")) & F.col("path").eqNullSafe(F.col("__path")), "left"
    )
    of_host = F.coalesce("host_share", F.lit(share))
    of_site = F.coalesce("site_share", of_host)
    odds = F.col("evidence") + F.log(F.col("site_share") / (1 - F.col("site_share")))
    return (
        placed.select("doc_id", "evidence", of_host.alias("host_share"), of_site.alias("site_share"))
        .withColumn("quality", 1 / (1 + F.exp(-odds)))
        .withColumn("kept", F.col("quality") >= threshold)
    )
