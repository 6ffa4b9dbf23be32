"""Substring dedup: words within a passage that also starts in a document with a smaller id go.

Level-wise doubling. A window of `window` words can be repeated only if the shorter windows in
it are. So lengths start at `shortest` words and double, the last one cut to `window` (4, 8, 13),
and only windows that are repeated at one length are looked at with the next, until none is left:

1. At each length, a candidate window is represented by the part of that length with the smallest
   hash in it (the first of equals), so equal windows have equal parts. Parts that occur in one
   document only rule out all windows they represent.
2. At the last length the windows themselves are compared: a window is a repeat if a document with
   a smaller id has it.

Texts are dealt once into groups of about `BUCKET_BYTES`, and all levels read that one exchange.
At each level a group asks with the hashes of its different parts, each once, dealt out by all
their bits, and gets back one bit for each; which windows are still candidates travels along as
one bit a word. So a passage found in any share of the corpus costs each group one hash, nothing is
dealt by a part of a longer passage, and no pair of documents is ever formed. Early levels need one
64-bit hash, as a wrong match there costs a look only; the last one decides by two together.

Nulls: a null text has no words; a document with a null id keeps its text and does not count as
holding a passage. Repeated rows (same id and text) are equal, not smaller than one another,
treated alike and dealt to one group. Empty tables give empty results, columns other than id and
text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.words import column, covered, find_words, gram_starts, grams, mix, slices, text_bytes

WINDOW = 13
SHORTEST = 4
#: Text of a group, which one task holds.
BUCKET_BYTES = 1 << 23
_AT_ONCE = 100_000

#: ASK: hashes from `sender` to `bucket`. ANSWER: a bit for each of them, the other way. STATE: a
#: group's candidate windows, `windows` of them, from it to itself.
_MESSAGE = "bucket int, sender int, kind int, windows long, payload binary"
_ASK, _ANSWER, _STATE = 0, 1, 2


def lengths(window: int = WINDOW, shortest: int = SHORTEST) -> list[int]:
    """The lengths of the levels."""
    out = [min(shortest, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _messages(rows: list[tuple[int, int, int, int, bytes]]) -> pa.Table:
    names = ["bucket", "sender", "kind", "windows", "payload"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _received(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    part = table.filter(pc.equal(table.column("kind"), kind))
    return list(zip(part.column("sender").to_pylist(), part.column("payload").to_pylist(), strict=True))


class _Texts:
    """Word hashes of a group's texts, in an order that does not depend on that of the rows."""

    def __init__(self, table: pa.Table) -> None:
        rows, docs, marks, counts, hashes = [], [], [], [], []
        at = 0
        for part in slices(table.to_batches()):
            usable = pc.and_(column(part, "doc_id").is_valid(), column(part, "text").is_valid())
            rows.append(at + np.flatnonzero(usable.to_numpy(zero_copy_only=False)))
            at += part.num_rows
            part = part.filter(usable)
            docs.append(np.asarray(column(part, "doc_id")))
            words = find_words(column(part, "text"))
            counts.append(words.counts)
            hashes.append(words.hashes())
            data, offsets = text_bytes(column(part, "text"))
            marks.append(
                np.array([xxhash.xxh3_64_intdigest(data[a:b].data) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint64)
            )

        def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
            return np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)

        docs, counts = joined(docs, np.int64), joined(counts, np.int64)
        order = np.lexsort((joined(marks, np.uint64), docs))
        begin = (np.cumsum(counts) - counts)[order]
        self.rows, self.docs, counts = joined(rows, np.int64)[order], docs[order], counts[order]
        self.first = np.concatenate([[0], np.cumsum(counts)])
        index = np.repeat(begin - self.first[:-1], counts) + np.arange(self.first[-1])
        self.hashes = joined(hashes, np.uint64)[index]

    def all_windows(self, window: int) -> np.ndarray:
        return gram_starts(self.first, window, len(self.hashes))


class _Level:
    """The different parts of one length that represent a group's candidate windows."""

    def __init__(self, texts: _Texts, candidates: np.ndarray, window: int, length: int, buckets: int) -> None:
        self.starts = starts = np.flatnonzero(candidates)
        small = grams(texts.hashes, length, 11 + length)
        place = starts
        if length < window and len(starts):
            within = sliding_window_view(small, window - length + 1)
            pieces = [starts[i : i + _AT_ONCE] for i in range(0, len(starts), _AT_ONCE)]
            place = np.concatenate([within[piece].argmin(axis=1) + piece for piece in pieces])
        new = np.ones(len(place), dtype=bool)
        new[1:] = place[1:] != place[:-1]
        at = place[new]
        self.last = length == window
        key, same = small[at], grams(texts.hashes, length, 53)[at] if self.last else np.zeros(len(at), np.uint64)
        doc = texts.docs[np.searchsorted(texts.first, at, side="right") - 1]
        # Documents ascend, and stay so among equal parts.
        order = np.lexsort((same, key))
        key, same, sorted_doc = key[order], same[order], doc[order]
        edge = np.ones(len(order), dtype=bool)
        edge[1:] = (key[1:] != key[:-1]) | (same[1:] != same[:-1])
        firsts = np.flatnonzero(edge)
        part = np.empty(len(order), dtype=np.int64)
        part[order] = np.cumsum(edge) - 1
        run = np.cumsum(new) - 1
        self.part, self.doc = part[run], doc[run]
        self.key, self.same, self.low = key[firsts], same[firsts], sorted_doc[firsts]
        self.high = sorted_doc[np.append(firsts[1:], len(order))[: len(firsts)] - 1]
        bucket = (mix(self.key, 99) % np.uint64(buckets)).astype(np.int64)
        self.dealt = np.argsort(bucket, kind="stable")
        bucket = bucket[self.dealt]
        self.to, begin = np.unique(bucket, return_index=True)
        self.begin = np.append(begin, len(bucket))

    def asks(self) -> Iterator[tuple[int, bytes]]:
        for i, bucket in enumerate(self.to.tolist()):
            mine = self.dealt[self.begin[i] : self.begin[i + 1]]
            payload = self.key[mine].tobytes()
            if self.last:
                # Bytes of equal weight together, as the high ones are mostly zero.
                planes = self.low[mine].view(np.uint8).reshape(-1, 8).T
                payload += self.same[mine].tobytes() + np.ascontiguousarray(planes).tobytes()
            yield bucket, payload

    def confirmed(self, noted: pa.Table) -> np.ndarray:
        """Which windows, of those in `starts`, are repeated as far as this level tells."""
        elsewhere = np.zeros(len(self.key), dtype=bool)
        answers = dict(_received(noted, _ANSWER))
        for i, bucket in enumerate(self.to.tolist()):
            mine = self.dealt[self.begin[i] : self.begin[i + 1]]
            elsewhere[mine] = np.unpackbits(np.frombuffer(answers[bucket], np.uint8), count=len(mine)).astype(bool)
        if self.last:
            return elsewhere[self.part] | (self.doc > self.low[self.part])
        return (elsewhere | (self.low < self.high))[self.part]


def _state(texts: _Texts, noted: pa.Table, window: int) -> np.ndarray:
    bits = _received(noted, _STATE)
    if not bits:
        return texts.all_windows(window)
    return np.unpackbits(np.frombuffer(bits[0][1], np.uint8), count=len(texts.hashes)).astype(bool)


def _outcome(texts: _Texts, noted: pa.Table, window: int, length: int, buckets: int) -> np.ndarray:
    """The windows that the level of `length`, whose answers `noted` has, leaves."""
    candidates = _state(texts, noted, window)
    level = _Level(texts, candidates, window, length, buckets)
    candidates[level.starts] = level.confirmed(noted)
    return candidates


def _asked(own: int, texts: _Texts, candidates: np.ndarray, window: int, length: int, buckets: int) -> pa.Table:
    level = _Level(texts, candidates, window, length, buckets)
    rows = [(bucket, own, _ASK, 0, payload) for bucket, payload in level.asks()]
    rows.append((own, own, _STATE, len(level.starts), np.packbits(candidates).tobytes()))
    return _messages(rows)


def _start(window: int, length: int, buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        texts = _Texts(table)
        return _asked(key[0].as_py(), texts, texts.all_windows(window), window, length, buckets)

    return run


def _extend(window: int, length: int, longer: int, buckets: int):
    """From the answers at one length to the questions at the next."""

    def run(key: tuple, table: pa.Table, noted: pa.Table) -> pa.Table:
        texts = _Texts(table)
        left = _outcome(texts, noted, window, length, buckets)
        return _asked(key[0].as_py(), texts, left, window, longer, buckets)

    return run


def _meet(last: bool):
    """Where equal parts meet: for each whether another group has it, at the last level whether
    one has it in a document with a smaller id."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        own = key[0].as_py()
        state = table.filter(pc.equal(table.column("kind"), _STATE))
        asks = _received(table, _ASK)
        if not asks:
            return state
        width = 24 if last else 8
        counts = [len(payload) // width for _, payload in asks]
        keys = np.concatenate([np.frombuffer(p, np.uint64, n) for (_, p), n in zip(asks, counts, strict=True)])
        if last:
            same = np.concatenate([np.frombuffer(p, np.uint64, n, 8 * n) for (_, p), n in zip(asks, counts, strict=True)])
            planes = [np.frombuffer(p, np.uint8, 8 * n, 16 * n).reshape(8, n) for (_, p), n in zip(asks, counts, strict=True)]
            docs = np.ascontiguousarray(np.concatenate(planes, axis=1).T).view(np.int64).ravel()
            order = np.lexsort((docs, same, keys))
            equal = (keys[order][1:] == keys[order][:-1]) & (same[order][1:] == same[order][:-1])
        else:
            order = np.argsort(keys, kind="stable")
            equal = keys[order][1:] == keys[order][:-1]
        found = np.zeros(len(keys), dtype=bool)
        if last:
            firsts = np.flatnonzero(np.append(True, ~equal))
            least = np.repeat(docs[order][firsts], np.diff(np.append(firsts, len(order))))
            found[order] = least < docs[order]
        else:
            found[order[1:][equal]] = True
            found[order[:-1][equal]] = True
        ends = np.cumsum(counts).tolist()
        rows = [
            (sender, own, _ANSWER, 0, np.packbits(found[end - n : end]).tobytes())
            for (sender, _), n, end in zip(asks, counts, ends, strict=True)
        ]
        return pa.concat_tables([state, _messages(rows)])

    return run


def _kept(window: int, buckets: int):
    def run(key: tuple, table: pa.Table, noted: pa.Table) -> pa.Table:
        texts = _Texts(table)
        repeats = np.flatnonzero(_outcome(texts, noted, window, window, buckets))
        gone = covered(repeats, window, len(texts.hashes))
        spans = {
            row: (a, b)
            for row, a, b in zip(texts.rows.tolist(), texts.first[:-1].tolist(), texts.first[1:].tolist(), strict=True)
        }
        n_words, n_removed, left = [], [], []
        for row, text in enumerate(table.column("text")):
            words = (text.as_py() or "").encode().split()
            n_words.append(len(words))
            if row in spans:
                off = gone[spans[row][0] : spans[row][1]]
                if off.any():
                    words = [w for w, g in zip(words, off.tolist(), strict=True) if not g]
            n_removed.append(n_words[-1] - len(words))
            left.append(b" ".join(words))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
                "kept_text": pa.array(left, pa.binary()).cast(pa.string()),
            }
        )

    return run


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _dealt(documents: DataFrame, buckets: int | None, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if buckets is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(1, -(-size // BUCKET_BYTES))
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")
    return texts.select(bucket.alias("bucket"), "doc_id", "text"), buckets


def _levels(dealt: DataFrame, buckets: int, window: int, shortest: int) -> tuple[list[DataFrame], DataFrame]:
    """What each level asks, and the answers to the last."""
    steps = lengths(window, shortest)
    asked = [dealt.groupBy("bucket").applyInArrow(_start(window, steps[0], buckets), _MESSAGE)]
    for length, longer in zip(steps, steps[1:], strict=False):
        answers = asked[-1].groupBy("bucket").applyInArrow(_meet(False), _MESSAGE)
        both = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket"))
        asked.append(both.applyInArrow(_extend(window, length, longer, buckets), _MESSAGE))
    return asked, asked[-1].groupBy("bucket").applyInArrow(_meet(True), _MESSAGE)


def candidate_windows(
    documents: DataFrame,
    window: int = WINDOW,
    shortest: int = SHORTEST,
    buckets: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(length, windows): how many windows each level looks at."""
    dealt, count = _dealt(documents, buckets, id_col, text_col)
    asked, _ = _levels(dealt, count, window, shortest)
    out = None
    for length, frame in zip(lengths(window, shortest), asked, strict=True):
        states = frame.where(F.col("kind") == _STATE)
        row = states.agg(F.lit(length).alias("length"), F.coalesce(F.sum("windows"), F.lit(0)).alias("windows"))
        out = row if out is None else out.union(row)
    return out


def remove_repeats(
    documents: DataFrame,
    window: int = WINDOW,
    shortest: int = SHORTEST,
    buckets: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a document: its words, how many of them go, and the text that is left (words
    joined by a space) with its digest. `buckets` defaults to as many groups as hold `BUCKET_BYTES`
    of text each. A group asks each other one in one row, so rows grow with the square of `buckets`
    as long as groups are few, and never beyond one for each different part."""
    dealt, count = _dealt(documents, buckets, id_col, text_col)
    _, answers = _levels(dealt, count, window, shortest)
    both = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket"))
    return both.applyInArrow(_kept(window, count), KEPT)
