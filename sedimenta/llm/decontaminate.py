"""Benchmark decontamination: a suffix automaton of all test items reads the documents' words
and tracks how long the latest words match.

Words are longest runs of digits, small letters and non-ASCII characters once A-Z are lowered.
A window is `window` consecutive words of an item; an item of fewer words, but not none, is one
window as a whole. A document word within any occurrence of a window is hit.

The items are read on the driver, as a query set, in blocks of at most `block_words` words; a
longer item is cut into pieces that overlap by `window` - 1 words, so that each of its windows is
whole in one of them. Each block is an automaton and goes to the executors as one broadcast of that
bounded size; the driver holds one at a time. The documents pass up to BLOCKS_AT_ONCE blocks one
after another in the same tasks: map only, no shuffle. With more blocks they are written in
between, and the blocks behind them are dropped. Before the automaton walks, a table of the items'
word triples passes over text that cannot match; it never hides a match.

Nulls: a null text has no words; an item without text or words has no windows; an item without
an id is left out; a null document id stays null. Repeated rows are treated alike, each item id
counts once. Empty documents give an empty result, an empty benchmark hits nothing. Other
columns, whatever their names, are carried along or ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.scratch import Scratch
from sedimenta.llm.words import FOLD, INSIDE_SYMBOLS, Words, column, find_words, grams, slices

BLOCKS_AT_ONCE = 4
_ITEM_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class SuffixAutomaton:
    """All substrings of several word sequences, one state for each set of end positions."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items if words]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        self.shortest = min((min(len(c), window) for _, c in coded), default=window)
        self.whole: dict[int, list[tuple[int, set[str]]]] = {}
        self.owners: dict[int, set[str]] = {}
        for name, codes in coded:
            if len(codes) < window:
                self._own_whole(name, codes)
            else:
                for _, state, length in self.walk(codes):
                    if length >= window:
                        self.owners.setdefault(self.at_window(state), set()).add(name)
        self._flagged_above()
        self.triple = min(3, self.shortest)
        words = Words(*_packed([w for _, ws in items for w in ws], [len(ws) for _, ws in items]))
        known = grams(words.hashes(), self.triple, 5)
        inner = np.concatenate(
            [np.arange(a, max(a, b - self.triple + 1)) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
            or [np.zeros(0, dtype=np.int64)]
        )
        self.known = np.unique(known[inner.astype(np.int64)]) if len(known) else known

    def _extend(self, last: int, code: int) -> int:
        if code in self.next[last]:
            q = self.next[last][code]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, code, q)
        state = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and code not in self.next[p]:
            self.next[p][code] = state
            p = self.link[p]
        if p < 0:
            self.link[state] = 0
        else:
            q = self.next[p][code]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, code, q)
        return state

    def _split(self, p: int, code: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(code) == q:
            self.next[p][code] = clone
            p = self.link[p]
        return clone

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def walk(self, codes: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """After each word: its place, the state, and how many of the latest words match."""
        state = matched = 0
        for i, code in enumerate(codes):
            while state and code not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            to = self.next[state].get(code)
            if to is not None:
                state, matched = to, matched + 1
            yield i, state, matched

    def at_window(self, state: int) -> int:
        """The state of the last `window` words only."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _own_whole(self, name: str, codes: list[int]) -> None:
        *_, (_, state, _) = self.walk(codes)
        known = self.whole.setdefault(state, [])
        for length, names in known:
            if length == len(codes):
                names.add(name)
                return
        known.append((len(codes), {name}))

    def _flagged_above(self) -> None:
        """For each state, the nearest state at or above it that is a whole short item."""
        self.above = [-1] * len(self.next)
        if self.whole:
            for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                self.above[state] = state if state in self.whole else self.above[self.link[state]]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of `words` that are windows, and the items that own them."""
        spans, items = [], set()
        for i, state, matched in self.walk([self.ids.get(w, -1) for w in words]):
            if matched >= self.window:
                owners = self.owners.get(self.at_window(state))
                if owners:
                    spans.append((i + 1 - self.window, i + 1))
                    items |= owners
            flagged = self.above[state] if matched else -1
            while flagged > 0:
                for length, names in self.whole[flagged]:
                    if length <= matched:
                        spans.append((i + 1 - length, i + 1))
                        items |= names
                flagged = self.above[self.link[flagged]]
        return spans, items

    def search(self, words: Words) -> dict[int, tuple[np.ndarray, set[str]]]:
        """For each text with hits: its hit words, counted from the text's first, and items."""
        if not len(self.known) or len(words) < self.triple:
            return {}
        found = grams(words.hashes(), self.triple, 5)
        at = np.searchsorted(self.known, found)
        at[at == len(self.known)] = 0
        likely = np.concatenate([[False], self.known[at] == found, [False]])
        edges = np.flatnonzero(likely[1:] != likely[:-1])
        out: dict[int, tuple[set[int], set[str]]] = {}
        for a, b in zip(edges[::2], edges[1::2] + self.triple - 1, strict=True):
            if b - a < self.shortest:
                continue
            row = int(np.searchsorted(words.first, a, side="right")) - 1
            while a < b:  # a run can reach into the texts that follow
                to = min(b, words.first[row + 1])
                spans, items = self.hits([words.word(i) for i in range(a, to)])
                if spans:
                    places, names = out.setdefault(row, (set(), set()))
                    names |= items
                    for s, e in spans:
                        places.update(range(a - words.first[row] + s, a - words.first[row] + e))
                a, row = to, row + 1
        return {row: (np.array(sorted(p), dtype=np.int64), names) for row, (p, names) in out.items()}


def _packed(words: list[bytes], counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64) if words else np.zeros(0, dtype=np.int64)
    starts = ends - np.array([len(w) for w in words], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]) if counts else np.zeros(1, dtype=np.int64)
    return np.frombuffer(b"".join(words), dtype=np.uint8), starts, ends, first


def item_words(text: str) -> list[bytes]:
    folded = FOLD[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes() if text else b""
    return _ITEM_WORD.findall(folded)


def automata(benchmark: DataFrame, window: int, block_words: int, id_col: str, text_col: str) -> Iterator[SuffixAutomaton]:
    """The test items in blocks, read through the driver one partition at a time."""
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).where(
        F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    )
    most = max(block_words, window)
    block, size = [], 0
    for name, text in rows.toLocalIterator():
        for words in _pieces(item_words(text), most, window):
            if block and size + len(words) > most:
                yield SuffixAutomaton(block, window)
                block, size = [], 0
            block.append((name, words))
            size += len(words)
    if block:
        yield SuffixAutomaton(block, window)


def _pieces(words: list[bytes], most: int, window: int) -> Iterator[list[bytes]]:
    """The words in pieces of at most `most`; every `window` words in a row are in one of them."""
    if len(words) <= most:
        yield words
        return
    for at in range(0, len(words) - window + 1, most - window + 1):
        yield words[at : at + most]


def _own_names(columns: list[str]) -> tuple[str, str, str]:
    """Names for the columns of words, hits and items that none of `columns` has."""
    taken, end = {c.lower() for c in columns}, ""
    while taken & {f"__words{end}", f"__hits{end}", f"__items{end}"}:
        end += "_"
    return f"__words{end}", f"__hits{end}", f"__items{end}"


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    block_words: int = 500_000,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents and three more columns, the last ones: how many words, the places of the hit
    words (packed as 64-bit numbers) and the ids of the items met (sorted as strings). They are
    named `__words`, `__hits` and `__items`, with underscores after them where a name is in use."""
    spark = documents.sparkSession
    own = _own_names(documents.columns)
    empty = F.lit(0).cast("long"), F.lit(b"").cast("binary"), F.array().cast("array<string>")
    frame = documents.withColumns(dict(zip(own, empty, strict=True)))
    schema, scratch, sent = _nullable(frame.schema), Scratch(spark, "leaks"), []
    for block in automata(benchmark, window, block_words, item_id, item_text):
        if len(sent) == BLOCKS_AT_ONCE:
            frame = scratch.keep(frame, "documents")
            for shared in sent:
                shared.destroy()
            sent = []
        sent.append(spark.sparkContext.broadcast(block))
        frame = frame.mapInArrow(_searcher(sent[-1], text_col, own), schema)
    if not sent:
        frame = frame.mapInArrow(_searcher(spark.sparkContext.broadcast(SuffixAutomaton([], window)), text_col, own), schema)
    return frame


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _searcher(shared, text_col: str, own: tuple[str, str, str]):
    words_col, hits_col, items_col = own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for part in slices(batches, text_col):
            words = find_words(column(part, text_col), INSIDE_SYMBOLS, fold=True)
            hits, items = column(part, hits_col).to_pylist(), column(part, items_col).to_pylist()
            for row, (places, names) in automaton.search(words).items():
                before = np.frombuffer(hits[row], dtype=np.int64)
                hits[row] = np.union1d(before, places).tobytes()
                items[row] = sorted({*items[row], *names})
            values = {
                words_col: pa.array(words.counts, pa.int64()),
                hits_col: pa.array(hits, pa.binary()),
                items_col: pa.array(items, pa.list_(pa.string())),
            }
            for name, value in values.items():
                i = part.schema.get_field_index(name)
                part = part.set_column(i, pa.field(name, value.type), value)
            yield part

    return run


def leak_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Figures for each document of a frame made by `find_leaks`."""
    words, hits, items = found.columns[-3:]
    return found.select(
        F.col(id_col).alias("doc_id"),
        F.col(words).alias("n_words"),
        F.expr(f"cast(octet_length({hits}) div 8 as bigint)").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.octet_length(hits) > 0).alias("contaminated"),
    )


def without_leaks(
    documents: DataFrame, benchmark: DataFrame, max_coverage_percent: int = 50, text_col: str = "text", **search
) -> DataFrame:
    """The documents without the spans that match the benchmark (`n_chars`, where there is
    one, is counted anew). A document hit in over `max_coverage_percent` of its words goes."""

    names = documents.columns
    words_col, hits_col, _ = _own_names(names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            texts, hits = column(part, text_col), column(part, hits_col)
            if pc.max(pc.binary_length(hits)).as_py():
                changed = [
                    _cut(t, np.frombuffer(h, dtype=np.int64)) if h else t
                    for t, h in zip(texts.to_pylist(), hits.to_pylist(), strict=True)
                ]
                at = part.schema.get_field_index(text_col)
                part = part.set_column(at, part.schema.field(at), pa.array(changed, texts.type))
            yield part.select(names)

    found = find_leaks(documents, benchmark, text_col=text_col, **search)
    few = F.octet_length(hits_col) * F.lit(100) <= F.lit(8 * max_coverage_percent) * F.col(words_col)
    kept = found.where(few).mapInArrow(cut, _nullable(documents.schema))
    if "n_chars" in names:
        kept = kept.withColumn("n_chars", F.length(text_col).cast(documents.schema["n_chars"].dataType))
    return kept


def _cut(text: str, places: np.ndarray) -> str:
    words = find_words(pa.array([text]), INSIDE_SYMBOLS, fold=True)
    data, out, at = text.encode(), [], 0
    breaks = np.flatnonzero(np.diff(places) > 1)
    for a, b in zip([0, *(breaks + 1)], [*breaks, len(places) - 1], strict=True):
        out.append(data[at : words.start[places[a]]])
        at = int(words.end[places[b]])
    return (b"".join(out) + data[at:]).decode()
