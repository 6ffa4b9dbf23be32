"""Words of Arrow text columns, found and hashed in whole slices instead of word by word.

A word is a longest run of bytes outside a set of ASCII separators, so a character of several
bytes always belongs to a word. Hashes are 64 bits wide; where a wrong match would change a
result, callers compare two independent hashes or the words themselves.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20
#: What workers keep between tasks of one kind; tasks of another kind empty these.
CACHES: list[dict] = []
LONG_WORD = 64


def _inside(separators: Iterable[int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


BLANKS = (0x20, *range(0x09, 0x0E))
#: Everything in ASCII but digits and small letters.
SYMBOLS = (*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))
INSIDE_BLANKS = _inside(BLANKS)
INSIDE_SYMBOLS = _inside(SYMBOLS)
FOLD = _fold()

_BYTE_VALUES = np.random.default_rng(20_011).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < count:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(count, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that leaves no visible order."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Words:
    """Words of consecutive texts: byte spans in `data`, and the first word of each text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """One 64-bit hash a word: a polynomial of its bytes, by differences of running sums; of a
        word of more than `LONG_WORD` bytes its XXH3."""
        out = np.empty(len(self), dtype=np.uint64)
        at = 0
        while at < len(self):
            base = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, base + SLICE_BYTES, side="right")))
            size = int(self.end[to - 1] - base)
            if size <= SLICE_BYTES:  # else one word, hashed below
                up, down = _powers(SLICE_BYTES)
                sums = np.zeros(size + 1, dtype=np.uint64)
                np.cumsum(_BYTE_VALUES[self.data[base : base + size]] * up[:size], out=sums[1:])
                starts, ends = self.start[at:to] - base, self.end[at:to] - base
                out[at:to] = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)
            at = to
        # There are long words that no odd base tells apart.
        for i in np.flatnonzero(self.end - self.start > LONG_WORD).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.word(i))
        return mix(out)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offsets of each; a null is an empty text."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def find_words(texts: pa.Array, inside: np.ndarray = INSIDE_BLANKS, fold: bool = False) -> Words:
    data, offsets = text_bytes(texts)
    if fold:
        data = FOLD[data]
    within = inside[data]
    begins, stops = within.copy(), within.copy()
    begins[1:] &= ~within[:-1]
    stops[:-1] &= ~within[1:]
    borders = offsets[1:-1]
    after = borders[borders < len(data)]
    begins[after] = within[after]
    before = borders[borders > 0] - 1
    stops[before] = within[before]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(stops) + 1, np.searchsorted(start, offsets))


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about `most` bytes of text, at least one row each."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def release_memory(caches: bool = True) -> None:
    """Give back what this worker has freed, which the allocators keep otherwise."""
    if caches:
        for cache in CACHES:
            cache.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def lean(run: Callable, caches: bool = True) -> Callable:
    """`run` over the batches of a task, with memory given back at its end: workers are used again."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory(caches)

    return task


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def grams(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of each `length` consecutive words, borders of texts not minded."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for j, factor in enumerate(multipliers(length, seed)):
        out += hashes[j : j + count] * factor
    return mix(out, seed)


def gram_starts(first: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of the `total` word positions start `length` words of one text."""
    ok = np.zeros(total + 1, dtype=np.int64)
    counts = np.maximum(np.diff(first) - length + 1, 0)
    np.add.at(ok, first[:-1], (counts > 0).astype(np.int64))
    np.add.at(ok, first[:-1] + counts, -(counts > 0).astype(np.int64))
    return np.cumsum(ok)[:total] > 0


def covered(starts: np.ndarray, lengths: np.ndarray | int, total: int) -> np.ndarray:
    """Positions 0..total-1 that lie in any of the spans."""
    marks = np.zeros(total + 1, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + lengths, -1)
    return np.cumsum(marks)[:total] > 0
