"""Encoding whole texts with a tokenizer file of the tokenizers library, each part of a slice once.

Byte-level BPE first splits a text into pieces that do not influence one another. A single
space between other characters always starts a piece, and so does a single line feed, which is a
piece of its own, and a mark after a letter or a number. Texts are cut there, the different parts of a slice are found as a dictionary,
and the library sees each once; ids are then gathered for all parts at once. Parts with other
white space in them are encoded as they are, and so are whole texts with a special token's name.
A file with another way of splitting has its texts encoded whole. A worker keeps up to `MOST_KNOWN`
parts as packed arrays, some 30 MB at most, for its next slices.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from sedimenta.llm.words import CACHES, text_bytes

#: Text a caller should hand over at a time: enough for parts to repeat, little for memory.
SLICE_BYTES = 1 << 21
#: Parts a worker keeps, at about 30 bytes each and those of their text, which are bounded too.
MOST_KNOWN = 400_000
MOST_BYTES = 1 << 24
_ENCODERS: dict[str, Encoder] = {}
CACHES.append(_ENCODERS)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(0x09, 0x0E), 0x20]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[0x21:0x7F] = True
_MARK &= ~_LETTER
# Characters of several bytes that are white space, as lead byte and what follows.
_WIDE_BLANKS = {
    0xC2: [b"\x85", b"\xa0"],
    0xE1: [b"\x9a\x80"],
    0xE2: [
        *(bytes([0x80, x]) for x in range(0x80, 0x8B)),
        b"\x80\xa8",
        b"\x80\xa9",
        b"\x80\xaf",
        b"\x81\x9f",
    ],
    0xE3: [b"\x80\x80"],
}


def encoder_for(model: str) -> Encoder:
    """The encoder of a tokenizer file's content; a worker keeps it."""
    key = hashlib.sha256(model.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def _byte_of_symbol() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, others for the
    characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in set(plain))
    return out | {chr(256 + i): b for i, b in enumerate(others)}


def _blanks(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    blank = _BLANK[data]
    for lead, rests in _WIDE_BLANKS.items():
        at = np.flatnonzero(data == lead)
        for rest in rests:
            found = at[at + len(rest) < len(data)]
            for j, x in enumerate(rest, 1):
                found = found[data[found + j] == x]
            for j in range(len(rest) + 1):
                blank[found + j] = True
    return blank


class Encoder:
    """Token ids as little-endian numbers, two or four bytes wide as the vocabulary needs."""

    def __init__(self, model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(model)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.width = 2 if self.size <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.known: pa.Array | None = None
        self.ids, self.starts, self.counts = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)
        feed = self._whole("\n")
        self.feed = feed[0] if len(feed) == 1 else None
        spec = json.loads(model)
        splitter = spec.get("pre_tokenizer") or {}
        self.splits = (
            self.feed is not None
            and spec.get("normalizer") is None
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space", True)
        )

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.kind)

    def _learn(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different parts, where each begins among them, and how many each has."""
        if self.known is None or self.known.type != parts.type:
            ids, starts, counts = self._encode_parts(parts)
        else:
            place = pc.index_in(parts, value_set=self.known)
            missing = pc.is_null(place).to_numpy(zero_copy_only=False)
            place = pc.fill_null(place, 0).to_numpy(zero_copy_only=False)
            fresh = parts.filter(pa.array(missing))
            new_ids, new_starts, new_counts = self._encode_parts(fresh)
            ids = np.concatenate([self.ids, new_ids])
            starts, counts = self.starts[place], self.counts[place]
            starts[missing], counts[missing] = new_starts + len(self.ids), new_counts
            if len(self.known) + len(fresh) <= MOST_KNOWN and self.known.nbytes + fresh.nbytes <= MOST_BYTES:
                self.known = pa.concat_arrays([self.known, fresh])
                self.starts = np.concatenate([self.starts, new_starts + len(self.ids)])
                self.counts = np.concatenate([self.counts, new_counts])
                self.ids = ids
                return ids, starts, counts
        if len(parts) <= MOST_KNOWN and parts.nbytes <= MOST_BYTES:
            # Begin anew with the parts of this slice, which has the common ones among them.
            ends = np.concatenate([[0], np.cumsum(counts)])
            self.ids = ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], counts)]
            self.known, self.starts, self.counts = parts, ends[:-1], counts
        return ids, starts, counts

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, at = text_bytes(parts)
        texts = parts.to_pylist()
        # Plain parts have no white space but a space or a line feed in front.
        blank = _blanks(data)
        inner = np.concatenate([[0], np.cumsum(blank)])
        first = data[at[:-1]]
        ahead = blank[at[:-1]]
        plain = (inner[at[1:]] - inner[at[:-1]] == ahead) & (~ahead | (first == 0x20) | (first == 0x0A))
        plain &= np.diff(at) > ahead
        starts, counts = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        out = []
        which = np.flatnonzero(plain)
        if len(which):
            # One call for all, with a line feed, which is a token of its own, in front of each.
            joined = "".join([t if t[0] == "\n" else "\n" + t for t in (texts[i] for i in which.tolist())])
            ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=self.kind)
            borders = np.flatnonzero(ids == self.feed)
            if len(borders) == len(which):
                starts[which] = borders + (first[which] != 0x0A)
                counts[which] = np.append(borders[1:], len(ids)) - starts[which]
                out.append(ids)
            else:
                plain[:] = False
        size = sum(len(x) for x in out)
        for i in np.flatnonzero(~plain).tolist():
            out.append(self._whole(texts[i]))
            starts[i], counts[i] = size, len(out[-1])
            size += len(out[-1])
        return np.concatenate([np.zeros(0, self.kind), *out]), starts, counts

    def _cuts(self, data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Where parts begin: at each text that is not empty, before each lone space or line feed,
        and before marks that follow a letter or a number."""
        blank = _blanks(data)
        cut = (data == 0x20) | (data == 0x0A)
        cut[1:] &= ~blank[:-1]
        cut[:-1] &= ~blank[1:]
        filled = np.flatnonzero(np.diff(offsets))
        cut[offsets[filled + 1] - 1] = False  # what ends a text has no character after it
        letter = _LETTER[data]
        wide = np.flatnonzero(data[:-1] == 0xC3) + 1  # the letters of Latin-1 but its two signs
        letter[wide[(data[wide] != 0x97) & (data[wide] != 0xB7)]] = True
        cut[1:] |= _MARK[data[1:]] & letter[:-1]
        for name in self.special:
            for i in np.flatnonzero(pc.fill_null(pc.match_substring(texts, name), False).to_numpy(zero_copy_only=False)):
                cut[offsets[i] : offsets[i + 1]] = False
        cut[offsets[filled]] = True
        return np.flatnonzero(cut)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each begins; a null is empty."""
        if not self.splits:
            coded = [self._whole(t or "") for t in texts.to_pylist()]
            at = np.concatenate([[0], np.cumsum([len(x) for x in coded], dtype=np.int64)])
            return np.concatenate([np.zeros(0, self.kind), *coded]), at
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, self.kind), np.zeros(len(texts) + 1, dtype=np.int64)
        cuts = self._cuts(data, offsets, texts)
        kind, wide = (pa.string(), np.int32) if len(data) < 2**31 else (pa.large_string(), np.int64)
        borders = pa.py_buffer(np.append(cuts, len(data)).astype(wide))
        parts = pa.Array.from_buffers(kind, len(cuts), [None, borders, pa.py_buffer(np.ascontiguousarray(data))])
        parts = parts.dictionary_encode()
        ids, starts, counts = self._learn(parts.dictionary)
        which = parts.indices.to_numpy(zero_copy_only=False)
        lengths = counts[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        out = ids[np.arange(ends[-1]) + np.repeat(starts[which] - ends[:-1], lengths)]
        return out, ends[np.searchsorted(cuts, offsets)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        ids, at = self.encode_texts(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]

    def characters_of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The first and last character of each token of a text, as the library tells them."""
        spans = np.array(self.library.encode(text, add_special_tokens=False).offsets, dtype=np.int64).reshape(-1, 2)
        return spans[:, 0], np.maximum(spans[:, 0], spans[:, 1] - 1)

    def characters(self) -> tuple[np.ndarray, np.ndarray]:
        """For each id: how many characters begin in its bytes, and whether it begins inside one."""
        symbol = _byte_of_symbol()
        begin, inside = np.zeros(self.size, dtype=np.int64), np.zeros(self.size, dtype=np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            known = token not in self.special and all(c in symbol for c in token)
            data = bytes(symbol[c] for c in token) if known else token.encode()
            begin[i] = sum(b & 0xC0 != 0x80 for b in data)
            inside[i] = data[:1] != b"" and data[0] & 0xC0 == 0x80
        return begin, inside
