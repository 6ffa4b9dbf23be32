"""Quality rules, line first: lines are judged one by one, failing lines go, and a document
that loses too much of its text with them is rejected.

A line fails as
  navigation   `nav_marks` or more words that are separators, a tenth of its words at least;
  punctuation  a fifth of its characters are symbols, or a third of its words end in "!!";
  capitals     nine tenths of the letters of a line of five words or more are capital;
  stutter      eight words or more, half of them equal to the word before;
  fragment     under four words, and no sentence mark at its end;
  boilerplate  it holds one of BOILERPLATE and has at most thirty words.
Lines without a word neither fail nor count.

Whatever the method finds, a document also fails the base rules if it has under `min_words`
words or if over 30 in 100 of its words lie in 8-word windows found twice or more in it.

Nulls: a null text has no words and is rejected; a null id is kept as it is. Repeated rows are
judged one by one, all alike. An empty table gives an empty result. Columns other than the id
and the text are not read. A text is judged whole, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.words import Words, column, covered, find_words, gram_starts, grams, lean, mix, slices, text_bytes

WINDOW = 8

# Fixed values.
SYMBOLS = b"#*$%&|<>"
SEPARATORS = (b"|", b">", b"<", b"/", b"\xc2\xbb", b"\xc2\xb7", b"\xe2\x80\xa2", b"-")
SENTENCE_END = (b".", b"!", b"?", b":", b";", b'"', b"'", b")", b"\xe2\x80\xa6", b"\xc2\xbb", b"\xe2\x80\x9d")
BOILERPLATE = (
    b"accept cookies",
    b"all rights reserved",
    b"click here",
    b"enable javascript",
    b"log in to",
    b"privacy policy",
    b"read more",
    b"sign up for",
    b"subscribe to our",
    b"terms of use",
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_lost_percent: int = 50
    nav_marks: int = 3


def _line_fails(line: bytes, words: list[bytes], rules: Rules) -> bool:
    count = len(words)
    if b"|" in line or b">" in line or b"/" in line or b" - " in line or b"\xc2" in line or b"\xe2" in line:
        marks = sum(words.count(mark) for mark in SEPARATORS)
        if marks >= rules.nav_marks and 10 * marks >= count:
            return True
    size = sum(map(len, words))
    if 5 * (size - len(line.translate(None, SYMBOLS)) + len(line) - size) >= size:
        return True
    if b"!!" in line and 3 * sum(w.endswith(b"!!") for w in words) >= count:
        return True
    if count >= 5:
        text = line.decode("utf-8", "replace")
        if not text[:2].islower() or text.isupper():
            capital = sum(map(str.isupper, text))
            if capital * 2 > count and 10 * capital >= 9 * sum(map(str.isalpha, text)):
                return True
    elif count < 4 and not words[-1].endswith(SENTENCE_END):
        return True
    if count >= 8 and 2 * sum(map(bytes.__eq__, words, words[1:])) >= count:
        return True
    if count <= 30:
        small = line.lower()
        return any(phrase in small for phrase in BOILERPLATE)
    return False


def clean_text(text: bytes, rules: Rules = Rules()) -> tuple[bytes, int, int]:
    """The text without its failing lines; how many words went; how many lines with a word
    equal an earlier line."""
    kept, lost, repeated, seen = [], 0, 0, {}
    for line in text.split(b"\n"):
        fails = seen.get(line)
        if fails is not None:
            repeated += 1
        else:
            words = line.split()
            if not words:
                kept.append(line)
                continue
            fails = seen[line] = len(words) if _line_fails(line, words, rules) else 0
        if fails:
            lost += fails
        else:
            kept.append(line)
    return (b"\n".join(kept) if lost else text), lost, repeated


def repeated_window_words(words: Words) -> np.ndarray:
    """Per text, the words in windows that the text has twice or more."""
    hashes, total = words.hashes(), len(words)
    starts = np.flatnonzero(gram_starts(words.first, WINDOW, total))
    if not len(starts):
        return np.zeros(len(words.first) - 1, dtype=np.int64)
    row = words.row[starts].astype(np.uint64)
    one = mix(grams(hashes, WINDOW, 1)[starts] ^ mix(row, 7))
    two = grams(hashes, WINDOW, 2)[starts]
    order = np.argsort(one, kind="stable")
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    twice = np.zeros(len(starts), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    within = np.concatenate([[0], np.cumsum(covered(starts[twice], WINDOW, total))])
    return within[words.first[1:]] - within[words.first[:-1]]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def measure(texts: pa.Array, rules: Rules = Rules()) -> dict[str, pa.Array]:
    words = find_words(texts)
    data, offsets = text_bytes(texts)
    in_word = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(in_word, words.start, 1)
    np.add.at(in_word, words.end, -1)
    character = (data & 0xC0) != 0x80
    symbol = np.isin(data, np.frombuffer(SYMBOLS, dtype=np.uint8))
    n_words, n_repeat = words.counts, repeated_window_words(words)
    cleaned = [clean_text(data[a:b].tobytes(), rules) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    lost = np.array([c[1] for c in cleaned], dtype=np.int64)
    failed = (n_words < rules.min_words) | (100 * n_repeat > 30 * n_words)
    left = n_words - lost
    return {
        "n_words": pa.array(n_words, pa.int64()),
        "word_chars": pa.array(_per_text(character & (np.cumsum(in_word)[:-1] > 0), offsets), pa.int64()),
        "n_symbols": pa.array(_per_text(symbol, offsets), pa.int64()),
        "n_dup_lines": pa.array([c[2] for c in cleaned], pa.int64()),
        "n_repeat_words": pa.array(n_repeat, pa.int64()),
        "base_failed": pa.array(failed, pa.bool_()),
        "kept": pa.array(~failed & (100 * lost <= rules.max_lost_percent * n_words) & (left > 0), pa.bool_()),
        "n_lost_words": pa.array(lost, pa.int64()),
        "clean_text": pa.array([c[0] for c in cleaned], pa.binary()).cast(pa.string()),
    }


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lost_words long"


def judge_lines(
    documents: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """One row a document: its id, measures, verdict, and with `with_text` the text without
    its failing lines. Map only: no shuffle, memory for about a megabyte of text at a time."""
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = measure(column(part, "text"), rules)
            if not with_text:
                del found["clean_text"]
            yield pa.RecordBatch.from_pydict({"doc_id": column(part, "doc_id"), **found})

    return source.mapInArrow(lean(run), f"doc_id long, {MEASURES}" + ", clean_text string" * with_text)


def keep_clean(documents: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns, with the text left after cleaning (and `n_chars`,
    where there is one, counted anew). Rows are judged where they are read."""
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            found = measure(column(part, text_col), rules)
            at = part.schema.get_field_index(text_col)
            changed = part.set_column(at, part.schema.field(at), found["clean_text"].cast(part.schema.field(at).type))
            yield changed.filter(found["kept"])

    kept = documents.mapInArrow(lean(run), documents.schema)
    if "n_chars" in names:
        kept = kept.withColumn("n_chars", F.length(text_col).cast(documents.schema["n_chars"].dataType))
    return kept
