"""Token counts of sections by offset mapping.

A document is encoded once, as a whole, so counts are those of the tokens a model would see.
Tokens' character spans follow from the ids, and an interval join with the sections' spans (two
sorted lists, met inside the task that encodes) gives each token to one section:

  rule "first"  the section that holds the token's first character;
  rule "last"   the section that holds its last one.

So sections add up to their document. `n_crossing` counts the tokens given to a section that
reach into another. With one field, sections are its lines, each with the line feed that ends
it; with several, the fields are joined by line feeds, and sections are the fields.

Nulls: a null field is an empty one; an empty document has one section without tokens; a null
id stays null. Repeated rows give repeated sections. An empty table gives an empty result, other
columns are not read, texts are encoded whole. Map only: nothing is shuffled or collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.encoding import SLICE_BYTES, encoder_for
from sedimenta.llm.words import column, slices

_SECTIONS = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long"


def section_counts(first: np.ndarray, last: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of sections that begin at `bounds` (the first at 0), for
    tokens from character `first` to character `last`."""
    begins = np.searchsorted(bounds, first, side="right") - 1
    ends = np.searchsorted(bounds, last, side="right") - 1
    owner = begins if rule == "first" else ends
    return np.bincount(owner, minlength=len(bounds)), np.bincount(owner[begins != ends], minlength=len(bounds))


def count_tokens(
    documents: DataFrame,
    tokenizer: str,
    fields: Sequence[str] = ("text",),
    rule: str = "first",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row a section: doc_id, section (from 0), start, end (characters, end exclusive),
    n_tokens, n_crossing."""
    if rule not in ("first", "last"):
        raise ValueError("rule is 'first' or 'last'")
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as source:
        model = spark.sparkContext.broadcast(source.read())
    text = F.concat_ws("\n", *(F.coalesce(F.col(f), F.lit("")) for f in fields))
    sizes = F.array(*(F.length(F.coalesce(F.col(f), F.lit(""))) for f in fields))
    source = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), sizes.alias("sizes"))
    by_line = len(fields) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(model.value)
        begin, inside = encoder.characters()
        for part in slices(batches, most=SLICE_BYTES):
            texts = column(part, "text").to_pylist()
            coded, at = encoder.encode_texts(column(part, "text"))
            out: list[list] = [[], [], [], [], [], []]
            for doc, whole, size, a, b in zip(
                column(part, "doc_id").to_pylist(), texts, column(part, "sizes").to_pylist(), at[:-1], at[1:], strict=True
            ):
                lengths = [len(x) + 1 for x in whole.split("\n")] if by_line else [s + 1 for s in size]
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                bounds[-1] = len(whole)
                if encoder.splits:
                    ids = coded[a:b]
                    after = np.cumsum(begin[ids])
                    first = after - begin[ids] - inside[ids]
                    last = np.maximum(first, after - 1)
                else:
                    first, last = encoder.characters_of(whole)
                n, crossing = section_counts(first, last, bounds[:-1], rule)
                out[0] += [doc] * len(n)
                out[1] += range(len(n))
                out[2] += bounds[:-1].tolist()
                out[3] += bounds[1:].tolist()
                out[4] += n.tolist()
                out[5] += crossing.tolist()
            names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    return source.mapInArrow(run, _SECTIONS)
