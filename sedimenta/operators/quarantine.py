"""Rows that cannot be taken as they are, and why."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.keys import row_key

REASONS, RECORD_TEXT, RECORD_KEY = "reasons", "record", "record_key"
UNREADABLE = "unreadable"
_REASONS = "__reasons"


def cast_fails(column: str, value: Column) -> Column:
    """Whether a value is there but came out of a conversion as NULL."""
    return F.col(column).isNotNull() & value.isNull()


def split_rejected(
    df: DataFrame, checks: Mapping[str, Column | str], corrupt: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows to take, rows rejected). ``checks`` names conditions that a bad row meets; a condition
    that is NULL is not met. ``corrupt`` is the column into which the reader put the text of a record
    it could not read; it is not handed on.

    Rejected rows come as ``record_key``, ``reasons`` and ``record``: the text of the record, or the
    row as JSON. Equal ones share a key and come once.
    """
    met = [
        F.when(F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False)), F.lit(name))
        for name, c in checks.items()
    ]
    if corrupt is not None:
        met.insert(0, F.when(F.col(corrupt).isNotNull(), F.lit(UNREADABLE)))
    data = [c for c in df.columns if c != corrupt]
    marked = df.withColumn(_REASONS, F.array_compact(F.array(*met)))
    taken = marked.where(F.size(_REASONS) == 0).select(*data)
    as_json = F.to_json(F.struct(*data))
    text = as_json if corrupt is None else F.coalesce(F.col(corrupt), as_json)
    rejected = marked.where(F.size(_REASONS) > 0).select(text.alias(RECORD_TEXT), F.col(_REASONS).alias(REASONS))
    rejected = rejected.distinct().select(row_key([RECORD_TEXT]).alias(RECORD_KEY), REASONS, RECORD_TEXT)
    return taken, rejected
