"""Cleaning and decoding of single columns.

All of these stay inside whole-stage codegen, and all of them are right with ANSI mode
on or off: text is parsed with ``try_cast``, so a bad value gives NULL and never an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

_NO_DEFAULT = object()


def as_column(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_if_null(col: ColumnOrName) -> Column:
    """The value as text, with '' in place of NULL."""
    return F.coalesce(as_column(col).cast("string"), F.lit(""))


def to_bigint(col: ColumnOrName) -> Column:
    """Whole number; fractions are cut off towards zero, in text like '12.0' or '1e3' too.
    Unreadable text gives NULL."""
    value = as_column(col)
    written = value.cast("string").try_cast("decimal(38,18)").try_cast("bigint")
    return F.coalesce(value.try_cast("bigint"), written)


def money(col: ColumnOrName) -> Column:
    """DECIMAL(38,2), rounded half up."""
    return as_column(col).try_cast("decimal(38,2)")


def decode_map(
    col: ColumnOrName, labels: Mapping[object, str], default: str | None = _NO_DEFAULT
) -> Column:
    """Code -> label. Codes outside ``labels`` (and NULL) give ``default``, or NULL without one.

    Numeric codes are compared as numbers, so 3, 3.0 and '3' all decode alike and a
    text column with junk in it does not fail under ANSI mode.
    """
    if not labels:
        raise ValueError("decode_map needs at least one code")
    numeric = all(isinstance(code, (int, float)) and not isinstance(code, bool) for code in labels)
    probe = as_column(col).try_cast("double") if numeric else as_column(col).cast("string")
    chain = F
    for code, label in labels.items():
        chain = chain.when(probe == F.lit(float(code) if numeric else str(code)), F.lit(label))
    return chain if default is _NO_DEFAULT else chain.otherwise(F.lit(default))


def flag_from(col: ColumnOrName, yes: str = "SIM") -> Column:
    """True for ``yes``; anything else, NULL included, is false."""
    return F.coalesce(as_column(col).cast("string") == F.lit(yes), F.lit(False))


def flag_label(col: ColumnOrName, yes: str = "SIM", no: str = "NÃO", unknown: str = "") -> Column:
    """Three-valued boolean -> label."""
    flag = as_column(col).try_cast("boolean")
    return F.when(flag, F.lit(yes)).when(~flag, F.lit(no)).otherwise(F.lit(unknown))
