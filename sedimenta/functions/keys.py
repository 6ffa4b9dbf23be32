"""Row keys derived from column content."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from sedimenta.functions.values import ColumnOrName, as_column

_PLAIN_TYPES = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def row_key(
    cols: Sequence[ColumnOrName], mode: str = "strict", plain: Collection[str] = ()
) -> Column:
    """One text key for the given columns.

    ``strict`` (the default) is SHA-256 over the column texts, each behind its length, with
    a marker for NULL: never NULL, and two different rows never share the hashed text.
    Columns named in ``plain`` go in without their length, which halves the cost; their
    text must never contain '|' nor be '~', as is so for numbers, booleans and dates.

    ``compat`` is BASE64 over the bare concatenation, for tables whose stored keys were
    made that way. It is NULL as soon as one column is NULL, and column borders vanish, so
    (1, 23) and (12, 3) collide. Spark breaks long base64 text into lines of 76.
    """
    if not cols:
        raise ValueError("row_key needs at least one column")
    texts = [as_column(c).cast("string") for c in cols]
    if mode == "strict":
        parts = [
            F.coalesce(t if c in plain else F.concat(F.length(t), F.lit(":"), t), F.lit("~"))
            for c, t in zip([c if isinstance(c, str) else None for c in cols], texts)
        ]
        return F.sha2(F.concat_ws("|", *parts), 256)
    if mode == "compat":
        return F.base64(F.concat(*texts))
    raise ValueError(f"row_key mode must be 'strict' or 'compat', not {mode!r}")


def row_key_for(
    df: DataFrame, cols: Sequence[str] | None = None, mode: str = "strict"
) -> Column:
    """``row_key`` over columns of ``df`` (all by default), with ``plain`` told by type.

    The key of a row therefore changes when a column goes from a number to text, and that
    of a TIMESTAMP column follows the session time zone: keep both fixed for a table.
    """
    names = list(df.columns if cols is None else cols)
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, _PLAIN_TYPES)]
    return row_key(names, mode, plain)


def packed(text: Column) -> tuple[Column, Column]:
    """Two columns in place of one of text: lower-case hexadecimal digits, as of a strict row key, go
    into the first as half as many bytes, other text into the second. Equal pairs are equal texts; a
    NULL is a NULL in the second. For shuffles, whose compression saves nothing of such digits."""
    data = F.unhex(text)
    digits = F.coalesce(F.lower(F.hex(data)) == text, F.lit(False))
    return F.when(digits, data).otherwise(F.lit(b"")), F.when(digits, F.lit("")).otherwise(text)


def unpacked(data: Column, text: Column) -> Column:
    """The text ``packed`` was given."""
    return F.when(F.length(data) > 0, F.lower(F.hex(data))).otherwise(text)


def is_plain_text(kind: DataType) -> bool:
    """Whether texts of a type are equal only if their bytes are, so that they may be packed."""
    return kind == StringType()


def is_hashed_whole(kind: DataType) -> bool:
    """Whether equal values of a type have the same hash, whatever they are stored as: not floating
    numbers, texts under a collation, or nested values."""
    return is_plain_text(kind) or isinstance(kind, (IntegralType, DecimalType, BooleanType, DateType, TimestampType, TimestampNTZType))


def has_exact_text(kind: DataType) -> bool:
    """Whether values of a type are told apart by their text, or, of instants, by their microseconds."""
    return is_plain_text(kind) or isinstance(kind, _PLAIN_TYPES)


def content_sums(names: Sequence[str], df: DataFrame) -> list[Column]:
    """Eight sums over the rows, for fewer than 2**33 of them: two frames with the same sums and the same number of rows
    hold the same rows, each equally often. The numbers summed are cut from hashes of the strict
    row key, 240 bits a row. Columns must be of types with ``has_exact_text``."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = []
    for name in names:
        column = F.col("`" + name.replace("`", "``") + "`")
        text = F.unix_micros(column) if isinstance(kinds[name], TimestampType) else column
        text = text.cast("string")
        texts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("~")))
    key = F.sha2(F.concat_ws("|", *texts), 256)
    return [F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(i), key), 34)) for i in range(8)]
