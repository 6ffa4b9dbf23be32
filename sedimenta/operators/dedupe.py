"""One row per key, with a fixed survivor.

``row_number() == 1`` plans a WindowGroupLimit on the map side: every map task forwards at
most one row per key, so a key that holds a third of the table costs the shuffle one row
per task and never gathers in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from sedimenta.functions.keys import is_plain_text, packed, unpacked
from sedimenta.operators.audit import CREATED

_RANK = "__rank"


def key_list(keys: str | Sequence[str]) -> list[str]:
    """A key given as one name or as several."""
    names = [keys] if isinstance(keys, str) else list(keys)
    if not names:
        raise ValueError("at least one key column is needed")
    return names


def dedupe(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str | Column] = (),
    pack: bool = False,
) -> DataFrame:
    """Keep the first row of each key under ``order_by``.

    Remaining columns are appended as tie-breakers, so the survivor does not depend on
    file order or task timing. NULL is one key value, as in ``dropDuplicates``.

    With ``pack`` keys of text are shuffled as ``packed`` has them: for row keys, where no join on
    them follows that could use the partitioning.
    """
    names = key_list(keys)
    ordered = [F.col(c) if isinstance(c, str) else c for c in order_by]
    named = {c for c in order_by if isinstance(c, str)}
    ties = [
        F.col(f.name)
        for f in df.schema.fields
        if f.name not in names
        and f.name not in named
        and not isinstance(f.dataType, (MapType, VariantType))
    ]
    order = ordered + ties or [F.lit(1)]
    columns, texts = df.columns, {}
    if pack and not order_by:  # an order may be by an expression of the key
        plain = {f.name for f in df.schema.fields if is_plain_text(f.dataType)}
        texts = {n: f"__packed{i}" for i, n in enumerate(names) if n in plain}
    if texts:
        pairs = {n: packed(F.col(n)) for n in texts}
        df = df.withColumns({texts[n]: data for n, (data, _) in pairs.items()} | {n: text for n, (_, text) in pairs.items()})
    window = Window.partitionBy(*names, *texts.values()).orderBy(*order)
    kept = df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
    if texts:
        kept = kept.withColumns({n: unpacked(F.col(data), F.col(n)) for n, data in texts.items()}).select(*columns)
    return kept


def distinct_keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The distinct values of some columns, for use next to a join on them.

    They are grouped as one struct, so the grouping does not share the partitioning of a join
    on the columns. Sharing would save a shuffle of these few rows, but AQE can only split a
    hot key of a join whose inputs come fresh from a shuffle and whose output goes to one.
    """
    keys = df.select(F.struct(*[F.col(c) for c in names]).alias("key"))
    return keys.distinct().select(*[F.col("key").getField(c).alias(c) for c in names])


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], version: str = CREATED
) -> DataFrame:
    """The newest version of each record, for tables that keep every content version."""
    return dedupe(df, keys, [F.col(version).desc_nulls_last()])
