"""Stored tables in a catalog whose format has built-in MERGE.

The merge runs as the format's own row-level operation, so only touched files are
rewritten and nothing is snapshotted by hand. Plain Parquet tables do not support it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.merge import KeyColumn, key_pairs


def _condition(table: str, on: KeyColumn | Sequence[KeyColumn]) -> Column:
    condition = None
    for pair in key_pairs(on):
        equal = F.col(f"{table}.{pair.target}") == F.col(f"source.{pair.source}")
        condition = equal if condition is None else condition & equal
    return condition


def merge_upsert(
    source: DataFrame,
    table: str,
    on: KeyColumn | Sequence[KeyColumn],
    delete_when: Column | None = None,
) -> None:
    """Update all columns on a match, insert otherwise, delete where asked; new source
    columns are added to the table. Target columns are addressed as ``<table>.<column>``."""
    merge = source.alias("source").mergeInto(table, _condition(table, on)).withSchemaEvolution()
    if delete_when is not None:
        merge = merge.whenMatched(delete_when).delete()
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def merge_set(
    source: DataFrame,
    table: str,
    on: KeyColumn | Sequence[KeyColumn],
    values: Mapping[str, str | Column],
) -> None:
    """Set columns of the rows whose key is in ``source``; nothing is inserted."""
    columns = {c: F.expr(v) if isinstance(v, str) else v for c, v in values.items()}
    merge = source.alias("source").mergeInto(table, _condition(table, on))
    merge.whenMatched().update(columns).merge()


def update_where(
    spark: SparkSession, table: str, rows: Column, values: Mapping[str, str | Column]
) -> None:
    """Set columns of the rows that meet a condition: a merge of the one-row source."""
    columns = {c: F.expr(v) if isinstance(v, str) else v for c, v in values.items()}
    once = spark.range(1).select(F.lit(1).alias("__once"))
    once.mergeInto(table, rows).whenMatched().update(columns).merge()


def create_or_merge(
    source: DataFrame, table: str, on: KeyColumn | Sequence[KeyColumn], provider: str
) -> None:
    """Create the table from ``source``, or ``merge_upsert`` into it."""
    spark: SparkSession = source.sparkSession
    if spark.catalog.tableExists(table):
        merge_upsert(source, table, on)
    else:
        source.writeTo(table).using(provider).create()
