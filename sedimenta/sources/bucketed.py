"""Catalog tables laid out in buckets by their merge key.

Rows of a key lie in one bucket, sorted, so a merge reads the table as it lies: only the batch is
shuffled, to the table's buckets, and each task merges one bucket. Versions are catalog tables
``<name>__v000001``, ...; ``name`` is a view of the newest complete one, switched after the write.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from sedimenta.operators.merge import KeyColumn, key_pairs, merge_frames, refuse_copies

_VERSION = re.compile(r"__v(\d{6,})$")


def bucketed_versions(spark: SparkSession, name: str) -> list[int]:
    """The versions in the catalog, ascending; the last may not have been finished."""
    space, _, plain = name.rpartition(".")
    place = f" in {space}" if space else ""
    found = spark.sql(f"show tables{place} like '{plain}__v*'").collect()
    numbers = [_VERSION.search(r["tableName"]) for r in found if r["tableName"].startswith(f"{plain.lower()}__v")]
    return sorted(int(m.group(1)) for m in numbers if m)


def create_bucketed(
    df: DataFrame, name: str, on: KeyColumn | Sequence[KeyColumn], buckets: int, unique: bool = False
) -> str:
    """Write ``df`` as the next version of a table in ``buckets`` buckets by its key."""
    spark = df.sparkSession
    keys = [p.target for p in key_pairs(on)]
    version = f"{name}__v{max(bucketed_versions(spark, name), default=0) + 1:06d}"
    source = df if unique else refuse_copies(df, keys)
    source.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(version)
    spark.sql(f"create or replace view {name} as select * from {version}")
    return version


def merge_bucketed(
    source: DataFrame,
    name: str,
    on: KeyColumn | Sequence[KeyColumn],
    buckets: int,
    *,
    delete_when: str | Column | None = None,
    source_unique: bool = False,
) -> str:
    """Upsert into a bucketed table; creates it if need be. ``buckets`` is that of the table.

    One full outer join. Its output lies in buckets already, so the write does not shuffle either,
    and each bucket is one file. NULL keys go around the join and match nothing.
    """
    spark = source.sparkSession
    if not spark.catalog.tableExists(name):
        return create_bucketed(source, name, on, buckets, source_unique)
    merged = merge_frames(
        spark.table(name), source, on, delete_when=delete_when, source_unique=source_unique, form="outer"
    )
    return create_bucketed(merged, name, on, buckets, unique=True)


def expire_bucketed(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Drop all but the newest ``keep`` versions; the view needs the newest."""
    if keep < 1:
        raise ValueError("at least one version must stay")
    gone = [f"{name}__v{v:06d}" for v in bucketed_versions(spark, name)[:-keep]]
    for version in gone:
        spark.sql(f"drop table {version}")
    return gone
