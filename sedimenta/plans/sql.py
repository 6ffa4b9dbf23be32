"""User SQL over frames."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def temp_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Iterator[None]:
    """Register frames as temp views for the length of a block, whatever happens in it."""
    try:
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
        yield
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)


def run_sql(
    spark: SparkSession,
    text: str,
    frames: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Any Spark SQL query, with ``frames`` visible under their names. The returned frame is
    resolved already and outlives the views.

    ``args`` are the values of named parameters such as ``:day``. They are bound as literals of
    their own type and never become part of the text, so a quote in a value does no harm.

    Temp views belong to the session, so each frame is registered under a name of its own and
    bound to the name in the text by a CTE: runs in other threads, and views of the caller
    with the same name, are not touched.
    """
    values = dict(args) if args else None
    if not frames:
        return spark.sql(text, args=values)
    own = {f"frame_{uuid.uuid4().hex}": frame for frame in frames.values()}
    bound = ", ".join(f"`{name}` as (select * from {view})" for name, view in zip(frames, own, strict=True))
    with temp_views(spark, own):
        return spark.sql(f"with {bound} (\n{text.rstrip().removesuffix(';')}\n)", args=values)
