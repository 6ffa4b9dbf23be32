"""Audit columns and whole-frame type clean-up. Map-only: none of these shuffles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampNTZType, TimestampType

PROCESSED = "processed"
CREATED = "creationDate"


def with_audit(df: DataFrame, as_of: str | dt.datetime | None = None) -> DataFrame:
    """Add ``processed = false`` and ``creationDate`` (now, or the given instant)."""
    created = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return df.withColumns({PROCESSED: F.lit(False), CREATED: created})


def only_unprocessed(df: DataFrame) -> DataFrame:
    """Rows a later layer has not taken yet. A NULL flag counts as not taken."""
    return df.where(~F.coalesce(F.col(PROCESSED), F.lit(False)))


def normalize_temporal(df: DataFrame) -> DataFrame:
    """Bring zone-less timestamps to TIMESTAMP; dates and timestamps pass unchanged."""
    casts = {
        f.name: _quoted(f.name).cast(TimestampType())
        for f in df.schema.fields
        if isinstance(f.dataType, TimestampNTZType)
    }
    return df.withColumns(casts) if casts else df


def null_to_nan(df: DataFrame) -> DataFrame:
    """NULL -> NaN in float and double columns; other types have no NaN and stay as they are."""
    fills = {
        f.name: F.coalesce(_quoted(f.name), F.lit(float("nan")).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, (FloatType, DoubleType))
    }
    return df.withColumns(fills) if fills else df


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
