"""Dates as text, and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.values import ColumnOrName, as_column

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def date_or_blank(col: ColumnOrName) -> Column:
    """'yyyy-MM-dd', or '' for NULL and for text that is no date."""
    return F.coalesce(as_column(col).try_cast("date").cast("string"), F.lit(""))


def timestamp_or_blank(col: ColumnOrName, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Formatted timestamp, or '' for NULL and for text that is none."""
    return F.coalesce(F.date_format(as_column(col).try_cast("timestamp"), pattern), F.lit(""))


def _reference_day(as_of: ColumnOrName | dt.date | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def age_days365(born: ColumnOrName, as_of: ColumnOrName | dt.date | None = None) -> Column:
    """Elapsed days over 365, cut to a whole number. Runs ahead of the calendar age by the
    leap days lived through; kept because stored tables hold this definition."""
    days = F.datediff(_reference_day(as_of), as_column(born).try_cast("date"))
    return (days / F.lit(365)).cast("int")


def age_calendar(born: ColumnOrName, as_of: ColumnOrName | dt.date | None = None) -> Column:
    """Age in completed years."""
    months = F.months_between(_reference_day(as_of), as_column(born).try_cast("date"))
    return F.floor(months / F.lit(12)).cast("int")
