"""Looking at a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int | None = 5) -> DataFrame:
    """All columns as text, ``n`` rows at most (None: all rows). NULL stays NULL."""
    texts = df.select(
        *[F.col("`" + c.replace("`", "``") + "`").cast("string").alias(c) for c in df.columns]
    )
    return texts if n is None else texts.limit(n)
