"""Equi joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.dedupe import key_list

_SALT = "__salt"


def join_on_columns(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on bare columns: null checks reach the scan, and a later join or dedupe on the
    same columns reuses the partitioning. No hint is given; the optimizer broadcasts a side
    when its size allows and AQE splits skewed partitions of a sort-merge join."""
    return left.join(right, key_list(on), how)


def join_on_concat(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on the concatenated text of the key columns, as older jobs wrote it.

    Only for comparison with those: (1, 23) meets (12, 3), and the key is an expression, so
    nothing is pushed to the scan. Key columns of ``right`` are dropped from the result.
    """
    names = key_list(on)
    l, r = left.alias("l"), right.alias("r")
    joined = l.join(r, _glued("l", names) == _glued("r", names), how)
    kept = [F.col(f"r.{c}") for c in right.columns if c not in names]
    return joined.select("l.*", *kept)


def _glued(side: str, names: Sequence[str]) -> Column:
    return F.concat(*[F.col(f"{side}.{c}").cast("string") for c in names])


def join_skewed(
    many: DataFrame, one: DataFrame, on: str | Sequence[str], salts: int
) -> DataFrame:
    """Inner join that spreads each key of ``many`` over ``salts`` tasks and repeats ``one``
    that many times.

    For a hot key AQE cannot split, as in a chain of joins on the same columns, where only
    the first join has both inputs fresh from a shuffle. ``many`` must come from a scan
    through narrow steps only: its salt is the row position, which a task that is run again
    then reproduces. Equal rows get different salts, so a run of copies is spread as well.
    Both sides are shuffled, whatever their sizes: the optimizer does not see that the repeated side
    is ``salts`` times as large, and would send it whole through the driver; and a side that may be
    broadcast needs no salt.
    """
    if salts < 1:
        raise ValueError("salts must be at least 1")
    names = key_list(on)
    if salts == 1:
        return many.join(one, names)
    salted_many = many.withColumn(_SALT, F.monotonically_increasing_id() % F.lit(salts))
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    salted_one = one.withColumn(_SALT, F.explode(every_salt))
    return salted_many.join(salted_one.hint("merge"), [*names, _SALT]).drop(_SALT)
