"""Joins that spread the hot keys of one side, and only these."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.dedupe import key_list

_SALT, _HASH = "__salt", "__key_hash"
#: Keys a sketch reports at most, and the places it counts in: both bound what the driver gets.
MOST_HOT, TRACKED = 200, 10_000


def hot_keys(df: DataFrame, on: str | Sequence[str], share: float) -> list[int]:
    """Hashes of keys that hold at least ``share`` of the rows, at most ``MOST_HOT``.

    One aggregate over the key columns with a sketch of frequent items, which is merged from the
    map side, so a hot key costs no more than others. A key with the share is never missed as long
    as ``share`` is above 1 / ``TRACKED`` or so; one slightly below it may be reported too.
    """
    if not 1 / MOST_HOT <= share <= 1:
        raise ValueError(f"share must be from {1 / MOST_HOT} to 1")
    hashed = df.select(F.xxhash64(*key_list(on)).alias(_HASH))
    found = hashed.agg(
        F.expr(f"approx_top_k({_HASH}, {MOST_HOT}, {TRACKED})").alias("top"), F.count("*").alias("n")
    ).first()
    return [item["item"] for item in found["top"] or [] if item["count"] >= share * found["n"]]


def join_hot_keys(
    many: DataFrame, one: DataFrame, on: str | Sequence[str], share: float = 0.01, salts: int = 16
) -> DataFrame:
    """Inner join that spreads keys of ``many`` with at least ``share`` of its rows over ``salts``
    tasks each. Rows of ``one`` are repeated for these keys only; all others are joined once.

    For hot keys AQE cannot split, as in a chain of joins on the same columns. ``many`` is read
    twice, the first time its key columns only, and must come from a scan through narrow steps: its
    salt is the row position, which a task that is run again then reproduces. A NULL key matches
    nothing. Hot keys are told by hash: a key that shares a hot one's hash is spread as well, on
    both sides, so the result does not depend on it.
    """
    if salts < 1:
        raise ValueError("salts must be at least 1")
    names = key_list(on)
    hot = hot_keys(many, names, share) if salts > 1 else []
    if not hot:
        return many.join(one, names)
    is_hot = F.xxhash64(*names).isin(hot)
    salt = F.when(is_hot, F.monotonically_increasing_id() % F.lit(salts)).otherwise(F.lit(0))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    copies = F.when(is_hot, every).otherwise(F.array(F.lit(0).cast("bigint")))
    salted_many = many.withColumn(_SALT, salt.cast("bigint"))
    salted_one = one.withColumn(_SALT, F.explode(copies))
    return salted_many.join(salted_one, [*names, _SALT]).drop(_SALT)
