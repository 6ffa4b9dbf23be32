"""The history of records: one row for each state, with the time it was valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.dedupe import dedupe, key_list

VALID_FROM, VALID_TO, CURRENT, CONFIRMED = "valid_from", "valid_to", "is_current", "confirmed"
_ARRIVED = "__arrived"


def merge_history(
    history: DataFrame | None, batch: DataFrame, key: str | Sequence[str], at: str
) -> DataFrame:
    """The history after a batch of states, ``at`` being the column with the time of each.

    A state is valid from its time up to that of the next one of the same record, the last one
    without an end. A state that says what the one before says opens nothing; its time is kept in
    ``confirmed``. Batches may come in any order and hold several states of a record: one that lies
    between two others splits the interval it falls into, and the old state is valid again from the
    first time it was confirmed after that. Of two states of one time the one that arrived last counts; within a
    batch the first by its columns.

    Only records of the batch are rebuilt; the history of others is handed on by an anti join. NULL
    in a key is a value like any other. Rows without a time are refused.
    """
    keys = key_list(key)
    content = [c for c in batch.columns if c not in keys and c != at]
    time = F.when(F.col(at).isNull(), F.raise_error(F.lit(f"a state has no {at}"))).otherwise(F.col(at))
    states = batch.select(*keys, *content, time.cast(batch.schema[at].dataType).alias(VALID_FROM), F.lit(1).alias(_ARRIVED))
    kept = None
    if history is not None:
        records = batch.select(*keys).distinct()
        held = history.alias("held")
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"held.{k}").eqNullSafe(F.col(f"asked.{k}"))
        kept = held.join(records.alias("asked"), same, "left_anti")
        known = held.join(records.alias("asked"), same, "left_semi").drop(VALID_TO, CURRENT)
        times = F.concat(F.array(VALID_FROM), CONFIRMED)
        known = known.withColumn(VALID_FROM, F.explode(times)).drop(CONFIRMED)
        states = known.withColumn(_ARRIVED, F.lit(0)).unionByName(states, allowMissingColumns=True)
    rebuilt = _intervals(states, keys)
    return rebuilt if kept is None else kept.unionByName(rebuilt, allowMissingColumns=True)


def _intervals(states: DataFrame, keys: list[str]) -> DataFrame:
    content = [c for c in states.columns if c not in (*keys, VALID_FROM, _ARRIVED)]
    single = dedupe(states, [*keys, VALID_FROM], [F.col(_ARRIVED).desc()])
    order = Window.partitionBy(*keys).orderBy(VALID_FROM)
    state = F.struct(*content) if content else F.struct(F.lit(0))
    before = F.lag(F.struct(state.alias("state"))).over(order)
    opens = F.col("__before").isNull() | ~F.col("__before.state").eqNullSafe(state)
    marked = single.withColumn("__before", before).withColumn("__opens", opens)
    stretch = F.sum(F.col("__opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # Both sums and groups lie in the partitioning of the first window.
    opened = marked.withColumn("__stretch", stretch).groupBy(*keys, "__stretch").agg(
        F.min_by(F.struct(state.alias("state")), VALID_FROM)["state"].alias("__state"),
        F.array_sort(F.collect_list(VALID_FROM)).alias("__times"),
    )
    opened = opened.withColumn(VALID_FROM, F.element_at("__times", 1))
    until = F.lead(VALID_FROM).over(order)
    return opened.select(
        *keys, *[F.col("__state")[c].alias(c) for c in content], VALID_FROM, until.alias(VALID_TO),
        until.isNull().alias(CURRENT), F.slice("__times", F.lit(2), F.size("__times")).alias(CONFIRMED),
    )


def valid_at(history: DataFrame, moment: Column | str) -> DataFrame:
    """The states that were valid at a moment."""
    when = F.lit(moment) if isinstance(moment, str) else moment
    when = when.cast(history.schema[VALID_FROM].dataType)
    return history.where((F.col(VALID_FROM) <= when) & (F.col(VALID_TO).isNull() | (when < F.col(VALID_TO))))
