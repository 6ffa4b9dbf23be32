"""Running sums along ordered groups of any size, without one task for a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.scratch import Scratch


def running_sums(
    frame: DataFrame, group: str, order: list[Column], sums: dict[str, Column], scratch: Scratch, name: str
) -> DataFrame:
    """The frame and, for each name in `sums`, the sum of that column over the rows of the group
    up to and with this one.

    Rows are dealt out by ranges of group and order, and written, so a group that holds a third
    of all rows lies in many parts. Each part sums its own; what parts before hold of the same
    group is added, one row for each group and part. The order decides among the rows of a group;
    rows it leaves equal may come in either order.
    """
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = frame.repartitionByRange(parts, group, *order).withColumn("part__", F.spark_partition_id())
    ranged = scratch.keep(ranged, name)
    within = Window.partitionBy(group, "part__").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *(F.sum(c).over(within).alias(f"{n}__local") for n, c in sums.items()))
    totals = ranged.groupBy(group, "part__").agg(*(F.sum(c).alias(f"{n}__all") for n, c in sums.items()))
    before = Window.partitionBy(group).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(group, "part__", *(F.sum(f"{n}__all").over(before).alias(f"{n}__before") for n in sums))
    carried = carried.where(" or ".join(f"{n}__before is not null" for n in sums))
    whole = local.join(carried, [group, "part__"], "left")
    return whole.select(
        *frame.columns, *((F.col(f"{n}__local") + F.coalesce(F.col(f"{n}__before"), F.lit(0))).alias(n) for n in sums)
    )
