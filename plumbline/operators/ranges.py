"""Positions in the order of a hash, without a task that holds a whole group.

The first digits of a hash cut each group into even, contiguous ranges. Counts
by range, sums of the ranges before, and a window inside each range give every
row its exact place, however large its group is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leading hexadecimal digits of a hash that name its range.
DIGITS = 3


def placed(df: DataFrame, keys: list[str], order: Column, ties: list[str], within: Column | None = None) -> DataFrame:
    """df with __n (the row's place in its group, from 1) and __total (the group's rows).

    order: a hash as hexadecimal digits. within: a condition on keys, __total and
    __start (the rows in ranges before); ranges where it fails are left out
    before rows are ranked.
    """
    rows = df.withColumn("__order", order).withColumn("__range", F.substring("__order", 1, DIGITS))
    counts = rows.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__count"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "__range", F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__start"), F.sum("__count").over(group).alias("__total"))
    if within is not None:
        starts = starts.where(within)
    names = [*keys, "__range"]
    starts = starts.select(*[F.col(k).alias(f"__at{i}") for i, k in enumerate(names)], "__start", "__total")
    near = [F.col(k).eqNullSafe(F.col(f"__at{i}")) for i, k in enumerate(names)]
    inside = Window.partitionBy(*names).orderBy("__order", *ties)
    both = rows.join(starts, near).withColumn("__n", F.col("__start") + F.row_number().over(inside))
    return both.select(*df.columns, "__n", "__total")
