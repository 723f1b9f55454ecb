"""Mergeable sketches of quantiles and distinct counts, kept by day; the exact ways stay the default.

A day's rows become one row a group: a KLL sketch of the values and a
HyperLogLog sketch of the ids. Sketches merge, so any span of days, or all of
them, is answered from these rows without the data, and a new day adds its own.

Errors: a quantile's rank is off by QUANTILE_ERROR at most (of the rows, with a
confidence of 99 %); a distinct count has a standard error of
1.04 / sqrt(2 ** LOG_SLOTS), so it is off by DISTINCT_ERROR (three of these) at
most in 99.7 % of cases. Merging doesn't add to either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.schema import require

#: Items of a quantile sketch, and the binary logarithm of a distinct sketch's slots.
ITEMS, LOG_SLOTS = 400, 12
QUANTILE_ERROR, DISTINCT_ERROR = 0.01, 3 * 1.04 / 2 ** (LOG_SLOTS / 2)


def daily(df: DataFrame, day: Column, by: list[str], value: Column | None = None, ident: Column | None = None) -> DataFrame:
    """day, by and n; quantiles, a sketch of value; distinct, a sketch of ident (a number or text). Nulls are in neither; partial sketches are merged before the shuffle."""
    require(df, by)
    made = [F.count(F.lit(1)).alias("n")]
    if value is not None:
        made.append(F.kll_sketch_agg_double(value.cast("double"), F.lit(ITEMS)).alias("quantiles"))
    if ident is not None:
        made.append(F.hll_sketch_agg(ident, F.lit(LOG_SLOTS)).alias("distinct"))
    return df.groupBy(day.alias("day"), *[F.col(f"`{c}`") for c in by]).agg(*made)


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """by, n and the sketches of all days of `sketches` together; filter its days first for a span of them."""
    made = [F.sum("n").alias("n")]
    if "quantiles" in sketches.columns:
        made.append(F.kll_merge_agg_double("quantiles", F.lit(ITEMS)).alias("quantiles"))
    if "distinct" in sketches.columns:
        made.append(F.hll_union_agg("distinct").alias("distinct"))
    return sketches.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*made)


def quantile(sketch: Column, q: float) -> Column:
    """The value at a share q of the rows; null of a sketch without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(q))))


def distinct(sketch: Column) -> Column:
    return F.hll_sketch_estimate(sketch)
