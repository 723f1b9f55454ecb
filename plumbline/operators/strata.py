"""Counts over all subsets of strata at once: rows, and distinct members, of every combination and every total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.schema import require


def cube(df: DataFrame, by: list[str], member: str | None = None, rollup: bool = False) -> DataFrame:
    """by, level, n and members: a row for each combination of values of each subset of by (rollup: of each leading part of it).

    level: a bit for every column that a row is a total over, the last column's
    the lowest; so a null value (level bit 0) and a total (bit 1) are told
    apart. members: distinct values of member in the row, 0 without one.

    Rows are counted by strata and member first. A member's strata are then
    gathered, and it adds one to each row that any of them is in, so what each
    subset repeats is counted at once and no (subset, member) pair is held. A
    member's strata, no more than there are of all rows, are one array.
    """
    require(df, [*by, *([member] if member else [])])
    names = [f"c{i}" for i in range(len(by))]
    levels = [(1 << i) - 1 for i in range(len(by) + 1)] if rollup else list(range(1 << len(by)))
    total = lambda i, level: level >> (len(by) - 1 - i) & 1
    kinds = [df.select(f"`{c}`").schema[0].dataType for c in by]

    def row(level: int, value) -> Column:
        return F.struct(F.lit(level).alias("level"), *[(F.lit(None).cast(t) if total(i, level) else value(c)).alias(c) for i, (c, t) in enumerate(zip(names, kinds, strict=True))])

    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(by, names, strict=True)]
    cells = df.select(*columns, (F.col(f"`{member}`") if member else F.lit(None).cast("string")).alias("m")).groupBy(*names, "m").agg(F.count(F.lit(1)).alias("n"))
    rows = cells.select("n", F.explode(F.array(*[row(x, F.col) for x in levels])).alias("r")).select("r.*", "n", F.lit(0).cast("long").alias("members"))
    if member:
        strata = cells.where("m IS NOT NULL").groupBy("m").agg(F.collect_list(F.struct(*names)).alias("s"))
        at = lambda level: F.array_distinct(F.transform("s", lambda s: row(level, lambda c: s[c])))
        met = F.flatten(F.array(*[at(x) for x in levels]))
        rows = rows.unionByName(strata.select(F.explode(met).alias("r")).select("r.*", F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("members")))
    made = rows.groupBy(*names, "level").agg(F.sum("n").alias("n"), F.sum("members").alias("members"))
    return made.select(*[F.col(n).alias(c) for c, n in zip(by, names, strict=True)], "level", "n", "members")
