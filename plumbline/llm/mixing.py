"""Mixing sources to target weights (operator 7, native).

Each document gets a hash-random key, of its source, id and text. Within a
source the keys' first digits cut them into even, contiguous ranges, more of
them for more documents; sums by range, then sums of the ranges before, then
the sum inside a range give each document its exact place in its source's random
order, and no task ever holds a whole source. The budget falls as whole epochs
for all, plus one exact cut. The number of ranges changes no result.

Edge cases: a null text has size 0; a null source is a source of its own,
after all others; a source without words has target 0. Repeated rows (equal
doc_id, source and text) tie in the order; any order among them gives the same
rows.
Input columns but doc_id, text and source don't matter. Empty input, empty
output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import WORD, materialize, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
#: Documents that a key range holds at most, about, if all are of one source.
RANGE_ROWS = 1 << 17
SEED = 20240607


def sized(docs: DataFrame, keep: list | None = None) -> DataFrame:
    """doc_id, source, size and key; keep: further columns."""
    size = F.size(F.regexp_extract_all(text_of(docs), F.lit(WORD), F.lit(0))).cast("long")
    key = F.md5(F.concat_ws("|", F.lit(str(SEED)), docs["source"], docs["doc_id"].cast("string"), F.md5(text_of(docs))))
    return docs.select(docs["doc_id"], docs["source"], size.alias("size"), key.alias("key"), *(keep or []))


def budgets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: the shares by weight, stopped at CAP times a source's size.

    Resharing the excess until no target is above its cap ends at
    min(cap, level * weight) for one level. With sources in order of
    cap / weight, the level after the first k are full follows from two running
    sums. The input is one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("__i", F.row_number().over(by_name) - 1)
    s = s.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("__i") % len(WEIGHTS) + 1).cast("int")))
    s = s.withColumn("__cap", F.col("source_size") * F.lit(float(CAP)))
    order = Window.orderBy(F.col("__cap") / F.col("__w"), "__i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.withColumns({
        "__total": F.sum(F.col("source_size")).over(everything) * F.lit(SHARE),
        "__spent": F.coalesce(F.sum("__cap").over(before), F.lit(0.0)),
        "__open": F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)),
    })
    level = (F.col("__total") - F.col("__spent")) / F.col("__open")
    # The first source in order that its share doesn't fill sets the level for it and all after it.
    own = F.when(level * F.col("__w") < F.col("__cap"), level)
    s = s.withColumn("__level", F.first(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("__level").isNull(), F.col("__cap")).otherwise(F.least(F.col("__cap"), F.col("__level") * F.col("__w")))
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, epochs and keep."""
    held = [docs[c].alias(f"__keep_{c}") for c in keep]
    rows = materialize(sized(docs, held))
    n, digits = rows.count(), 3
    while n > RANGE_ROWS * 16**digits:
        digits += 1
    rows = rows.withColumn("__range", F.substring("key", 1, digits))
    sums = rows.groupBy("source", "__range").agg(F.sum("size").alias("__sum"))
    sizes = sums.groupBy("source").agg(F.sum("__sum").alias("source_size"))
    plan = budgets(sizes)
    earlier = Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    starts = starts.alias("a").join(plan.alias("p"), F.col("a.source").eqNullSafe(F.col("p.source"))).select("a.source", "__range", "__start", "source_size", "target")
    starts = starts.withColumn("__budget", F.round("target").cast("long"))
    inside = Window.partitionBy("source", "__range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    x = placed.alias("r").join(starts.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.__range") == F.col("s.__range")))
    epochs = F.when(F.col("source_size") > 0, F.expr("__budget div source_size")).otherwise(F.lit(0)).cast("long")
    rest = F.col("__budget") - epochs * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__start") - F.col("__before")))
    taken = epochs * F.col("size") + cut
    return x.select("r.doc_id", "r.source", "size", "source_size", "target", taken.cast("long").alias("taken"), epochs.alias("epochs"), *[F.col(f"r.__keep_{c}").alias(f"__keep_{c}") for c in keep])


def op7(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of the documents; the mix as it is to be drawn."""
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws('|', '{SEED}', source, CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS key FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i, source_size * 2.0::DOUBLE AS cap FROM s
), c AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS wt FROM w
), x AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS total, coalesce(sum(cap) OVER before, 0.0) AS spent, sum(wt) OVER () - coalesce(sum(wt) OVER before, 0.0) AS open
  FROM c WINDOW before AS (ORDER BY cap / wt, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, CASE WHEN (total - spent) / open * wt < cap THEN (total - spent) / open END AS own FROM x
), f AS (
  SELECT *, first_value(own IGNORE NULLS) OVER (ORDER BY cap / wt, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level FROM l
), t AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * wt) END AS target FROM f
), b AS (
  SELECT *, CAST(round(target) AS BIGINT) AS budget, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t
), p AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM d
)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""
