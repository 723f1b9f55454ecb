"""Filter interaction audit (operator 11).

Five filters are judged once a document. One CUBE over the five failure flags
and part then counts, for every subset of filters, the documents that fail none
of it: the grouping-set row of that subset whose flags are all false. A step of
an order goes from one subset to the next, so a join of two subsets' survivors
gives what the step keeps and removes; all 120 orders come from 32 subsets.

Texts are read once, to numbers and a 128-bit hash; later steps see narrow rows.
Copies are found by grouping on the hash, with partial minima before the
shuffle. What is joined back on a hash or an id is joined by common.join_back,
which sends the few keys that hold many rows to all tasks and shuffles the rest.

Edge cases: a null text is the empty text, which fails A only (and E, if an
earlier document is empty too). A null lang is the part "". Documents without an
id have no labels and fail E if any document with an id has their text; of equal
ids with equal texts none is smaller than the other. Of several labels of an id
the larger counts. An empty table gives no rows. Other columns don't matter.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import WORD, join_back, let, materialize, text_of

FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")


def failures(text: Column) -> Column:
    """A struct of A to D: true where the text fails the filter."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    sizes = let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return let(sizes, lambda s: F.struct((s["n"] < 100).alias("A"), (100 * s["d"].cast("long") < 80 * s["n"].cast("long")).alias("B"), (100 * capitals.cast("long") > 10 * F.length(text).cast("long")).alias("C"), text.rlike(r"[#$%&*|]").alias("D")))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, A to E, good and toxic (0 or 1) of every document."""
    text = text_of(docs)
    narrow = materialize(docs.select(docs["doc_id"], F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("part"), failures(text).alias("f"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")))
    groups = narrow.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("__rows")).where("__rows > 1")
    known = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"]).agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    both = join_back(narrow, groups, ["h1", "h2"], "__rows")
    copies = F.coalesce((F.col("doc_id") > F.col("first")) | (F.col("doc_id").isNull() & F.col("first").isNotNull()), F.lit(False))
    both = both.select("doc_id", "part", "f.*", copies.alias("E"))
    # An id is held by one row, or by few; rows without one are kept out of the shuffle.
    found = both.where("doc_id IS NOT NULL").join(known, "doc_id", "left").unionByName(both.where("doc_id IS NULL").withColumns({"good": F.lit(None).cast("boolean"), "toxic": F.lit(None).cast("boolean")}))
    one = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c)
    return found.select("part", *FILTERS, one("good"), one("toxic"))


def survivors(flags: DataFrame) -> DataFrame:
    """part, mask and COUNTS: documents that fail no filter of the mask (bit i: FILTERS[i]); a row for each of a part's 32 subsets."""
    # 32 rows a part at most go into the cube, which makes 64 of each of its rows.
    each = flags.groupBy("part", *FILTERS).agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    cube = each.cube("part", *FILTERS).agg(F.grouping_id().alias("g"), *[F.sum(c).alias(c) for c in COUNTS])
    # grouping_id has a bit for every column that a row is not grouped by: part's is the highest, E's the lowest.
    last = len(FILTERS) - 1
    selected = [F.col("g").bitwiseAND(F.lit(1 << (last - i)).cast("long")) == 0 for i in range(len(FILTERS))]
    clean = reduce(lambda a, b: a & b, (~s | ~F.col(c) for s, c in zip(selected, FILTERS, strict=True)))
    mask = reduce(lambda a, b: a + b, (F.when(s, F.lit(1 << i)).otherwise(F.lit(0)) for i, s in enumerate(selected)))
    per_part = F.col("g").bitwiseAND(F.lit(1 << len(FILTERS)).cast("long")) == 0
    found = cube.where(per_part & clean).select("part", mask.alias("mask"), *COUNTS)
    grid = found.where("mask = 0").select("part", F.explode(F.sequence(F.lit(0), F.lit(2 ** len(FILTERS) - 1))).alias("mask"))
    return grid.join(found, ["part", "mask"], "left").select("part", "mask", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in COUNTS])


def steps(spark) -> DataFrame:
    """filter_order, step, letter, before and after (masks), alone and others: the five steps of all 120 orders."""
    bit, full, rows = {c: 1 << i for i, c in enumerate(FILTERS)}, 2 ** len(FILTERS) - 1, []
    for order in permutations(FILTERS):
        done = 0
        for k, c in enumerate(order):
            rows.append(("".join(order), k + 1, c, done, done | bit[c], bit[c], full - bit[c]))
            done |= bit[c]
    return spark.createDataFrame(rows, "filter_order string, step int, letter string, before int, after int, alone int, others int")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and, within the part, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley."""
    # A part has 32 rows here, however many documents it has.
    found = materialize(survivors(judged(docs, labels)))
    side = lambda name, cols=("n",): found.select(F.col("part").alias(f"{name}_part"), F.col("mask").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in cols])
    full = 2 ** len(FILTERS) - 1
    # Of 600 steps, fixed: each meets the survivors of the subset before it, then those of the subset after it, of the filter alone and of all others.
    each = found.withColumnRenamed("mask", "before").join(F.broadcast(steps(docs.sparkSession)), "before")
    for name, cols in (("after", COUNTS), ("alone", ("n",)), ("others", ("n",))):
        s = side(name, cols)
        each = each.join(s.withColumnRenamed(f"{name}_part", "part"), ["part", name])
    ends = found.groupBy("part").agg(F.max(F.when(F.col("mask") == 0, F.col("n"))).alias("all_n"), F.max(F.when(F.col("mask") == full, F.col("n"))).alias("none_n"))
    each = each.join(ends, "part").withColumn("removed", F.col("n") - F.col("after_n"))
    orders = Window.partitionBy("part", "letter")  # 120 rows
    return each.withColumn("shapley", F.sum("removed").over(orders)).select(
        "part", "filter_order", "step", F.col("after_n").alias("kept"), "removed",
        (F.col("all_n") - F.col("alone_n") - F.col("removed")).alias("redundant"),
        (F.col("others_n") - F.col("none_n")).alias("unique_fails"),
        (F.col("good") - F.col("after_good")).alias("good_lost"), (F.col("toxic") - F.col("after_toxic")).alias("toxic_lost"), "shapley",
    )


def op11(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step."""
    return audit(docs, labels)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), firsts AS (
  SELECT text, min(doc_id) AS first FROM t GROUP BY text
), f AS (
  SELECT part, len(w) < 100 AS A, 100 * len(list_distinct(w)) < 80 * len(w) AS B,
    100 * len(regexp_extract_all(t.text, '[A-Z]')) > 10 * length(t.text) AS C, regexp_matches(t.text, '[#$%&*|]') AS D,
    coalesce(t.doc_id > first OR (t.doc_id IS NULL AND first IS NOT NULL), false) AS E,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM t JOIN firsts USING (text) LEFT JOIN l ON t.doc_id = l.doc_id
), x AS (
  SELECT part, [A, B, C, D, E] AS fails, count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM f GROUP BY ALL
), o AS (
  SELECT a || b || c || d || e AS filter_order, [a, b, c, d, e] AS o FROM
    (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) q1(a), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) q2(b), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) q3(c),
    (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) q4(d), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) q5(e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
), s AS (
  SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step, o FROM o
), y AS (
  SELECT part, filter_order, step, o[step] AS letter, n, good, toxic,
    fails[ascii(o[step]) - 64] AS now, list_bool_or(list_transform(o[1:step - 1], lambda c: fails[ascii(c) - 64])) AS gone,
    len(list_filter(fails, lambda v: v)) AS n_fails
  FROM x, s
), z AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN NOT now AND NOT coalesce(gone, false) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN now AND NOT coalesce(gone, false) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN now AND coalesce(gone, false) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN now AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN now AND NOT coalesce(gone, false) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN now AND NOT coalesce(gone, false) THEN toxic ELSE 0 END) AS toxic_lost
  FROM y GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM z
"""
