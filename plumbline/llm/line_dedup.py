"""Line deduplication by an exact set-similarity join (operator 10, native).

All lines with a word in them, however short, are compared as sets of lower-case
words; a line is removed if an earlier line (by doc_id, then line number) has a
Jaccard similarity of 0.8 or more with it. Blank lines always stay.

1. Equal lines form a class, of which only the first line goes on. A class is
   named by a 64-bit hash of its line; a second, independent one tells unequal
   lines of one name apart, and these are named anew by both, so unequal lines
   are never taken as equal (but for 128 equal bits). A class's distinct words
   are written once, as 64-bit hashes; all later steps read those.
2. Classes that share their first or last five words with an earlier class are
   verified against the earliest such class only. That settles dense groups of
   variants with a number of pairs linear in their size. It decides nothing
   else: what it leaves open is found by the join.
3. The join: each class's words are ordered by rarity (a sketch of counts over
   all classes, then the word's hash, so that the order is total), and its
   prefix words are join keys. A word that occurs once in all classes is no key,
   since no other line has it. Size and positional filters drop pairs that can't
   reach the threshold, as does a parity bitmap: each word flips one of 64 bits,
   so two lines differ in at least as many words as their bitmaps differ in bits.
   Pairs whose later class is settled need no look. Survivors are compared by
   their whole prefixes, which are a small part of the words to shuffle, and what
   may still be similar is verified on all words of both lines. Where pairs are
   more than classes, each later class is verified first with the class whose
   bitmap is nearest, then all pairs of those that this leaves open.

   Tokens are joined by 31 bits; words that collide there draw a pair more, and
   none less.

Words are compared by their hashes: two words of a pair of lines of 50 words
that collide in 57 bits are met once in about 10^13 pairs.

Edge cases: a null text has no lines and stays null; a text of which all lines
go becomes empty, its row stays. A null doc_id comes after all others. Of rows
with one doc_id, that with the smaller text hash is earlier; rows that repeat
in doc_id and text are one document and keep or lose the same lines. Empty
input, empty output; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bucket_order, bucketed, let, materialize, quoted, text_of

#: Words at a line's start or end by which dense groups are tried first.
ENDS = 5
#: A line that isn't blank.
ELIGIBLE = r"[^\x20\x09-\x0D]"
#: The sketch's slots, and how many of them make a page of it.
SKETCH_BITS = 19
SKETCH, PAGE = 1 << SKETCH_BITS, 1 << 10
HASH_BITS = 56
#: Bits of a word's hash by which prefix words are joined.
TOKEN = (1 << 31) - 1
#: A first line's place in the order of lines.
PLACE = ["none", "doc_id", "text_hash", "line_no"]


def _at() -> Column:
    """The place of a class's first line, as far as the document goes."""
    return F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("at")


def _names(low: Column) -> tuple[Column, Column]:
    """Two independent hashes of a lower-case line."""
    return F.xxhash64(low), F.xxhash64(F.lit("second"), low)


def _slot(h: Column) -> Column:
    """The sketch's bucket of a word's hash."""
    return F.shiftrightunsigned(h, 64 - SKETCH_BITS)


def _words(low: Column) -> Column:
    """The hashes of a lower-case line's distinct words, in order of appearance."""
    spaced = reduce(lambda x, c: F.replace(x, F.lit(c), F.lit(" ")), "\t\x0b\x0c\r", low)
    return F.array_remove(F.array_distinct(F.transform(F.split(spaced, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _lines(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    # posexplode_outer, since for posexplode Spark would split every text once more, to see that it has lines.
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode_outer(F.split(text, "\n")).alias("line_no", "line")).where(F.col("line").rlike(ELIGIBLE))
    lines = lines.withColumn("low", F.lower("line"))
    key, second = _names(F.col("low"))
    return lines.select(key.alias("key"), second.alias("second"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "line_no", "low").alias("at"))


def classes(docs: DataFrame) -> tuple[DataFrame, callable]:
    """key, PLACE and words of the first line of each class of equal lines: a table bucketed by key, and a function that drops it."""
    firsts = lambda rows, *by: rows.groupBy(*by).agg(F.min("at").alias("first"), (F.min("second") != F.max("second")).alias("clash"))
    own = lambda c: c.select("key", *[f"first.{x}" for x in PLACE], _words(F.col("first.low")).alias("words"), "clash")
    c, drop = bucketed(own(firsts(_lines(docs), "key")), "key")
    clashes = c.where("clash").select("key")
    if clashes.isEmpty():
        return c, drop
    # About n^2 / 2^65 names of n lines have unequal lines; their lines are named by both hashes.
    anew = _lines(docs).join(clashes, "key", "left_semi").withColumn("key", F.xxhash64("key", "second"))
    whole, drop_whole = bucketed(c.where("NOT clash").unionByName(own(firsts(anew, "key"))), "key")
    drop()
    return whole, drop_whole


def rarity(c: DataFrame) -> Column:
    """An array with a level for each of SKETCH hash buckets of words: 3 * log2 of the bucket's count in all classes, 94 at most.

    Counts are summed by bucket; buckets are then gathered in pages of fixed
    size, and the pages in one row, as a scalar subquery: the plans that look
    levels up name it, and don't spell it out on the driver as a literal would be.
    """
    slots = c.sparkSession.range(SKETCH).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("n"))
    counted = c.select(F.explode("words").alias("w")).groupBy(_slot(F.col("w")).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    level = F.least(F.lit(94), F.floor(3 * F.log2(F.greatest(F.sum("n"), F.lit(1))))).cast("long")
    dense = counted.union(slots).groupBy("slot").agg(level.alias("level"))
    pages = dense.groupBy(F.floor(F.col("slot") / PAGE).alias("page")).agg(F.sort_array(F.collect_list(F.col("slot") * 128 + F.col("level"))).alias("x"))
    stored = materialize(pages.select("page", F.transform("x", lambda x: (x % 128).cast("byte")).alias("levels")))
    return stored.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("page", "levels"))), lambda p: p["levels"]))).scalar()


def verified(pairs: DataFrame, c: DataFrame) -> DataFrame:
    """key of the later class of each pair (k1, k2) with a similarity of 0.8 or more.

    The pairs are written first, so that the shuffles that found them are gone
    before words are shuffled.
    """
    both = materialize(pairs)
    for i in (1, 2):
        both = both.join(c.select(F.col("key").alias(f"k{i}"), F.struct(*PLACE, "key").alias(f"at{i}"), F.col("words").alias(f"words{i}")), f"k{i}")
    similar = 9 * F.size(F.array_intersect("words1", "words2")) >= 4 * (F.size("words1") + F.size("words2"))
    return both.where(similar).select(F.greatest("at1", "at2")["key"].alias("key")).distinct()


def _settled(c: DataFrame) -> DataFrame:
    """key of classes with a similar earlier class that shares their first or last words."""
    head, tail = F.xxhash64(F.lit(0), F.slice("words", 1, ENDS)), F.xxhash64(F.lit(1), F.slice("words", -F.least(F.size("words"), F.lit(ENDS)), ENDS))
    # Which class of a group is tried only steers the work, so the order may be coarse.
    rows = c.select("key", _at(), F.explode(F.array(head, tail)).alias("sig"))
    lead = rows.groupBy("sig").agg(F.min_by("key", "at").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return verified(rows.join(lead, "sig").where("key <> lead").select(F.col("key").alias("k1"), F.col("lead").alias("k2")).distinct(), c)


def prefixes(c: DataFrame, sketch: Column) -> tuple[DataFrame, Callable[[], None]]:
    """key, at (order by document), settled, n (size), parity, last (place in the order of words where the prefix ends), head (the prefix's tokens, 0 for a word that no other class has) and twins (tokens that repeat others), bucketed by key; and a function that drops the table."""
    code = lambda h, levels: F.shiftleft(F.get(levels, _slot(h).cast("int")).cast("long"), HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - HASH_BITS))
    flip = lambda acc, x: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63).cast("long")).cast("int")))
    # 0 stands for a word of one class only; no other token is 0.
    token = lambda x: F.when(x >= 1 << HASH_BITS, x.bitwiseAND(F.lit(TOKEN).cast("long")).cast("int").bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    # A similar line shares at least ceil(0.8 n) words, so one of the first n - ceil(0.8 n) + 1.
    n = F.size("words")
    # A lambda can't name a subquery; so each word gets a reference to the sketch, which no row holds.
    ordered = F.sort_array(F.zip_with("words", F.array_repeat("sketch", n), code))
    head = F.slice(ordered, 1, n - F.ceil(4 * n / 5).cast("int") + 1)
    codes = c.withColumn("sketch", sketch).select("key", _at(), "settled", n.alias("n"), F.aggregate("words", F.lit(0).cast("long"), flip).alias("parity"), head.alias("head"))
    # Written before it is joined, so that the sketch is looked up once.
    heads = codes.withColumns({"last": F.element_at("head", -1), "head": F.transform("head", token)})
    known = F.array_remove("head", 0)
    return bucketed(heads.withColumn("twins", F.size(known) - F.size(F.array_distinct(known))), "key")


def _rows(bags: DataFrame) -> DataFrame:
    """tokens (the token in the upper half, in the lower the one before it, or 0), key, at, parity and x (size, the token's place by rarity, settled), a row for each token of a prefix that other classes may have."""
    rows = bags.select("key", "at", "settled", "n", "parity", "head", F.posexplode("head").alias("pos", "token")).where("token <> 0")
    packed = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.shiftleft(F.col("pos").cast("long"), 1)).bitwiseOR(F.col("settled").cast("long"))
    prev = F.coalesce(F.get("head", F.col("pos") - 1), F.lit(0)).cast("long")
    return rows.select(F.shiftleft(F.col("token").cast("long"), 32).bitwiseOR(prev).alias("tokens"), "key", "at", "parity", packed.alias("x"))


def _joined(rows: DataFrame) -> DataFrame:
    """later, earlier, tie and far: pairs of classes that pass the prefix, size, positional and parity filters.

    Both classes of a tie are of one document id, so either may be the later
    one. far: the bits in which their bitmaps differ.
    """
    a, b = rows.alias("a"), rows.alias("b")
    n = {s: F.shiftrightunsigned(f"{s}.x", 32) for s in "ab"}
    rest = {s: n[s] - F.shiftright(f"{s}.x", 1).bitwiseAND(F.lit((1 << 31) - 1).cast("long")) for s in "ab"}
    settled = {s: F.col(f"{s}.x").bitwiseAND(F.lit(1).cast("long")) == 1 for s in "ab"}
    sized = (5 * n["a"] >= 4 * n["b"]) & (5 * n["b"] >= 4 * n["a"])
    # At the first word they share, both lines must have as many words left as the overlap needs.
    far = F.bit_count(F.col("a.parity").bitwiseXOR(F.col("b.parity")))
    placed = (9 * rest["a"] >= 4 * (n["a"] + n["b"])) & (9 * rest["b"] >= 4 * (n["a"] + n["b"]))
    # a is the later one; of a tie, each pair is met once.
    open_ = (F.col("a.at") > F.col("b.at")) & ~settled["a"] | (F.col("a.at") == F.col("b.at")) & (F.col("a.key") > F.col("b.key")) & ~(settled["a"] & settled["b"])
    # Where the tokens before are shared too, the pair is met there, and passes the filters there if it does here.
    fresh = (F.col("a.tokens") != F.col("b.tokens")) | (F.col("a.tokens").bitwiseAND(F.lit(TOKEN).cast("long")) == 0)
    # The bitmaps come first, since they drop the most.
    pairs = a.hint("merge").join(b, (F.shiftright("a.tokens", 32) == F.shiftright("b.tokens", 32)) & (9 * far <= n["a"] + n["b"]) & open_ & sized & placed & fresh)
    return pairs.select(F.col("a.key").alias("later"), F.col("b.key").alias("earlier"), (F.col("a.at") == F.col("b.at")).alias("tie"), far.alias("far")).distinct()


def _near(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """Those of _joined's pairs whose prefixes share as many words as the overlap needs.

    The words of a prefix that ends first are, if shared, in the other one too;
    so the lines share those and what is left of its line at most.
    """
    both = pairs
    for side in ("later", "earlier"):
        both = both.join(bags.select(F.col("key").alias(side), *[F.col(x).alias(f"{side}_{x}") for x in ("n", "last", "twins", "head")]), side)
    rest = {s: F.col(f"{s}_n") - F.size(f"{s}_head") for s in ("later", "earlier")}
    left = F.when(F.col("later_last") <= F.col("earlier_last"), rest["later"]).otherwise(rest["earlier"])
    shared = F.size(F.array_intersect("later_head", "earlier_head")) + F.col("later_twins")
    return both.where(9 * (shared + left) >= 4 * (F.col("later_n") + F.col("earlier_n"))).select(*pairs.columns)


def _found(pairs: DataFrame, bags: DataFrame, c: DataFrame) -> DataFrame:
    """key of the later classes of the similar ones of _joined's pairs."""
    pairs = materialize(_near(materialize(pairs), bags))
    if pairs.count() <= c.count():
        return verified(pairs.select(F.col("later").alias("k1"), F.col("earlier").alias("k2")), c)
    nearest = pairs.groupBy("later").agg(F.min_by("earlier", "far").alias("k2"))
    first = materialize(verified(nearest.select(F.col("later").alias("k1"), "k2"), c))
    # A tie stays, since its other class may be the later one.
    left = pairs.join(first, pairs["later"] == first["key"], "left").where("key IS NULL OR tie")
    return first.union(verified(left.select(F.col("later").alias("k1"), F.col("earlier").alias("k2")), c))


def kept_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and kept (array of line_no): the lines with a word in them that stay.

    The classes are bucketed by key, so that all joins by key read them in
    place; their table is dropped at the end.
    """
    c, drop = classes(docs)
    try:
        with bucket_order(docs.sparkSession):
            settled = materialize(_settled(c))
            # Keys of settled are distinct, so what a task holds of them stays small, and c with its words needs no sort.
            marks = settled.withColumn("settled", F.lit(True)).hint("shuffle_hash")
            marked = c.join(marks, "key", "left").withColumn("settled", F.coalesce("settled", F.lit(False)))
            bags, drop_bags = prefixes(marked, rarity(c))
            try:
                found = materialize(_found(_joined(_rows(bags)), bags, c))
            finally:
                drop_bags()
            stay = c.select("key", "doc_id", "text_hash", "line_no").join(settled.union(found), "key", "left_anti")
            return materialize(stay.groupBy("doc_id", "text_hash").agg(F.collect_list("line_no").alias("kept")))
    finally:
        drop()


def _with_removed(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """columns, __n_lines and __removed (numbers of the lines that go)."""
    text = text_of(docs)
    number = lambda lines: F.struct(F.size(lines).alias("n"), F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(ELIGIBLE), i)), lambda i: i.isNotNull()).alias("some"))
    left = docs.select(*columns, docs["doc_id"].alias("__id"), F.xxhash64(text).alias("__hash"), let(F.split(text, "\n"), number).alias("__lines"))
    k = kept_lines(docs).select(F.col("doc_id").alias("__kid"), F.col("text_hash").alias("__khash"), F.col("kept").alias("__kept"))
    both = left.join(k, F.col("__id").eqNullSafe(F.col("__kid")) & (F.col("__hash") == F.col("__khash")), "left")
    return both.select("*", F.col("__lines.n").alias("__n_lines"), F.array_except("__lines.some", F.coalesce("__kept", F.array().cast("array<int>"))).alias("__removed"))


def decisions(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines and removed (array of line numbers from 0), one row a document."""
    df = _with_removed(docs, [docs["doc_id"].alias("__doc")])
    return df.select(F.col("__doc").alias("doc_id"), F.col("__n_lines").cast("long").alias("n_lines"), F.col("__removed").alias("removed"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with the removed lines cut out of text."""
    df = _with_removed(docs, [F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("__row")])
    # Lines tagged with their numbers are all different, so the difference of two arrays is linear and keeps every other line.
    tag = lambda x, i: F.concat(i.cast("string"), F.lit(":"), x)
    left = lambda lines: F.array_except(F.transform(lines, tag), F.transform("__removed", lambda i: tag(F.get(lines, i), i)))
    cut = F.array_join(F.transform(let(F.split("__row.text", "\n"), left), lambda x: F.substr(x, F.instr(x, ":") + 1)), "\n")
    text = F.when(F.size("__removed") == 0, F.col("__row.text")).otherwise(cut)
    return df.select(*[text.alias(c) if c == "text" else F.col(f"__row.{quoted(c)}").alias(c) for c in docs.columns])


def op10(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines (numbers from 0, comma-joined)."""
    d = decisions(docs)
    return d.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed_lines"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with later matches of lines removed from their texts."""
    return deduplicate(docs)


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no FROM documents
), e AS (
  SELECT row_number() OVER (ORDER BY doc_id, line_no) AS k, doc_id, line_no, list_distinct(regexp_extract_all(lower(x), '[^\x20\x09-\x0D]+')) AS w FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), t AS (
  SELECT k, len(w) AS n, unnest(w) AS u FROM e
), f AS (
  SELECT u, count(*) AS c FROM t GROUP BY u
), r AS (
  SELECT k, n, u, row_number() OVER (PARTITION BY k ORDER BY c, u) AS p FROM t JOIN f USING (u)
), x AS (
  SELECT k, n, u FROM r WHERE p <= n - (4 * n + 4) // 5 + 1
), c AS (
  SELECT DISTINCT a.k AS k, b.k AS j FROM x a JOIN x b USING (u) WHERE b.k < a.k AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), g AS (
  SELECT DISTINCT c.k FROM c JOIN e a ON a.k = c.k JOIN e b ON b.k = c.j WHERE 9 * len(list_intersect(a.w, b.w)) >= 4 * (len(a.w) + len(b.w))
), d AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS s FROM e JOIN g USING (k) GROUP BY doc_id
)
SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(s, '') AS removed_lines
FROM documents LEFT JOIN d USING (doc_id)
"""
