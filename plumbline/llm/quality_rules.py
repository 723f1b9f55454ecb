"""Quality rules as a bitmask ledger (operator 8, native).

Every rule is evaluated once a document. The ledger keeps the measurements and
one bit a rule (1: the rule fails). A policy is a version and a mask of the
rules it enforces, so a new policy, or an ablation, needs the ledger only and
never reads the texts again.

Edge cases: a null text is the empty text, which has no words and fails
``few_words``. Repeated rows are judged row by row. An empty table gives an
empty ledger. Other columns of the input don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import WORD, let, quoted, text_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters")


@dataclass(frozen=True)
class Rule:
    """fails: SQL over MEASURES, true where a document fails."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule(5, "few_letters", "2 * n_letters < word_chars"),
    Rule(6, "capitals", "2 * n_upper > n_letters AND n_letters > 0"),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << r.bit for r in RULES if r.name in self.rules)


#: Policies by version; a published version is never changed.
POLICIES = {1: Policy(1, BASE), 2: Policy(2, tuple(r.name for r in RULES))}


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.

    The windows' hashes are sorted with their positions, so equal windows are
    neighbours: n log n in a row, without a shuffle.
    """
    n = F.size(words)
    windows = F.transform(
        F.slice(words, 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )

    def starts(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    return let(F.sort_array(windows), lambda s: let(starts(s), covered))


def measurements(text: Column) -> Column:
    """A struct of MEASURES."""
    count = lambda c: c.cast("long")
    of_words = let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(count(F.size(w)).alias("n_words"), count(F.length(F.array_join(w, ""))).alias("word_chars"), _repeat_words(w).alias("n_repeat_words")),
    )
    of_lines = let(
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
        lambda x: F.struct(count(F.size(x)).alias("n_lines"), count(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")),
    )
    chars = lambda pattern: count(F.regexp_count(text, F.lit(pattern)))
    return F.struct(of_words.alias("w"), of_lines.alias("l"), chars(r"[#*$%&|<>]").alias("n_symbols"), chars(r"\p{Lu}").alias("n_upper"), count(F.length(F.regexp_replace(text, r"\P{L}+", ""))).alias("n_letters"))


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, MEASURES and fail_bits (long): one row a document, one scan, no shuffle."""
    m = docs.select(*[docs[c] for c in keep], measurements(text_of(docs)).alias("__m"))
    m = m.select(*keep, "__m.w.*", "__m.l.*", "__m.n_symbols", "__m.n_upper", "__m.n_letters")
    bits = reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES))
    return m.withColumn("fail_bits", bits)


def apply_policy(book: DataFrame, version: int = max(POLICIES)) -> DataFrame:
    """The ledger with base_failed, kept and policy_version."""
    failed = lambda mask: F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")) != 0
    return book.withColumns({"base_failed": failed(POLICIES[1].mask), "kept": ~failed(POLICIES[1].mask | POLICIES[version].mask), "policy_version": F.lit(version)})


def ablations(book: DataFrame, version: int = max(POLICIES)) -> DataFrame:
    """For each rule of a policy: rule, n_failed, n_only (documents that no other rule of it rejects) and n_kept_without.

    Documents are first counted by their masked bits, at most 2 ** len(RULES)
    groups, so that the ablation itself works on a table of fixed size.
    """
    mask = POLICIES[version].mask
    groups = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in RULES if mask >> r.bit & 1])
    each = groups.select("bits", "n", F.inline(rules))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    return each.groupBy("rule").agg(total(F.col("bits").bitwiseAND(F.col("bit")) != 0)("n_failed"), total(F.col("bits") == F.col("bit"))("n_only"), total(rest == 0)("n_kept_without"))


def op8(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and the ledger's other columns."""
    return apply_policy(ledger(docs))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the newest policy keeps, with their own columns."""
    held = docs.withColumn("__text", text_of(docs))
    judged = ledger(held.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("__row"), F.col("__text").alias("text")), ("__row",))
    return apply_policy(judged).where("kept").select("__row.*")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3
), gg AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM g
), r AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM gg WHERE c >= 2) GROUP BY doc_id
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS BIGINT) AS n_upper,
    CAST(length(regexp_replace(text, '\P{L}+', '', 'g')) AS BIGINT) AS n_letters
  FROM w LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (word_chars < 2 * n_words OR word_chars > 12 * n_words)::INT
    + 32 * (2 * n_letters < word_chars)::INT + 64 * (2 * n_upper > n_letters AND n_letters > 0)::INT AS BIGINT) AS fail_bits
  FROM m
)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, 2 AS policy_version FROM b
"""
