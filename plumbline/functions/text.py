"""Text-form features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.schema import let

#: What counts as an emoji, a run of punctuation, an elongation and an ellipsis.
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{1F1E6}-\x{1F1FF}]"
PUNCT_RUN = r"[!?.,;:/\\|\-_*\x{2026}]{2,}"
ELONGATED = r"(?d)(.)\1{2,}"
ELLIPSIS = r"\.{3,}|\x{2026}"
SPACE = r"(?U)[\s\x1c-\x1f]+"
DIGIT = r"(?U)\d"


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def ascii_only(text: Column) -> Column:
    """Whether a text has as many bytes as characters: then what lies beyond ASCII needs no search."""
    return F.octet_length(text) == F.length(text)


def beyond_ascii(text: Column, pattern: str) -> Column:
    """count, of a pattern that only characters beyond ASCII match."""
    return F.when(ascii_only(text), F.lit(0).cast("long")).otherwise(count(text, pattern))


def left_of(text: Column, others: str) -> Column:
    """Characters left when runs of the others are cut: far fewer matches than one a character."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def matched(text: Column, some: str) -> Column:
    """Characters in runs of some: as many as a count of single ones has, but with a match a run."""
    return F.length(text).cast("long") - left_of(text, some)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole within 0 and 1; 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), part / whole)))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda t: t != "")


def token_stats(text: Column) -> Column:
    """A struct of n and n_distinct; distinct by exact spelling."""
    return let(tokens(text), lambda t: F.struct(F.size(t).cast("long").alias("n"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct")))


def length_bucket(n_tokens: Column, n_chars: Column, short_tokens_max: int = 8, long_chars_min: int = 200) -> Column:
    return F.when(n_tokens <= short_tokens_max, "short").when(n_chars >= long_chars_min, "long").otherwise("medium")


def text_form(text: Column, stats: Column, short_tokens_max: int = 8, long_chars_min: int = 200) -> dict[str, Column]:
    """The ten text-form columns; stats: a column made by token_stats."""
    n = F.length(text).cast("long")
    return {
        "char_len": n,
        "token_len": stats["n"],
        "length_bucket": length_bucket(stats["n"], n, short_tokens_max, long_chars_min),
        "emoji_count": beyond_ascii(text, EMOJI),
        "punct_runs": count(text, PUNCT_RUN),
        "elong_runs": count(text, ELONGATED),
        "ellipsis_runs": count(text, ELLIPSIS),
        "upper_ratio": let(F.struct(matched(text, "[A-Z]+").alias("upper"), matched(text, "[A-Za-z]+").alias("letters")), lambda x: ratio(x["upper"], x["letters"])),
        "digit_ratio": ratio(count(text, DIGIT), n),
        "unique_token_ratio": ratio(stats["n_distinct"], stats["n"]),
    }


def language(text: Column, nonlatin_flag: float = 0.25) -> dict[str, Column]:
    """ascii_ratio, nonlatin_ratio and lang_hint_non_en."""
    n = F.length(text).cast("long")
    nonlatin = ratio(beyond_ascii(text, r"[^\x{0000}-\x{024F}]"), n)
    return {
        "ascii_ratio": ratio(F.when(ascii_only(text), n).otherwise(n - left_of(text, r"[\x00-\x7F]+")), n),
        "nonlatin_ratio": nonlatin,
        "lang_hint_non_en": (nonlatin > nonlatin_flag).cast("int"),
    }


def shorten(text: Column, n: int) -> Column:
    """The first n characters, with an ellipsis where some were cut."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("…"))).otherwise(text)
