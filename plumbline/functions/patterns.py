"""Promotional, hearsay and relevancy signals as column expressions.

Java patterns; (?U) gives \\w, \\d, \\s and \\b their Unicode meaning.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.schema import safe_text
from plumbline.functions.text import DIGIT, count

#: Top-level domains, shortener hosts and lexicons that the signals are defined by.
TOP_LEVEL = ("com", "net", "org", "io", "co", "ai", "me", "shop", "store", "biz", "info", "app", "site", "uk", "us", "ca", "sg")
SHORTENERS = ("bit.ly", "t.co", "goo.gl", "tinyurl.com", "lnkd.in", "rebrand.ly", "is.gd", "buff.ly", "ow.ly", "cutt.ly")
LEXICONS = {
    "promo": ["promo", "discount", "code", "deal", "sale", "free", "offer", "dm", "whatsapp"],
    "contact": ["call", "text", "email", "whatsapp", "dm", "pm"],
    "nonvisit": ["never been", "i heard", "i was told", "someone said", "people say", "won't go", "would not go"],
    "offtopic": ["iphone", "android", "laptop", "gpu", "ram", "graphics card", "airpods"],
}
#: Nothing follows the end of a text.
NOTHING = r"\z."


def _quoted(words) -> str:
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)


def lexicon(terms: list[str]) -> str:
    """A pattern for any of the terms as whole words, in any case; a space stands for any white space, a hyphen may be missing; without terms, one that no text has."""
    found = []
    for term in filter(None, map(str.strip, terms)):
        pieces = re.split(r"([ -])", term)
        found.append("".join({" ": r"\s+", "-": r"[-_\s]?"}.get(p) or _quoted([p]) for p in pieces))
    return rf"(?iU)\b(?:{'|'.join(found)})\b" if found else NOTHING


def domains(top_level=TOP_LEVEL) -> str:
    """A pattern for bare host names under the given top-level domains, with an optional path."""
    ends = [w.strip(". ").lower() for w in top_level if w]
    label = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
    return rf"(?iU)\b(?:{label}\.)+(?:{_quoted(ends)})(?:/\S*)?\b" if ends else NOTHING


#: The shapes that the flags are defined by.
FLAGS = {
    "has_url": r"(?iU)\b(?:https?://|www\.)\S+\b",
    "has_domain": domains(),
    "has_short_url": rf"(?iU)\b(?:{_quoted(SHORTENERS)})/\S+\b",
    "has_phone_us": r"(?U)(?:\+?1[\s.-]?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}",
    "has_phone_any": r"(?U)\+?\d[\d\s().-]{7,}\d",
    "has_email": r"(?iU)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "has_social_handle": r"(?iU)(?:^|[\s:])@[\w.]{2,}",
    "has_hashtag": r"(?U)(?:^|\s)#\w{2,}",
    "has_currency": r"(?iU)\b(?:USD|SGD|US\$|S\$|\$)\s?\d{1,4}(?:[.,]\d{3})*(?:\.\d{2})?\b",
    "has_percent_off": r"(?iU)\b\d{1,3}\s?%(?:\s*off|\s*discount|)\b",
    "has_promo_code": r"(?iU)\b(?:use|apply|enter)\s+(?:code|coupon)\s+[A-Z0-9-]{4,}\b",
    "has_cta": r"(?iU)\b(?:(?:dm|pm|message|whatsapp|telegram|call|text)\s+(?:me|us|now)|order now|limited time|link in bio)\b",
}
#: Letters outside ASCII that patterns without case take for s, k and i.
ALIKE = ("\u017f", "\u212a", "\u0130", "\u0131")
STAR_RATING = r"(?iU)\b[0-5](?:\.[0-9])?(?:/5|\s*stars?)\b"


def _holds(text: Column, words) -> Column:
    """Whether the text has any of the lower-case words in any case, or a letter that such a test may miss."""
    return reduce(lambda a, b: a | b, [F.lower(text).contains(w) for w in words] + [text.contains(c) for c in ALIKE])


def possible(name: str, text: Column) -> Column:
    """A cheap test that every text with the flag passes: parts that its pattern can't do without. Most texts fail it."""
    digits = count(text, DIGIT) > 0  # the expression of digit_ratio, so evaluated once
    wide = reduce(lambda a, b: a | b, [text.contains(w) for w in ("ww", "WW", "wW", "Ww")])
    return {
        "has_url": text.contains("://") | wide,
        "has_domain": text.rlike(rf"(?iU)\.(?:{_quoted(TOP_LEVEL)})"),
        "has_short_url": text.contains("/"),
        "has_phone_us": digits,
        "has_phone_any": digits,
        "has_email": text.contains("@"),
        "has_social_handle": text.contains("@"),
        "has_hashtag": text.contains("#"),
        "has_currency": digits,
        "has_percent_off": text.contains("%"),
        "has_promo_code": _holds(text, ("code", "coupon")),
        "has_cta": _holds(text, ("dm", "pm", "message", "whatsapp", "telegram", "call", "text", "order now", "limited time", "link in bio")),
    }[name]


def flag(name: str, text: Column) -> Column:
    """Whether the text has the flag's pattern; a null text has not."""
    return F.when(possible(name, text), text.rlike(FLAGS[name])).otherwise(F.lit(False))


def hits(text: Column, terms: list[str]) -> Column:
    """How many of the terms' occurrences the text has; none for a null text."""
    words = [max(re.split(r"[\s-]+", t.strip().lower()), key=len) for t in terms if t.strip()]
    if not words:
        return F.lit(0).cast("long")
    if not all(w.isascii() for w in words):
        return F.coalesce(count(text, lexicon(terms)), F.lit(0).cast("long"))
    return F.when(_holds(text, words), count(text, lexicon(terms))).otherwise(F.lit(0).cast("long"))


def promotion(text: Column, lexicons: dict = LEXICONS) -> dict[str, Column]:
    """The twelve flags, promo_hits and contact_hits."""
    out = {name: flag(name, text) for name in FLAGS}
    return out | {f"{k}_hits": hits(text, lexicons.get(k, [])) for k in ("promo", "contact")}


def nonvisit(text: Column, lexicons: dict = LEXICONS) -> dict[str, Column]:
    return {"nonvisit_hits": hits(text, lexicons.get("nonvisit", []))}


def relevancy(text: Column, columns: list[str], lexicons: dict = LEXICONS) -> dict[str, Column]:
    """offtopic_hits, star_rating_mention and, for the first category column there is, mentions_<column>."""
    stars = F.when(count(text, DIGIT) > 0, text.rlike(STAR_RATING)).otherwise(F.lit(False))
    out = {"offtopic_hits": hits(text, lexicons.get("offtopic", [])), "star_rating_mention": stars}
    for c in ("category", "categories", "types"):
        if c in columns:
            return out | {f"mentions_{c}": mentions(text, F.col(c))}
    return out


def mentions(text: Column, category: Column) -> Column:
    """Whether any word of the category (a string or an array) is part of the text, in any case."""
    words = F.filter(F.split(F.regexp_replace(F.lower(safe_text(category)), r"[^a-z0-9\s]", " "), r"\s+"), lambda t: t != "")
    return F.exists(words, lambda w: F.lower(text).contains(w))
