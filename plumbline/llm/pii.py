"""Personal data by weak supervision (operator 3).

Candidates are the base matches (email, ip, card, phone) and near misses: the
same shapes under looser patterns. Five labelers vote on each candidate, from
different evidence: its structure (grouping, check digit, number ranges),
gazetteers (reserved address ranges, card issuers with their lengths, country
calling codes, top-level domains), words just before it that speak for the kind,
words that speak against it (versions, orders, part numbers), and the document
(whether other personal data stands near it). Expectation-maximisation on the counts of vote
patterns (a table of fixed size) estimates each labeler's reliability for each
kind, and with it a posterior for each pattern. A final logistic span
classifier is trained on the candidates' features, with the posteriors as soft
labels, again from counts of feature masks (at most 2 ** FEATURES for a kind).
Base spans always stay; others are added if the classifier says so and they
overlap no base span.

Edge cases: a null or empty text has no spans. Repeated rows are treated row by
row. Empty input, empty output; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import joined, let, materialize

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("structure", "gazetteer", "context", "contrary", "document")
#: A candidate's feature mask: two bits a labeler (voted yes, voted no), then shape bits.
FEATURES = 2 * len(LABELERS) + 3
CONTEXT = 40
#: Characters within which other candidates count as near.
NEAR = 200

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can't start inside a run of digits where it failed at the run's start, so runs are entered at their start only.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9-])")
_OBFUSCATED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(.](?:dot|DOT)?[\])]? ?[A-Za-z0-9-]{2,63}){1,4}")
_CONTEXT = {
    "email": re.compile(r"e-?mail|contact|write to|reach|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|client|login|adresse", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|debit|payment|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|\btel\b|call|mobile|cell|fax|contact|telefon|téléphone|teléfono", re.I),
}
_CONTRARY = re.compile(r"version|\bv\.?$|isbn|order|serial|invoice|section|figure|page|model|build|release|chapter|\bsku\b|part (?:no|number)|tracking|\bid\b", re.I)
#: Issuer prefixes of payment cards with the lengths of their numbers, generic top-level domains, and country calling codes by first digits.
_ISSUERS = {"4": (13, 16, 19), "51": (16,), "52": (16,), "53": (16,), "54": (16,), "55": (16,), "22": (16,), "23": (16,), "24": (16,), "25": (16,), "26": (16,), "27": (16,), "34": (15,), "37": (15,), "36": (14, 16, 19), "38": (14, 16, 19), "60": (16, 19), "62": (16, 17, 18, 19), "64": (16, 19), "65": (16, 19), "35": (16, 19)}
_DOMAINS = frozenset("com org net edu gov mil int info io co us uk de fr es it nl eu ca au jp cn in br ru ch at be se no dk pl".split())
_CALLING = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "5", "6", "7", "81", "82", "84", "86", "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@..., found from their @ signs, so in linear time."""
    free, low, at = 0, 0, text.find("@")
    while at >= 0:
        run = text[max(low, free) : at]
        start = at - (len(run) - len(run.rstrip(_LOCAL)))
        if start < at and at >= free and (m := _EMAIL_TAIL.match(text, at)):
            yield start, m.end()
            free = m.end()
        low = at + 1
        at = text.find("@", low)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind."""
    out = [(a, b, "email") for a, b in _emails(text)]
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if _small(m[0].split("."))]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _near_misses(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _IP.finditer(text):
        if not _small(m[0].split(".")):
            yield m.start(), m.end(), "ip"
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and not (len(d) >= 14 and luhn(d)):
            yield m.start(), m.end(), "card"
    for m in _LOOSE_PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 12:
            yield m.start(), m.end(), "phone"
    if re.search(r"[\[(](?:at|AT)[\])]", text):
        for m in _OBFUSCATED.finditer(text):
            yield m.start(), m.end(), "email"


def _structured(s: str, d: str, kind: str) -> bool | None:
    """Whether a candidate is built as its kind is written; None: it doesn't say."""
    if kind == "email":
        local, _, host = s.partition("@")
        if not host:
            return None  # an obfuscated one
        return not (local.startswith(".") or local.endswith(".") or ".." in local) and all(x.strip("-") == x for x in host.split(".")) and host.rpartition(".")[2].isalpha()
    if kind == "ip":
        parts = s.split(".")
        return _small(parts) and all(x == "0" or not x.startswith("0") for x in parts)
    if kind == "card":
        groups = [len(x) for x in re.split(r"[ -]", s)]
        even = len(groups) == 1 or groups in ([4, 6, 5], [4, 6, 4]) or (set(groups[:-1]) == {4} and groups[-1] <= 4)
        return luhn(d) and even
    marks = set(re.findall(r"(?<=[0-9])[ .-](?=[0-9])", s))
    return s.count("(") == s.count(")") and len(marks) <= 1


def _listed(s: str, d: str, kind: str) -> bool:
    """Whether a gazetteer has the candidate's telling part."""
    if kind == "email":
        return re.split(r"[.\s)\]]+", s.lower())[-1] in _DOMAINS
    if kind == "ip":
        first = int(s.split(".")[0][-3:])
        return _small(s.split(".")) and 0 < first < 224 and first != 127
    if kind == "card":
        return any(d.startswith(x) and len(d) in lengths for x, lengths in _ISSUERS.items())
    if s[0] == "+":
        return d.startswith(_CALLING)
    return len(d) == 10 and d[0] not in "01" and d[3] not in "01"  # the form of a number without a calling code


def votes(text: str, start: int, end: int, kind: str, near: bool) -> tuple[int, int]:
    """The candidate's vote pattern (two bits a labeler) and feature mask."""
    s, before = text[start:end], text[max(0, start - CONTEXT) : start]
    d = _digits(s)
    built, listed = _structured(s, d, kind), _listed(s, d, kind)
    yes = (built is True, listed, bool(_CONTEXT[kind].search(before)), False, near)
    no = (built is False, not listed, False, bool(_CONTRARY.search(before)), False)
    pattern = sum(1 << (2 * i) for i, v in enumerate(yes) if v) | sum(1 << (2 * i + 1) for i, v in enumerate(no) if v)
    edge = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    grouped = kind in ("card", "phone") and any(not c.isdigit() for c in s[1:])
    shape = (1 << 2 * len(LABELERS)) * (edge + 2 * grouped + 4 * (len(set(d)) <= 3))
    return pattern, pattern | shape


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (kind:start:end, comma-joined) and others: near misses that overlap no base span, with their kinds, votes and features."""
    fields = "array<struct<kind:string,start:long,end:long,votes:int,features:int,base:boolean>>"

    @F.pandas_udf(fields)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([_spans(x or "") for x in batch], dtype=object)

    return docs.select("doc_id", find(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("spans"))


def _spans(text: str) -> list[dict]:
    base = base_spans(text)
    out = [(a, b, kind, True) for a, b, kind in base]
    # Near misses keep clear of base spans and of those accepted before them.
    taken = sorted((a, b) for a, b, _ in base)
    reach, ends = [], 0
    for _, b in taken:
        ends = max(ends, b)
        reach.append(ends)
    starts, last = [a for a, _ in taken], 0
    for a, b, kind in sorted(_near_misses(text)):
        i = bisect_right(starts, b - 1)
        if a >= last and not (i and reach[i - 1] > a):
            out.append((a, b, kind, False))
            last = b
    rows = []
    out.sort()
    for i, (a, b, kind, is_base) in enumerate(out):
        near = (i > 0 and a - out[i - 1][1] <= NEAR) or (i + 1 < len(out) and out[i + 1][0] - b <= NEAR)
        pattern, mask = votes(text, a, b, kind, near)
        rows.append({"kind": kind, "start": a, "end": b, "votes": pattern, "features": mask, "base": is_base})
    return rows


def reliabilities(counts: pd.DataFrame, rounds: int = 50) -> pd.Series:
    """Posterior of each row of counts (votes, n) of one kind, by Dawid-Skene EM with abstentions.

    Labelers start as better than chance, which fixes the sign.
    """
    v = np.zeros((len(counts), len(LABELERS)), int)
    for i in range(len(LABELERS)):
        v[:, i] = (counts["votes"].to_numpy() >> (2 * i) & 1) - (counts["votes"].to_numpy() >> (2 * i + 1) & 1)
    n = counts["n"].to_numpy(float)
    prior, hit, false = 0.5, np.full((len(LABELERS), 3), 1 / 3), np.full((len(LABELERS), 3), 1 / 3)
    hit[:], false[:] = (0.1, 0.3, 0.6), (0.6, 0.3, 0.1)  # P(vote -1, 0, 1 | personal), P(... | not)
    p = np.full(len(counts), 0.5)
    for _ in range(rounds):
        a = math.log(prior) + sum(np.log(hit[i, v[:, i] + 1]) for i in range(len(LABELERS)))
        b = math.log(1 - prior) + sum(np.log(false[i, v[:, i] + 1]) for i in range(len(LABELERS)))
        p = 1 / (1 + np.exp(np.clip(b - a, -50, 50)))
        prior = float(np.clip((p @ n + 1) / (n.sum() + 2), 1e-3, 1 - 1e-3))
        for i in range(len(LABELERS)):
            for x in (-1, 0, 1):  # with the starting beliefs as ten pseudo-counts
                at = v[:, i] == x
                hit[i, x + 1] = (n[at] @ p[at] + 10 * (0.1, 0.3, 0.6)[x + 1]) / (n @ p + 10)
                false[i, x + 1] = (n[at] @ (1 - p[at]) + 10 * (0.6, 0.3, 0.1)[x + 1]) / (n @ (1 - p) + 10)
    return pd.Series(p, counts.index)


def train(counts: pd.DataFrame) -> dict[str, list[float]]:
    """For each kind the span classifier's weights (bias last), from counts (kind, votes, features, n)."""
    model = {}
    for kind, c in counts.groupby("kind"):
        patterns = c.groupby("votes", as_index=False)["n"].sum()
        soft = dict(zip(patterns["votes"], reliabilities(patterns), strict=True))
        x = np.array([[m >> i & 1 for i in range(FEATURES)] + [1] for m in c["features"]], float)
        y, n = c["votes"].map(soft).to_numpy(), c["n"].to_numpy(float)
        w = np.zeros(FEATURES + 1)
        for _ in range(50):  # Newton steps with a ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (n * (p - y)) + 0.5 * w
            hess = (x * (n * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w -= np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-8:
                break
        model[kind] = w.tolist()
    return model


def detect(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id and spans: array of kind, start, end, base, score; all base spans and the added ones."""
    found = materialize(candidates(docs))
    each = found.select(F.inline("spans"))
    counts = each.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")).toPandas()  # at most 4 * 2 ** FEATURES rows
    model = train(counts.sort_values(["kind", "votes", "features"], ignore_index=True))
    weights = F.create_map(*[x for kind, w in sorted(model.items()) for x in (F.lit(kind), F.array(*map(F.lit, w)))]) if model else None

    def rated(s: Column) -> Column:
        logit = lambda w: F.aggregate(F.sequence(F.lit(0), F.lit(FEATURES - 1)), F.get(w, F.lit(FEATURES)), lambda acc, i: acc + F.when(F.call_function("shiftright", s["features"], i).bitwiseAND(F.lit(1)) == 1, F.get(w, i)).otherwise(0.0))
        score = 1 / (1 + F.exp(-let(F.try_element_at(weights, s["kind"]), logit))) if model else F.lit(0.0)
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"), score.alias("score"))

    return found.select("doc_id", F.filter(F.transform("spans", rated), lambda s: s["base"] | (s["score"] >= threshold)).alias("spans"))


def op3(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    def digest(spans: Column) -> Column:
        base = F.filter(spans, lambda s: s["base"])
        n = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
        return F.struct(*map(n, KINDS), F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(spans, KINDS).alias("spans"))

    return detect(docs).select("doc_id", let(F.col("spans"), digest).alias("d")).select("doc_id", "d.*")


def base_digest(text: str | None) -> str:
    """base_sha256 of one text, for tests."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base_spans(text or "")).encode()).hexdigest()
