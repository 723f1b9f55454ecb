"""Secrets by a randomness test battery (operator 1, native).

Base spans come from patterns. The method adds spans: each long token of an
encoding alphabet is a candidate, its encoding is inferred, and three tests
look at its symbols' values: chi-squared uniformity over the alphabet, runs
about the alphabet's middle, and serial correlation at lag 1. A random string
passes runs and serial tests; and its chi-squared is far below what ordinary
text over that alphabet gives. In alphabets of letters and digits whose tokens
are in one case, it also changes between letters and digits far more often than
ordinary tokens, whose digits stand together. Both are z scores under "ordinary
text", taken together by their sum over its deviation (Stouffer), and fall with
length, so short tokens pass less often. Benjamini-Hochberg over
all candidates, in strata of encoding and length, holds the share of false
discoveries at FDR; it needs only counts by stratum and p-value bin, a table of
fixed size.

Everything is DataFrame expressions. Positions of matches come from the gaps
between them (split) and a prefix sum by doubling; candidates that overlap a base
span are found by a prefix maximum of ends and a suffix minimum of starts, in the
same way, so a text with very many of both takes n log n. Texts are read once:
spans and tests, which are small, are written before the thresholds are counted.

Edge cases: a null or empty text has no spans. Repeated rows are treated row by
row, though each counts in the false-discovery rate. Empty input, empty output;
other columns don't matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import joined, let, materialize, text_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: The runs of [0-9a-f]+ that have 24 characters or more.
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
#: A text that has no base match of any kind, in one cheap look.
BASE = ASSIGN + r"|AKIA[A-Z0-9]{16}|(?<![0-9a-f])[0-9a-f]{24}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
FDR = 0.01
ALPHA = 0.001
#: Encodings in order of inference: name, pattern, alphabet, and of ordinary text in it the repeat rate (sum of squared symbol frequencies) and the rate of changes between letters and digits, 0 where it isn't looked at.
ENCODINGS = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.10, 0.15),
    ("lower", r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz", 0.065, 0.0),
    ("base32", r"^[A-Z2-7]+=*$", "abcdefghijklmnopqrstuvwxyz234567", 0.065, 0.05),
    ("base36", r"^(?:[a-z0-9]+|[A-Z0-9]+)$", "0123456789abcdefghijklmnopqrstuvwxyz", 0.060, 0.10),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.060, 0.0),
)
STRATA = (24, 32, 48, 64, 128)
BINS = 400


def _places(text: Column, pattern: str, kind: str, good=None) -> Column:
    """Array of (kind, start, end, value): the pattern's matches, leftmost and without overlap, for which good(value) holds."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def at(m: Column) -> Column:
        # Gap k lies before match k; a match's start is the sum of the gaps up to it and the matches before it.
        steps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(m)), lambda g, i: F.length(g) + F.coalesce(F.length(F.get(m, i - 1)), F.lit(0)))
        rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(m).cast("double"))).cast("int"))
        double = lambda a, k: F.transform(a, lambda x, i: x + F.coalesce(F.get(a, i - F.pow(F.lit(2.0), k).cast("int")), F.lit(0)))
        starts = F.aggregate(rounds, steps, double)
        spans = let(starts, lambda s: F.transform(m, lambda v, i: F.struct(F.lit(kind).alias("kind"), F.get(s, i).cast("long").alias("start"), (F.get(s, i) + F.length(v)).cast("long").alias("end"), v.alias("value"))))
        return F.filter(spans, lambda x: good(x["value"])) if good else spans

    return let(found, lambda m: F.when(F.size(m) > 0, at(m)).otherwise(F.array().cast(SPANS)))


SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _scan(values: Column, op, step: int) -> Column:
    """The running op over an array, from the front (step -1) or the back (step 1), by doubling."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)).cast("double"))).cast("int"))
    near = lambda a, i, k: F.get(a, i + step * F.pow(F.lit(2.0), k).cast("int"))
    return F.aggregate(rounds, values, lambda a, k: F.transform(a, lambda x, i: op(x, F.coalesce(near(a, i, k), x))))


def _free(tokens: Column, base: Column) -> Column:
    """The tokens (apart from each other) that overlap no base span."""
    entry = lambda kind: lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("token"), s["end"].alias("end"), s["value"].alias("value"))

    def sweep(m: Column) -> Column:
        ends = _scan(F.transform(m, lambda x: F.when(x["token"] == 0, x["end"]).otherwise(F.lit(-1).cast("long"))), F.greatest, -1)
        starts = _scan(F.transform(m, lambda x: F.when(x["token"] == 0, x["start"]).otherwise(F.lit((1 << 62)).cast("long"))), F.least, 1)
        return let(F.struct(ends.alias("ends"), starts.alias("starts")), lambda s: F.filter(m, lambda x, i: (x["token"] == 1) & (F.get(s["ends"], i) <= x["start"]) & (F.get(s["starts"], i) >= x["end"])))

    merged = F.sort_array(F.concat(F.transform(base, entry(0)), F.transform(tokens, entry(1))))
    kept = F.transform(let(merged, sweep), lambda x: F.struct(F.lit("random").alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))
    return F.when((F.size(base) == 0) | (F.size(tokens) == 0), tokens).otherwise(kept)


def base_spans(text: Column) -> Column:
    ok = lambda v: F.length(F.regexp_extract(v, ASSIGN, 1)) >= 6
    # Without a run long enough there is no match to keep, so most texts skip the exact walk over all short runs.
    kinds = (
        F.when(text.rlike(ASSIGN), _places(text, ASSIGN, "assign", ok)),
        F.when(text.rlike(r"AKIA[A-Z0-9]{16}"), _places(text, ACCESS, "access", lambda v: F.length(v) >= 20)),
        F.when(text.rlike(r"[0-9a-f]{24}"), _places(text, HEX, "hex")),
    )
    return F.flatten(F.array(*[F.coalesce(k, F.array().cast(SPANS)) for k in kinds]))


def _normal(z: Column) -> Column:
    """P(Z <= z) for a standard normal Z, by the logistic approximation 1 / (1 + exp(-1.5976 z - 0.07056 z^3))."""
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def _squares(values: Column) -> Column:
    """The sum of the squared counts of the distinct values: in sorted order, the k-th of a run of equal ones adds 2 k - 1."""
    def step(a: Column, x: Column) -> Column:
        run = F.when(a["last"] == x, a["run"] + 1).otherwise(F.lit(1.0))
        return F.struct(x.alias("last"), run.alias("run"), (a["total"] + 2 * run - 1).alias("total"))

    start = F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))
    return F.aggregate(F.array_sort(values), start, step, lambda a: a["total"])


def _battery(value: Column) -> Column:
    """encoding, n, z_text (chi-squared and letter-digit changes against ordinary text), z_runs, z_serial of one candidate."""
    which = reduce(lambda rest, i: F.when(value.rlike(ENCODINGS[i][1]), F.lit(i)).otherwise(rest), reversed(range(len(ENCODINGS))), F.lit(len(ENCODINGS) - 1))
    pick = lambda i, k: F.element_at(F.array(*[F.lit(e[k] if k else e[0]) for e in ENCODINGS]), (i + 1).cast("int"))
    symbols = F.regexp_replace(value, "=+$", "")

    def tests(i: Column) -> Column:
        folded = F.translate(F.when(i < 4, F.lower(symbols)).otherwise(symbols), "_-", "/+")
        pieces = F.split(folded, "")
        values = F.transform(pieces, lambda c: (F.instr(pick(i, 2), c) - 1).cast("double"))

        def of(v: Column) -> Column:
            n, k = F.size(v).cast("double"), F.length(pick(i, 2)).cast("double")
            squares = _squares(F.filter(v, lambda x: x >= 0))
            chi = squares * k / n - n
            excess = k * pick(i, 3) - 1
            z_text = (chi - (k - 1) - n * excess) / F.sqrt(2 * (k - 1) + 4 * n * excess)
            # Square roots of a count keep the upper tail of few changes below a normal one's.
            digit = lambda j: F.get(pieces, j).rlike("[0-9]")
            changes = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.size(v) - 1, F.lit(1))), lambda j: digit(j) != digit(j - 1))).cast("double")
            z_change = 2 * (F.sqrt(changes) - F.sqrt((n - 1) * pick(i, 4)))
            z_text = F.when(pick(i, 4) > 0, (z_text - z_change) / F.sqrt(F.lit(2.0))).otherwise(z_text)
            z_random = (chi - (k - 1)) / F.sqrt(2 * (k - 1))
            high = F.size(F.filter(v, lambda x: x >= k / 2)).cast("double")
            low = n - high
            runs = 1 + F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.size(v) - 1, F.lit(1))), lambda j: (F.get(v, j) >= k / 2) != (F.get(v, j - 1) >= k / 2)))
            mean = 2 * high * low / n + 1
            var = 2 * high * low * (2 * high * low - n) / (n * n * F.greatest(n - 1, F.lit(1.0)))  # 0 for a single symbol
            z_runs = F.when(var > 0, (runs - mean) / F.sqrt(F.greatest(var, F.lit(1e-9)))).otherwise(99.0)
            avg = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n

            def serial(m: Column) -> Column:
                total = F.aggregate(F.transform(v, lambda x: (x - m) * (x - m)), F.lit(0.0), lambda a, x: a + x)
                lag = F.aggregate(F.transform(v, lambda x, j: F.coalesce((x - m) * (F.get(v, j - 1) - m), F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
                return F.when(total > 0, lag / F.greatest(total, F.lit(1e-9)) * F.sqrt(n)).otherwise(99.0)

            return F.struct(pick(i, 0).alias("encoding"), n.alias("n"), z_text.alias("z_text"), z_random.alias("z_random"), z_runs.alias("z_runs"), let(avg, serial).alias("z_serial"))

        return let(values, of)

    return let(which, tests)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (spans) and tested: the candidates that overlap no base span, with their tests."""
    df = docs.select("doc_id", text_of(docs).alias("__text"))
    text = F.col("__text")
    base = F.when(text.rlike(BASE), base_spans(text)).otherwise(F.array().cast(SPANS))
    tokens = F.when(text.rlike(CANDIDATE), _places(text, CANDIDATE, "random")).otherwise(F.array().cast(SPANS))
    df = df.select("doc_id", F.struct(base.alias("base"), tokens.alias("tokens")).alias("__x"))

    def tested(x: Column) -> Column:
        return F.struct(x["base"].alias("base"), F.transform(_free(x["tokens"], x["base"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), _battery(t["value"]).alias("test"))).alias("tested"))

    return df.select("doc_id", let(F.col("__x"), tested).alias("__x")).select("doc_id", "__x.base", "__x.tested")


def _stratum(test: Column) -> Column:
    band = reduce(lambda a, b: a + b, [F.when(test["n"] >= s, 1).otherwise(0) for s in STRATA])
    return F.concat(test["encoding"], F.lit("/"), band.cast("string"))


def _bin(test: Column) -> Column:
    """0 for the least p-values: the z score in steps of 0.05 from -12."""
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((test["z_text"] + 12) * 20))).cast("int")


def thresholds(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """stratum and last: the last bin that Benjamini-Hochberg accepts there; a row for each stratum that accepts any.

    A bin's p-value is its upper edge's, so ties and binning err on the safe side.
    """
    each = tested.select(F.explode("tested.test").alias("t")).select(_stratum(F.col("t")).alias("stratum"), _bin(F.col("t")).alias("bin"))
    counts = each.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("stratum")
    ranked = counts.select("stratum", "bin", F.sum("n").over(w.orderBy("bin")).alias("rank"), F.sum("n").over(w).alias("m"))
    p = _normal((F.col("bin") + 1) / 20 - 12)
    return ranked.where(p <= F.lit(fdr) * F.col("rank") / F.col("m")).groupBy("stratum").agg(F.max("bin").alias("last"))


def detect(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, base and spans (base and added): arrays of kind, start, end.

    The accepted bins, at most encodings * (strata + 1) rows, come to the driver
    and go back as literals.
    """
    tested = materialize(candidates(docs))
    lasts = {r["stratum"]: r["last"] for r in thresholds(tested, fdr).collect()}
    plain = "array<struct<kind:string,start:bigint,end:bigint>>"

    def passes(x: Column) -> Column:
        t, tail = x["test"], lambda z: 2 * _normal(-F.abs(z))
        random = (tail(t["z_runs"]) >= ALPHA) & (tail(t["z_serial"]) >= ALPHA) & (_normal(-t["z_random"]) >= ALPHA)
        real = reduce(lambda a, s: a | ((_stratum(t) == s) & (_bin(t) <= lasts[s])), sorted(lasts), F.lit(False))
        return random & real

    only = lambda a: F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(plain)
    added = F.transform(F.filter("tested", passes), lambda s: F.struct(F.lit("random").alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(plain)
    return tested.select("doc_id", only(F.col("base")).alias("base"), F.concat(only(F.col("base")), added).alias("spans"))


def op1(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    d = detect(docs)
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return d.select("doc_id", *[n(k) for k in KINDS[:3]], F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"), joined(F.col("spans"), KINDS).alias("spans"))
