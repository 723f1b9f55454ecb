"""SimHash near-duplicates by pivot distance tables (operator 9).

Fingerprints are made in Arrow batches. Equal fingerprints are one node, so a
group of copies costs one row from there on. For each node, a table holds its
Hamming distances to PIVOTS reference fingerprints. Since
|d(x, p) - d(y, p)| <= d(x, y), a pair whose coordinates differ by more than
the radius at any pivot is discarded; survivors are verified on the
fingerprints.

Pairs are drawn from equal block keys: with the 64 bits cut into ``blocks``
blocks, two fingerprints with at most ``radius`` differing bits agree on at
least ``blocks - radius`` of them, so no link is lost. More blocks, longer
keys: the count of distinct fingerprints picks them, which changes the work
only. The join is between two exchanges on the key, whose skewed partitions
Spark splits.

Components come from alternating large-star and small-star rounds on the links.

Edge cases: a null text is empty; without words the fingerprint is zero and
links like any other. Rows with a null doc_id count as nodes, but never as the
smallest id. Repeated rows share their fingerprint. Empty input, empty output.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import materialize, quoted

WIDTH = 3
RADIUS = 3
SEED = 42


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):  # in blocks, for very long texts
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[k : k + (1 << 16)], stops[k : k + (1 << 16)], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and fp (long)."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(x) for x in batch], dtype="int64")

    return docs.select(*[docs[c] for c in keep], fp(docs["text"].cast("string")).alias("fp"))


def pivots(n: int = 8) -> list[int]:
    """Reference fingerprints: rows of the 64 x 64 Hadamard matrix, which are 32 bits from each other."""
    rows = [sum(((bin(j & i).count("1") & 1) << j) for j in range(64)) for i in (1, 2, 4, 8, 16, 32, 63, 21, 42, 7, 56, 35)[:n]]
    return [r - (1 << 64) if r >> 63 else r for r in rows]


def _table(fp: Column) -> Column:
    """The distances to the pivots, one byte each, in a long."""
    packed = F.lit(0).cast("long")
    for k, p in enumerate(pivots()):
        packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(p).cast("long"))).cast("long"), 8 * k))
    return packed


def _keys(fp: Column, blocks: int, radius: int) -> Column:
    """The keys of one fingerprint: a mask's number and its bits."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(i).alias("mask"), fp.bitwiseAND(F.lit(m).cast("long")).alias("bits")) for i, m in enumerate(signed)])


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """a < b: the pairs of distinct fingerprints (column fp) with at most radius differing bits."""
    if blocks is None:
        n = nodes.count()
        blocks = radius + (2 if n < 10**8 else 3 if n < 10**10 else 4)
    keyed = nodes.select("fp", _table(F.col("fp")).alias("pivot"), F.inline(_keys(F.col("fp"), blocks, radius)))
    a, b = keyed.alias("a"), keyed.alias("b")
    near = F.col("a.fp") < F.col("b.fp")
    for k in range(len(pivots())):
        at = lambda side, k=k: F.shiftright(F.col(f"{side}.pivot"), 8 * k).bitwiseAND(F.lit(255).cast("long"))
        near &= F.abs(at("a") - at("b")) <= radius
    near &= F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius
    pairs = a.hint("merge").join(b, (F.col("a.mask") == F.col("b.mask")) & (F.col("a.bits") == F.col("b.bits")) & near)
    return pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """node and root (the least node of its component), for nodes that have an edge.

    edges: a, b. Each round runs large-star then small-star; the table of edges
    is written each round, and never grows.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    for _ in range(rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))))
        e = materialize(small.where("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def cluster(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), radius: int = RADIUS) -> DataFrame:
    """keep (doc_id among them), fp, root (a key of the component) and component_id; the fingerprints are made once."""
    rows = materialize(fingerprints(docs, keep))
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(nodes, radius))
    labelled = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = labelled.join(ids, "root").select(F.col("fp").alias("__fp"), "root", "component_id")
    return rows.join(named, rows["fp"] == named["__fp"]).select(*keep, "fp", "root", "component_id")


def op9(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return cluster(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id (a null one last), of equal ids the one with the least text hash."""
    tagged = docs.select("*", F.col("doc_id").alias("__id"), F.xxhash64(docs["text"]).alias("__h"))
    keyed = materialize(cluster(tagged.select("doc_id", "text", "__id", "__h"), ("doc_id", "__id", "__h")))
    first = keyed.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__h")).alias("x"))
    best = first.select(F.col("x.__id").alias("__bid"), F.col("x.__h").alias("__bh"))
    same = F.col("__id").eqNullSafe(F.col("__bid")) & F.col("__h").eqNullSafe(F.col("__bh"))
    counts = keyed.groupBy(F.col("__id").alias("__rid"), F.col("__h").alias("__rh")).count().where("count > 1")
    best = materialize(best.join(counts, F.col("__bid").eqNullSafe(F.col("__rid")) & F.col("__bh").eqNullSafe(F.col("__rh")), "left").select("__bid", "__bh", F.col("count").isNotNull().alias("__again")))
    kept = tagged.join(best.where("NOT __again"), same, "left_semi")
    if not best.where("__again").isEmpty():  # rows repeated with their ids; only those are compared whole
        kept = kept.union(tagged.join(best.where("__again"), same, "left_semi").dropDuplicates(["__id", "__h"]))
    return kept.select(*map(quoted, docs.columns))
