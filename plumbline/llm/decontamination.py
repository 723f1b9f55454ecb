"""Benchmark decontamination with training suffix arrays (operator 5).

Training documents become arrays of word numbers, in shards of bounded size
inside the Arrow batches Spark hands out. Each shard gets a suffix array, and
every test suffix is binary-searched in it. A suffix array entry range gives
all places where the next ``window`` words of the test suffix occur; places on
one diagonal join to the longest verbatim matches, with their locations. There
is no shuffle: a document's answer needs only its own shard.

Suffixes that can't reach a window are left out of the array: those with a word
that no item has before the shortest window ends.

The items go to the executors in blocks of at most BLOCK_BYTES of text. Each
block is one pass over the documents, whose hits are written before the next
pass begins, so a larger benchmark takes more passes, never more memory.

Edge cases: a null or empty text has no words and is clean. An item without
words has no windows; one of fewer words than the window is one window.
Repeated documents are treated row by row, repeated item_ids as one item. Items
without an id count as one item together: their windows hit like any other, they
add one to n_items, and nothing to the hash of the ids.
Extra columns don't matter. No items: all documents are clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import materialize, quoted

WINDOW = 10
BLOCK_BYTES = 2 << 20
SHARD_WORDS = 1 << 20
#: Suffixes in one suffix array at most, so that a very long text is searched in parts.
ARRAY_SUFFIXES = 1 << 18
#: Bytes that aren't in a word (after lower-casing) become blanks.
_BLANK = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_BLANK).split()


class TestSuffixes:
    """The items' words as numbers, and their distinct windows."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.ids: list[str | None] = []
        #: Words of an item before the piece of it that is here.
        self.firsts: list[int] = []
        for item_id, text, *first in items:
            nums = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            k = len(self.ids)
            self.ids.append(item_id)
            self.firsts.append(first[0] if first else 0)
            for at in range(max(1, len(nums) - window + 1) if nums else 0):
                places.setdefault(tuple(nums[at : at + window]), []).append((k, at))
        self.window = window
        self.windows = np.zeros((len(places), window), np.int32)
        self.lengths = np.array([len(x) for x in places], np.int64)
        for i, x in enumerate(places):
            self.windows[i, : len(x)] = x
        self.places = list(places.values())
        self.shortest = int(self.lengths.min()) if places else 0

    def search(self, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place) pairs: all occurrences of the windows in a shard of word numbers, 0 where no item has the word."""
        none = np.zeros(0, np.int64)
        if not len(self.places):
            return none, none
        # Suffixes whose first `shortest` words are all known.
        known = np.concatenate(([0], np.cumsum(shard != 0)))
        m = self.shortest
        at = np.flatnonzero(known[m:] - known[:-m] == m) if len(shard) >= m else none
        if not len(at):
            return none, none
        padded = np.concatenate((shard, np.zeros(self.window, shard.dtype)))
        parts = [self._places(padded, at[k : k + ARRAY_SUFFIXES]) for k in range(0, len(at), ARRAY_SUFFIXES)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _places(self, padded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place) pairs among the suffixes that begin at `at`."""
        keys = padded[at[:, None] + np.arange(self.window)]
        order = np.lexsort(keys.T[::-1])
        array, keys = at[order], keys[order]  # the suffix array, to the depth of a window
        low, high = self._bound(keys, False), self._bound(keys, True)
        n = high - low
        which = np.repeat(np.arange(len(n)), n)
        index = np.repeat(low, n) + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, array[index]

    def _bound(self, keys: np.ndarray, upper: bool) -> np.ndarray:
        """Binary search of all windows at once, on the words each has."""
        low, high = np.zeros(len(self.windows), np.int64), np.full(len(self.windows), len(keys), np.int64)
        used = np.arange(self.window)[None, :] < self.lengths[:, None]
        while (open_ := low < high).any():
            mid = (low + high) // 2
            differ = (keys[np.minimum(mid, len(keys) - 1)] - self.windows) * used
            first = (differ != 0).argmax(1)
            sign = differ[np.arange(len(differ)), first]
            right = open_ & ((sign <= 0) if upper else (sign < 0))
            low = np.where(right, mid + 1, low)
            high = np.where(open_ & ~right, mid, high)
        return low

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int]], list[str], list[dict]]]:
        """For each text: its words, merged hit intervals, item ids and longest matches; texts in shards of SHARD_WORDS."""
        get, pending, total = self.number.get, [], 0
        for text in texts:
            nums = np.fromiter((get(w, 0) for w in words_of(text)), np.int32)
            pending.append(nums)
            total += len(nums)
            if total >= SHARD_WORDS:
                yield from self._shard(pending)
                pending, total = [], 0
        yield from self._shard(pending)

    def _shard(self, docs: list[np.ndarray]) -> Iterator[tuple[int, list[tuple[int, int]], list[str], list[dict]]]:
        if not docs:
            return
        gap = np.zeros(1, np.int32)
        shard = np.concatenate([x for d in docs for x in (d, gap)])
        starts = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs])))
        which, place = self.search(shard)
        order = np.argsort(place, kind="stable")
        which, place = which[order], place[order]
        cuts = np.searchsorted(place, starts)
        for k, d in enumerate(docs):
            a, b = cuts[k], cuts[k + 1]
            yield len(d), *(self._document(which[a:b], place[a:b] - starts[k]) if b > a else ([], [], []))

    def _document(self, which: np.ndarray, place: np.ndarray) -> tuple[list[tuple[int, int]], list[str], list[dict]]:
        spans: list[list[int]] = []
        for w, p in zip(which.tolist(), place.tolist(), strict=True):
            end = p + int(self.lengths[w])
            if spans and p <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([p, end])
        items = sorted({self.ids[k] for w in np.unique(which).tolist() for k, _ in self.places[w]}, key=lambda x: (x is None, x))
        longest: dict[tuple[int, int], list[int]] = {}  # by item and diagonal: the open match
        found: list[dict] = []
        close = lambda k, x: found.append({"item_id": self.ids[k], "item_start": x[2] + self.firsts[k], "doc_start": x[0], "n_words": x[1] - x[0]})
        for w, p in zip(which.tolist(), place.tolist(), strict=True):
            for k, at in self.places[w]:
                x = longest.get((k, p - at))
                end = p + int(self.lengths[w])
                if x and p <= x[1] - int(self.lengths[w]) + 1:
                    x[1] = end
                else:
                    if x:
                        close(k, x)
                    longest[k, p - at] = [p, end, at]
        for (k, _), x in longest.items():
            close(k, x)
        return [tuple(x) for x in spans], items, found


def pieces(text: str, most: int, window: int) -> Iterator[tuple[str, int]]:
    """A long text in parts of about `most` bytes, and the number of words before each; parts overlap by window - 1 words, so each window is whole in one."""
    words, start = words_of(text), 0
    while start == 0 or start + window <= len(words):
        end, held = start, 0
        while end < len(words) and (held < most or end - start < window):
            held += len(words[end]) + 1
            end += 1
        yield b" ".join(words[start:end]).decode("utf-8", "surrogatepass"), start
        if end >= len(words):
            return
        start = end - (window - 1)


def item_blocks(benchmark: DataFrame, most: int = BLOCK_BYTES, *, window: int = WINDOW) -> Iterator[list[tuple]]:
    """(item_id, text, words before) in blocks of `most` bytes, or of one item of up to twice that; streamed, so the driver holds one block and one item at a time.

    A longer item is cut into pieces of about `most`; a verbatim match across the seam of two is given as two.
    """
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")).where("t IS NOT NULL")
    for row in rows.toLocalIterator():
        whole = len(row.t.encode("utf-8", "surrogatepass"))
        for text, first in pieces(row.t, most, window) if whole > 2 * most else [(row.t, 0)]:
            n = len(text.encode("utf-8", "surrogatepass"))
            if block and held + n > most:
                yield block
                block, held = [], 0
            block.append((row.i, text, first))
            held += n
    if block:
        yield block


MATCHES = "n_words long, spans array<struct<start:long,end:long>>, items array<string>, matches array<struct<item_id:string,item_start:long,doc_start:long,n_words:long>>"


def _finder(suffixes):
    @F.pandas_udf(MATCHES)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = list(suffixes.value.matches(batch.tolist()))
            yield pd.DataFrame({
                "n_words": np.array([r[0] for r in rows], np.int64),
                "spans": [[{"start": a, "end": b} for a, b in r[1]] for r in rows],
                "items": [r[2] for r in rows],
                "matches": [r[3] for r in rows],
            })

    return find


def _merged(passes: DataFrame) -> DataFrame:
    """__place and __spans: the spans of all passes in order, those that meet as one. Linear in a text's spans but for the sort."""
    each = passes.select("__place", F.inline("spans"))
    w = Window.partitionBy("__place").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = each.withColumn("__new", F.when(F.col("start") <= before, 0).otherwise(1))
    runs = marked.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("__place", "__run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("__place").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans"))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, column: str = "text", name: str = "hit") -> DataFrame:
    """docs with a struct column: n_words, spans (merged hit words), items and matches (the longest verbatim ones)."""
    share = docs.sparkSession.sparkContext.broadcast
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    blocks = item_blocks(benchmark, window=window)
    first, second = next(blocks, None), next(blocks, None)
    if first and not second:
        return docs.withColumn(name, _finder(share(TestSuffixes(first, window)))(text))
    count = F.size(F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))).cast("long")
    if not first:
        empty = F.from_json(F.lit('{"spans":[],"items":[],"matches":[]}'), MATCHES)
        return docs.withColumn(name, empty.withField("n_words", count))
    # One block a pass: each writes its hits, so that a task holds one block only.
    base = materialize(docs.withColumn("__place", F.monotonically_increasing_id()))
    passes = []
    for block in chain((first, second), blocks):
        shared = share(TestSuffixes(block, window))
        hits = base.select("__place", _finder(shared)(text).alias("h")).where(F.size("h.spans") > 0)
        passes.append(materialize(hits.select("__place", "h.spans", "h.items", "h.matches")))
        shared.destroy()
    every = reduce(DataFrame.unionByName, passes)
    gathered = every.groupBy("__place").agg(*[F.flatten(F.collect_list(c)).alias(f"__{c}") for c in ("items", "matches")])
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    # Equal ids may be in several blocks.
    gathered = gathered.select("__place", F.array_sort(F.array_distinct("__items")).alias("__items"), "__matches").join(_merged(every), "__place")
    both = base.join(gathered, "__place", "left")
    hit = F.struct(
        count.alias("n_words"),
        none("__spans", "array<struct<start:long,end:long>>").alias("spans"),
        none("__items", "array<string>").alias("items"),
        none("__matches", "array<struct<item_id:string,item_start:long,doc_start:long,n_words:long>>").alias("matches"),
    )
    return both.select(*map(quoted, docs.columns), hit.alias(name))


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    h = scan(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("hit.spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    df = h.select("doc_id", F.col("hit.n_words").alias("n_words"), hit.alias("n_hit"), F.size("hit.items").cast("long").alias("n_items"), F.sha2(F.array_join("hit.items", ","), 256).alias("items_sha256"))
    return df.withColumn("contaminated", F.col("n_hit") > 0)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("__row"))
    return scan(held.withColumn("__text", F.col("__row.text")), benchmark, column="__text").where(F.size("hit.spans") == 0).select("__row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)
), p AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM d
), h AS (
  SELECT doc_id, s, n, item_id FROM (SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS x, len(w) AS m FROM p, (SELECT DISTINCT n FROM iw)) JOIN iw USING (n, x) WHERE s + n - 1 <= m
), c AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS j FROM h) GROUP BY doc_id
), k AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
"""
