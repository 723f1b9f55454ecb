"""Sessions and repeated texts on a stream, with a state store and timers.

State lives in RocksDB and goes to the checkpoint with every batch, so a query
that stops, or loses an executor, goes on from its checkpoint without losing or
repeating a session. A hot key's rows are one group a batch, as a stream has
them; what is kept of them is its open sessions only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from plumbline.functions.fields import epoch_seconds

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MICROS = 1_000_000


def with_store(spark: SparkSession) -> None:
    """Streams started from here on keep their state in RocksDB, which timers need."""
    spark.conf.set(STORE, ROCKS)


def merged(spans: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(start, end, n) with those no more than the gap apart as one."""
    out: list[tuple[int, int, int]] = []
    for start, end, n in sorted(spans):
        if out and start - out[-1][1] <= gap:
            out[-1] = (out[-1][0], max(out[-1][1], end), out[-1][2] + n)
        else:
            out.append((start, end, n))
    return out


class _Sessions(StatefulProcessor):
    """Open sessions of a key; one is given out when the watermark has passed its end by more than the gap.

    A key has one timer, for its earliest session, and all that are due then go
    out together: with a timer each, every session would be a call that reads
    all sessions of its key.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start long, end long, n long")

    def _due(self, end: int) -> int:
        return (end + self.gap) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(map(int, x)) for x in self.open.get()]
        spans = merged([*held, *((int(t), int(t), 1) for batch in rows for t in batch["at"])], self.gap)
        if spans:
            self.open.put(spans)
        before, after = ([self._due(end) for _, end, _ in x[:1]] for x in (held, spans))
        if before != after:
            for due in before:
                self.handle.deleteTimer(due)
            for due in after:
                self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        spans = [tuple(map(int, x)) for x in self.open.get()]
        done = [x for x in spans if self._due(x[1]) <= now]
        if left := [x for x in spans if self._due(x[1]) > now]:
            self.open.put(left)
            self.handle.registerTimer(self._due(left[0][1]))
        else:
            self.open.clear()
        if done:
            yield pd.DataFrame({"k": [key[0]] * len(done), "start": [x[0] for x in done], "end": [x[1] for x in done], "n": [x[2] for x in done]})

    def close(self) -> None:
        pass


def sessions(stream: DataFrame, key: str, time: str, gap_seconds: float, late: str = "1 hour") -> DataFrame:
    """key, start, end and n of each finished session: rows of a key with no more than the gap between neighbours, in any order.

    Rows later than the watermark (`late` behind the newest time seen) are left
    out and counted, see late_rows. Rows without a key or time are left out, but
    a time of a row without a key moves the watermark.
    """
    with_store(stream.sparkSession)
    kind = stream.schema[key].dataType
    # Batches come as tuples with names, which can't begin with an underscore.
    rows = stream.select(F.col(f"`{key}`").alias("k"), F.col(f"`{time}`").cast("timestamp").alias("ts")).withWatermark("ts", late)
    # One condition on both: a condition on the key alone would be moved below the watermark, which then wouldn't see these rows.
    rows = rows.where(F.when(F.col("ts").isNotNull(), F.col("k").isNotNull())).withColumn("at", F.unix_micros("ts"))
    made = T.StructType([T.StructField("k", kind), *[T.StructField(c, T.LongType()) for c in ("start", "end", "n")]])
    out = rows.groupBy("k").transformWithStateInPandas(_Sessions(int(gap_seconds * MICROS)), made, "Append", "EventTime")
    return out.select(F.col("k").alias(key), F.timestamp_micros("start").alias("start"), F.timestamp_micros("end").alias("end"), "n")


class _Copies(StatefulProcessor):
    """How often a text was seen at a place; forgotten when the watermark is a time past the last copy."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n long, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, due = map(int, self.seen.get()) if self.seen.exists() else (0, 0)
        last = due
        for batch in rows:
            last = max(last, int(batch["at"].max()) + self.keep_ms)
            batch = batch[["id", "place"]].assign(n=range(n + 1, n + 1 + len(batch)))
            n += len(batch)
            yield batch
        if last != due:
            if due:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(last)
        self.seen.update((n, last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def copies(stream: DataFrame, keep_days: float = 30.0, late: str = "2 days", id_key: str = "review_id", place: str = "gmap_id", time: str = "time") -> DataFrame:
    """id, place and text_dup_count_place: which copy of its text at its place a review is, counting those that came before it.

    Texts are told apart by two 64-bit hashes, the state's key together with the
    place. A count is dropped once the watermark is `keep_days` past the time of
    its last copy, so the state holds that many days of texts. The largest count
    of a text is the batch feature of the same name. Reviews without place, text
    or time count 1 and need no state; late ones are left out, see late_rows.
    """
    with_store(stream.sparkSession)
    at = F.timestamp_seconds(epoch_seconds(F.col(time)))
    timed = stream.select(F.col(id_key).alias("id"), F.col(place).alias("place"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"), F.col("text").isNotNull().alias("told"), at.alias("ts"))
    known = F.when(F.col("ts").isNotNull(), F.col("place").isNotNull() & F.col("told"))
    hashed = timed.withWatermark("ts", late).where(known).withColumn("at", F.unix_millis("ts"))
    made = T.StructType([T.StructField("id", stream.schema[id_key].dataType), T.StructField("place", stream.schema[place].dataType), T.StructField("n", T.LongType())])
    counted = hashed.groupBy("place", "h1", "h2").transformWithStateInPandas(_Copies(int(keep_days * 86_400_000)), made, "Append", "EventTime")
    single = timed.where(F.col("ts").isNull() | F.col("place").isNull() | ~F.col("told")).select("id", "place", F.lit(1).cast("long").alias("n"))
    return counted.unionByName(single).select(F.col("id").alias(id_key), F.col("place").alias(place), F.col("n").alias("text_dup_count_place"))


def late_rows(query) -> int:
    """Rows that the query left out because they came after the watermark, in the progress it still holds."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
