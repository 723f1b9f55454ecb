"""Sessions and copies on a stream: those of the batch way, also after a stop in the middle."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import temporal
from plumbline.streaming import scoring, sessions

SCHEMA = "user_id long, ts timestamp"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return sorted((rng.choice([1, 1, 1, 2, 3]), 3600 * 24 * i // 40 + rng.randrange(5000)) for i in range(400))


def put(spark, folder, rows):
    df = spark.createDataFrame([(k, t) for k, t in rows], "user_id long, s long").select("user_id", F.timestamp_seconds("s").alias("ts"))
    df.coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, folder, out, late="3 hours"):
    q = scoring.write(sessions.sessions(stream(spark, folder), "user_id", "ts", 1800, late), f"{out}/rows", f"{out}/checkpoint")
    q.awaitTermination()
    return q


def found(spark, out):
    got = spark.read.schema("user_id long, start timestamp, end timestamp, n long").parquet(f"{out}/rows")
    return sorted((r.user_id, r.start.timestamp(), r.end.timestamp(), r.n) for r in got.collect())


def wanted(spark, rows):
    df = spark.createDataFrame(rows, "user_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    return sorted((r.user_id, r.start.timestamp(), r.end.timestamp(), r.n) for r in temporal.sessions(df, "user_id", "ts").collect())


def test_spans_are_merged():
    assert sessions.merged([(5, 5, 1), (1, 2, 2), (8, 9, 1), (20, 20, 1), (3, 4, 1)], 2) == [(1, 5, 4), (8, 9, 1), (20, 20, 1)]
    assert sessions.merged([], 1) == []


def test_stop_in_the_middle(spark, rows, tmp_path):
    """Two parts out of order, a stop, two more and a marker: together the batch's sessions, none twice."""
    parts = [[r for r in rows if a <= r[1] < b] for a, b in ((0, 200_000), (200_000, 400_000), (400_000, 600_000), (600_000, 10**9))]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for p in parts[:2]:
        random.Random(1).shuffle(p)
        put(spark, folder, p)
    run(spark, folder, out)
    half = found(spark, out)
    assert half and set(half) < set(wanted(spark, rows))
    for p in parts[2:]:
        put(spark, folder, p)
    put(spark, folder, [(None, 10**8)])
    q = run(spark, folder, out)
    assert found(spark, out) == wanted(spark, rows) and sessions.late_rows(q) == 0


def test_late_rows_are_counted(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, folder, [(1, 10), (1, 100), (2, 50_000)])
    run(spark, folder, out, "1 hour")
    put(spark, folder, [(1, 200), (1, 49_000), (2, 51_000)])
    q = run(spark, folder, out, "1 hour")
    assert sessions.late_rows(q) == 1
    put(spark, folder, [(None, 10**8)])
    run(spark, folder, out, "1 hour")
    assert found(spark, out) == [(1, 10.0, 100.0, 2), (1, 49_000.0, 49_000.0, 1), (2, 50_000.0, 51_000.0, 2)]


def test_copies(spark, tmp_path):
    schema = "review_id string, gmap_id string, text string, time long"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    day, start = 86400, 1_600_000_000
    first = [("1", "g", "a", start), ("2", "g", "a", start + 5), ("3", "h", "a", start), ("4", "g", None, start), ("5", None, "a", start), ("9", "g", "a", None)]
    second = [("6", "g", "a", start + 10 * day), ("7", "h", "b", start + 10 * day), ("8", None, "a", start)]
    third = [("10", "g", "a", start + 60 * day)]
    fourth = [("11", "g", "a", start + 61 * day), ("12", "h", "a", start + 61 * day)]  # by now the copies of the first days are forgotten
    for part in (first, second, third, fourth):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        live = spark.readStream.schema(schema).parquet(folder)
        q = scoring.write(sessions.copies(live), f"{out}/rows", f"{out}/checkpoint")
        assert q.awaitTermination(120)
    got = {r.review_id: r.text_dup_count_place for r in spark.read.parquet(f"{out}/rows").collect()}
    assert {got["1"], got["2"]} == {1, 2} and got["6"] == 3 and got["10"] == 4 and got["12"] == 1 and got["11"] in (1, 5)
    assert [got[i] for i in ("3", "4", "5", "7", "8", "9")] == [1] * 6 and len(got) == 12


def test_a_key_has_one_timer(spark):
    """Many open sessions of a key: one timer is set, one call reads them, and all that are due go out in it."""

    class Handle:
        def __init__(self):
            self.timers, self.calls, self.held = set(), 0, []

        def getListState(self, *_):
            return self

        def get(self):
            self.calls += 1
            return iter(self.held)

        def put(self, spans):
            self.held = spans

        def clear(self):
            self.held = []

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.discard(at)

    class At:
        def __init__(self, at):
            self.at = at

        def getExpiryTimeInMs(self):
            return self.at

        getCurrentWatermarkInMs = getExpiryTimeInMs

    handle, hour = Handle(), 3600 * sessions.MICROS
    p = sessions._Sessions(hour)
    p.init(handle)
    assert not list(p.handleInputRows((1,), iter([pd.DataFrame({"at": [3 * hour * i for i in range(50, 0, -1)]})]), None))
    assert len(handle.held) == 50 and len(handle.timers) == 1
    out, marks = [], [3600_000 * 3 * 40, 10**12]
    for mark in marks:
        while (due := min(handle.timers, default=mark + 1)) <= mark:
            out += [len(x) for x in p.handleExpiredTimer((1,), At(mark), At(due))]
            handle.deleteTimer(due)
    assert out == [39, 11] and not handle.held and not handle.timers and handle.calls == 3
