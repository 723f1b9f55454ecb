"""Joins and frames over time that no single task holds a key's whole history for.

Time is cut into buckets at quantiles of all rows, so that a key with a large
share of them is spread over as many tasks as the buckets it fills; what one
bucket needs to know of another is carried over as a row a bucket, or copied as
a halo of one frame's length. Times are numbers or timestamps; a null key or
time matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.schema import require
from plumbline.sources.scratch import materialize

#: Buckets of time, in two levels of SIDE each; and the share of rows from which a cell of the interval join is split.
SIDE, HOT_SHARE, MOST_SALTS = 16, 1024, 64
MICROS = 1_000_000


def moment(df: DataFrame, column: str) -> Column:
    """A number that orders the column: microseconds of a timestamp or date (UTC session), else the number itself."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    return F.unix_micros(c.cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else c


def bucket_of(t: Column, edges: list) -> Column:
    """How many of the sorted edges t has reached: first among every SIDE-th, then among those between."""
    if not edges:
        return F.lit(0)
    outer = edges[SIDE - 1 :: SIDE]
    inner = [edges[i : i + SIDE - 1] for i in range(0, len(edges), SIDE)]
    inner += [[]] * (len(outer) + 1 - len(inner))
    reached = lambda a: F.size(F.filter(a, lambda e: e <= t))
    high = reached(F.array(*map(F.lit, outer))) if outer else F.lit(0)
    rows = F.array(*[F.array(*map(F.lit, x)).cast("array<double>") for x in inner])
    return F.transform(F.array(high), lambda h: h * SIDE + reached(F.element_at(rows, h + 1)))[0]


def time_edges(times: DataFrame, column: str = "t", buckets: int = SIDE * SIDE) -> list[float]:
    """Quantiles of a column of numbers: at most buckets - 1, by one pass of sketches."""
    if buckets < 2:
        return []
    return sorted(set(times.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("t")).approxQuantile("t", [k / buckets for k in range(1, buckets)], 0.25 / buckets)))


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, payload: list[str], ties: list[str] | None = None, strict: bool = False, tolerance: float | None = None, buckets: int = SIDE * SIDE) -> DataFrame:
    """Every left row with the payload of the last right row of its key at or before its time (strict: before it).

    Of right rows with equal times the one with the largest ties (default: the
    payload) counts. tolerance: how long before it may be, in the times' unit
    (microseconds for timestamps). Rows without an answer get nulls.

    Both sides are first brought to one row a key and time. In its bucket a row
    sees the rows before it; the last right row of each bucket is carried on by
    a prefix maximum over the key's buckets, at most `buckets` rows. The answers
    come back by key and time; a key and time of very many left rows is split by
    the adaptive skew join.
    """
    require(left, [key, left_time])
    require(right, [key, right_time, *payload])
    order = ties or payload
    held = F.struct(moment(right, right_time).alias("at"), *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)], *[F.col(f"`{c}`").alias(f"p{i}") for i, c in enumerate(payload)])
    asked = left.select(F.col(f"`{key}`").alias("k"), moment(left, left_time).alias("t"))
    told = right.select(F.col(f"`{key}`").alias("k"), moment(right, right_time).alias("t"), held.alias("r"))
    points = asked.withColumn("r", F.lit(None).cast(told.schema["r"].dataType)).unionByName(told).where("k IS NOT NULL AND t IS NOT NULL")
    points = materialize(points.groupBy("k", "t").agg(F.max("r").alias("r")))
    points = points.withColumn("b", bucket_of(F.col("t"), time_edges(points, buckets=buckets)))
    # Structs compare by their first field, the time, so a maximum is the latest.
    cells = points.groupBy("k", "b").agg(F.max("r").alias("last"))
    cells = cells.select("k", "b", F.max("last").over(Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = Window.partitionBy("k", "b").orderBy("t").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    seen = points.withColumn("near", F.max("r").over(inside)).join(cells, ["k", "b"])
    best = F.coalesce("near", "before")
    if tolerance is not None:
        best = F.when(F.col("t") - best["at"] <= tolerance, best)
    answers = seen.select(F.col("k").alias("__k"), F.col("t").alias("__t"), best.alias("__r")).where("__r IS NOT NULL")
    rows = left.withColumn("__at", moment(left, left_time))
    joined = rows.join(answers, (F.col(f"`{key}`") == F.col("__k")) & (F.col("__at") == F.col("__t")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"__r.p{i}").alias(c) for i, c in enumerate(payload)])


def rolling(df: DataFrame, key: str, time: str, length: float, made: dict[str, Column], spread: int = 8) -> DataFrame:
    """df with aggregates of the rows of its key within `length` before its time, and at it: RANGE frames, length in the time's unit (microseconds for timestamps).

    made: name -> an aggregate of df's columns. Buckets are `spread` frames
    long; a row less than a frame before the end of its bucket is also seen in
    the next one, so at most one row in `spread` is copied, and a key's rows are
    as many groups as it has buckets. Rows without a key or time get nulls.
    """
    require(df, [key, time])
    width = length * spread
    rows = df.withColumns({"__t": moment(df, time), "__b": F.floor(moment(df, time) / F.lit(width)).cast("long")})
    known = F.col(f"`{key}`").isNotNull() & F.col("__t").isNotNull()
    halo = F.col("__t") >= (F.col("__b") + 1) * F.lit(width) - F.lit(length)
    seen = rows.where(known).withColumn("__own", F.explode(F.when(halo, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
    seen = seen.withColumn("__b", F.when(F.col("__own"), F.col("__b")).otherwise(F.col("__b") + 1))
    frame = Window.partitionBy(key, "__b").orderBy("__t").rangeBetween(-length, 0)
    out = seen.withColumns({n: c.over(frame) for n, c in made.items()}).where("__own").drop("__t", "__b", "__own")
    kinds = {n: out.schema[n].dataType for n in made}
    lost = rows.where(~known | known.isNull()).drop("__t", "__b").withColumns({n: F.lit(None).cast(t) for n, t in kinds.items()})
    return out.unionByName(lost)


def _levels(start: Column, end: Column, unit: float) -> Column:
    """The least power of two of `unit` that is no shorter than the interval, so that it touches two bins of its level at most."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest((end - start).cast("double") / unit, F.lit(1.0))))).cast("int")


def overlapping(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], key: str | None = None, unit: float | None = None) -> DataFrame:
    """All pairs of a left and a right row whose half-open spans [start, end) overlap, of equal key if one is given; columns l and r, structs of the rows.

    An interval's level is the power of two next above its length. Two intervals
    meet at the higher of their levels, where each touches two bins at most, and
    are compared in the first bin that both touch: an equality join on key, level
    and bin, and an exact check. Bins that hold more than one row in HOT_SHARE of
    a side are split: that side's rows are dealt out by hash, the other's are
    repeated for each part. Spans that are empty, or have a null, overlap nothing.
    """
    for df, span in ((left, left_span), (right, right_span)):
        require(df, [*span, *([key] if key else [])])

    def side(df: DataFrame, span: tuple[str, str]) -> DataFrame:
        s, e = moment(df, span[0]), moment(df, span[1])
        rows = df.select(F.struct(F.col("*")).alias("row"), (F.col(f"`{key}`") if key else F.lit(0)).alias("k"), s.alias("s"), e.alias("e"))
        return rows.where("k IS NOT NULL AND s < e")

    a, b = side(left, left_span), side(right, right_span)
    if unit is None:
        mean = a.select("s", "e").unionByName(b.select("s", "e")).agg(F.avg(F.col("e") - F.col("s"))).first()[0]
        unit = max(1.0, float(mean or 1.0) / 16)
    a, b = (x.withColumn("level", _levels(F.col("s"), F.col("e"), unit)) for x in (a, b))
    here = [{r["level"] for r in x.select("level").distinct().collect()} for x in (a, b)]  # some sixty numbers at most

    def binned(df: DataFrame, others: set[int]) -> DataFrame:
        above = F.array(*[F.lit(v) for v in sorted(others)]).cast("array<int>")
        df = df.withColumn("at", F.explode(F.array_union(F.array("level"), F.filter(above, lambda v: v > F.col("level")))))
        width = F.lit(unit) * F.pow(F.lit(2.0), F.col("at"))
        first, last = F.floor(F.col("s") / width), F.floor(F.greatest(F.col("s"), F.col("e") - 1e-9) / width)
        return df.withColumn("first", first).withColumn("bin", F.explode(F.sequence(first, last)))

    a, b = (binned(x, o).withColumnsRenamed({"row": n, **{c: f"{n}_{c}" for c in ("s", "e", "level", "first")}}) for x, o, n in ((a, here[1], "l"), (b, here[0], "r")))
    a, b = _dealt(a, b, ["k", "at", "bin"])
    both = a.join(b, ["k", "at", "bin", "salt"]).where((F.col("at") == F.greatest("l_level", "r_level")) & (F.col("bin") == F.greatest("l_first", "r_first")) & (F.col("l_s") < F.col("r_e")) & (F.col("r_s") < F.col("l_e")))
    return both.select("l", "r")


def _dealt(a: DataFrame, b: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: 0, but for the cells that hold many rows of one side, whose rows are dealt out and met by repeated rows of the other."""
    hot = []
    for df, name in ((a, "na"), (b, "nb")):
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        total = counts.agg(F.sum(name)).first()[0] or 0
        least = max(1, total // HOT_SHARE)
        hot.append(counts.where(F.col(name) > least).select(*keys, F.least(F.lit(MOST_SALTS), F.ceil(F.col(name) / least)).cast("int").alias(name)))
    plan = materialize(hot[0].join(hot[1], keys, "full_outer").select(*keys, F.coalesce("na", F.lit(1)).alias("na"), F.coalesce("nb", F.lit(1)).alias("nb")))
    plan = F.broadcast(plan)  # 2 * HOT_SHARE rows at most

    def salted(df: DataFrame, own: str, other: str, rows: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(F.col(rows), F.lit(own)), F.coalesce(F.col(own), F.lit(1))).cast("int")
        every = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        number = (lambda m, o: m * MOST_SALTS + o) if own == "na" else (lambda m, o: o * MOST_SALTS + m)
        return df.join(plan, keys, "left").withColumn("__mine", mine).withColumn("__other", F.explode(every)).withColumn("salt", number(F.col("__mine"), F.col("__other"))).drop("na", "nb", "__mine", "__other")

    return salted(a, "na", "nb", "l"), salted(b, "nb", "na", "r")


def sessions(events: DataFrame, key: str, time: str, gap: str = "30 minutes", made: dict[str, Column] | None = None) -> DataFrame:
    """key, start, end (of the last row), n and made: runs of a key's rows with no more than the gap between neighbours.

    Spark merges partial sessions before the shuffle.
    """
    require(events, [key, time])
    rows = events.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{time}`").isNotNull()).withColumn("__ts", F.col(f"`{time}`").cast("timestamp"))
    found = rows.groupBy(F.session_window("__ts", gap).alias("__w"), key).agg(F.min("__ts").alias("start"), F.max("__ts").alias("end"), F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in (made or {}).items()])
    return found.drop("__w")
