"""Media, reply, time, id and numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.schema import safe_text

DAY = 86400.0
RECENT_DAYS = 730
RESP_JSON = "time DOUBLE, text STRING"


def pic_count(df: DataFrame) -> Column:
    """Length of a list; of a string that looks like a list or tuple, its elements; else 0."""
    if "pics" not in df.columns:
        return F.lit(0).cast("long")
    c, kind = F.col("pics"), df.schema["pics"].dataType
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.when(c.isNotNull(), F.size(c)), F.lit(0)).cast("long")
    s = F.trim(c.cast("string"))
    listed = s.rlike(r"(?s)^[\[(].*[\])]$")
    as_array = F.concat(F.lit("["), F.regexp_replace(F.expr("substring(trim(cast(pics as string)), 2, length(trim(cast(pics as string))) - 2)"), r",\s*$", ""), F.lit("]"))
    return F.coalesce(F.when(listed, F.json_array_length(as_array)), F.lit(0)).cast("long")


def reply(df: DataFrame) -> tuple[Column, Column]:
    """Length and epoch seconds of the owner's reply, a struct, a JSON string or plain text; a time that is no long is null."""
    if "resp" not in df.columns:
        return F.lit(0).cast("long"), F.lit(None).cast("long")
    c = F.col("resp")
    if isinstance(df.schema["resp"].dataType, T.StructType):
        return F.coalesce(F.length(c["text"].cast("string")), F.lit(0)).cast("long"), c["time"].try_cast("long")
    s = F.trim(c.cast("string"))
    parsed = F.from_json(s, RESP_JSON)
    is_json = s.startswith("{") & F.try_parse_json(s).isNotNull()
    length = F.when(is_json, F.coalesce(F.length(parsed["text"]), F.lit(0))).otherwise(F.coalesce(F.length(s), F.lit(0)))
    return length.cast("long"), F.when(is_json, parsed["time"]).try_cast("long")


def epoch_seconds(t: Column, unit: str = "auto") -> Column:
    """Seconds since 1970; with unit "auto" what is above 10^12 is taken as milliseconds, with "s" it is out of range and null."""
    milli = t > 10**12
    return F.when(milli, t / 1000.0 if unit == "auto" else F.lit(None).cast("double")).otherwise(t.cast("double"))


def media(df: DataFrame) -> dict[str, Column]:
    length, at = reply(df)
    out = {"with_pics": F.col("pics").isNotNull() if "pics" in df.columns else F.lit(False), "pic_count": pic_count(df), "with_resp": length > 0, "resp_char_len": length}
    t = epoch_seconds(F.col("time")) if "time" in df.columns else F.lit(None).cast("double")
    return out | {"response_delay_days": F.coalesce((epoch_seconds(at) - t) / DAY, F.lit(-1.0))}


def temporal(df: DataFrame, as_of: float) -> dict[str, Column]:
    """Calendar parts (UTC session; Monday is 0), age at as_of (epoch seconds) and extreme_star; 0 and -1 where time is missing."""
    out = {}
    if "time" in df.columns:
        s = epoch_seconds(F.col("time"))
        at = F.timestamp_seconds(s)
        parts = {"review_year": F.year(at), "review_month": F.month(at), "review_dow": F.weekday(at), "review_hour": F.hour(at)}
        out = {k: F.coalesce(v, F.lit(0)) for k, v in parts.items()} | {"age_days": age_days(F.col("time"), as_of)}
    else:
        out = {k: F.lit(0) for k in ("review_year", "review_month", "review_dow", "review_hour", "age_days")}
    if "rating" in df.columns:
        out["extreme_star"] = F.coalesce(F.col("rating").isin(1, 5), F.lit(False)).cast("int")
    return out


def age_days(t: Column, as_of: float) -> Column:
    return F.coalesce((F.lit(float(as_of)) - epoch_seconds(t)) / DAY, F.lit(-1.0))


def is_recent(t: Column, as_of: float, missing: bool = False) -> Column:
    """At most RECENT_DAYS old; missing: what a missing time counts as."""
    return F.coalesce((F.lit(float(as_of)) - epoch_seconds(t)) / DAY <= RECENT_DAYS, F.lit(missing))


def year_bin(t: Column) -> Column:
    y = F.coalesce(F.year(F.timestamp_seconds(epoch_seconds(t))), F.lit(0))
    return F.when(y <= 2018, "<=2018").when(y <= 2021, "2019-2021").when(y <= 2023, "2022-2023").otherwise("2024+")


def filled(c: Column) -> Column:
    """The sampler's notion of a present list or reply: its JSON or text is longer than an empty bracket pair."""
    return F.coalesce((F.length(c) > 2) & (c != "None"), F.lit(False))


def content_id(columns: list[str], separator: str = "||") -> Column:
    """md5 of the columns' text, nulls as "None"."""
    return F.md5(F.concat_ws(separator, *[safe_text(F.col(c)) for c in columns]))


def with_review_id(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """An id from place, user, time and text, unless there is one."""
    if id_col in df.columns:
        return df
    missing = [c for c in ("gmap_id", "user_id", "time", "text") if c not in df.columns]
    return df.withColumns({c: F.lit("") for c in missing}).withColumn(id_col, content_id(["gmap_id", "user_id", "time", "text"])).drop(*missing)


def ensure_id(df: DataFrame, id_col: str = "review_id", salt: str = "") -> DataFrame:
    """An id from whichever of the identifying columns there are, else a row number."""
    if id_col in df.columns:
        return df
    known = [c for c in ("review_id", "gmap_id", "user_id", "time", "text") if c in df.columns]
    return df.withColumn(id_col, content_id(known) if known else F.md5(F.concat(F.lit(salt), F.monotonically_increasing_id().cast("string"))))


def hashed_id(df: DataFrame, id_name: str, fields: list[str], id_column: str = "") -> DataFrame:
    """id_name copied from id_column, or hashed from fields where id_column is blank."""
    if id_column:
        return df if id_column == id_name else df.withColumnRenamed(id_column, id_name)
    return df.withColumn(id_name, content_id([c for c in fields if c in df.columns]))


def pick_id(df: DataFrame) -> tuple[DataFrame, str]:
    for c in ("review_id", "id", "row_id"):
        if c in df.columns:
            return df, c
    return df.withColumn("row_id", F.monotonically_increasing_id()), "row_id"


def number(c: Column) -> Column:
    """A number or null; NaN and unreadable values are null."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d), d)


def clip01(c: Column) -> Column:
    n = number(c)
    return F.when(n.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), n)))


def finite(c: Column) -> Column:
    """The number, with 0 for missing, NaN and infinite ones."""
    n = number(c)
    return F.when(F.abs(n) < float("inf"), n).otherwise(0.0)
