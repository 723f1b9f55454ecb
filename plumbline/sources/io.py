"""Readers and writers: the format follows the path, local or in any store Spark reads."""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.schema import nan_to_null

FORMATS = {".jsonl": "json", ".jsonl.gz": "json", ".json.gz": "json", ".json": "array", ".parquet": "parquet", ".csv": "csv", ".csv.gz": "csv"}


def format_of(path: str) -> str:
    for end, kind in sorted(FORMATS.items(), key=lambda x: -len(x[0])):
        if path.lower().rstrip("/").endswith(end):
            return kind
    raise ValueError(f"unsupported file type: {path}")


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One path or glob. JSON lines (also gzipped), a JSON array, Parquet or CSV with a header; NaN is read as null."""
    kind = format_of(path)
    r = spark.read.schema(schema) if schema else spark.read
    if kind == "parquet":
        return nan_to_null(r.parquet(path))
    if kind == "csv":
        return nan_to_null(unique_columns((r if schema else r.option("inferSchema", True)).option("header", True).option("multiLine", True).option("escape", '"').csv(path)))
    return nan_to_null((r.option("multiLine", True) if kind == "array" else r).json(path))


def read_cached(spark: SparkSession, path: str) -> DataFrame:
    """read_any with Spark's cache behind it: the same path is read once a session, until spark.catalog.clearCache()."""
    view = f"plumbline_{hashlib.md5(path.encode()).hexdigest()}"
    if not spark.catalog.tableExists(view):
        read_any(spark, path).createTempView(view)
    if not spark.catalog.isCached(view):
        spark.catalog.cacheTable(view)
    return spark.table(view)


def try_read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """None for a missing path or an unknown type."""
    from pyspark.errors import AnalysisException

    try:
        return read_any(spark, path, schema)
    except (AnalysisException, ValueError):
        return None


def unique_columns(df: DataFrame) -> DataFrame:
    """The first of columns that share a name."""
    seen: set[str] = set()
    keep = [i for i, c in enumerate(df.columns) if not (c in seen or seen.add(c))]
    if len(keep) == len(df.columns):
        return df
    named = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return named.select(*[F.col(f"c{i}").alias(df.columns[i]) for i in keep])


def read_sources(spark: SparkSession, patterns: list[str], schema: T.StructType | None = None, optional: tuple[str, ...] = ("region",)) -> tuple[DataFrame, DataFrame | None]:
    """Reviews (files review-*) and metadata (files meta-*) of the patterns, files united by column name; metadata may be missing.

    optional: columns of the schema that are dropped if no review has a value, so
    that later steps know that the files lack them.
    """
    found = {"review-": [], "meta-": []}
    for pattern in patterns:
        for path in expand(spark, pattern):
            name = path.rstrip("/").rpartition("/")[2]
            for kind, paths in found.items():
                if name.startswith(kind):
                    paths.append(path)
    if not found["review-"]:
        raise FileNotFoundError(f"no review files in {patterns}")
    union = lambda paths, s: _union(_frames(spark, paths, s))
    reviews = union(found["review-"], schema)
    if schema:
        lacking = [c for c in optional if c in reviews.columns and reviews.where(F.col(c).isNotNull()).isEmpty()]
        reviews = reviews.drop(*lacking)
    text = F.col("text")
    trimmed = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    reviews = reviews.where(text.isNotNull() & (trimmed != "") & (F.lower(trimmed) != "none"))
    return reviews, union(found["meta-"], None) if found["meta-"] else None


def _frames(spark: SparkSession, paths: list[str], schema: T.StructType | None) -> list[DataFrame]:
    """One DataFrame for all files of a format, so that plans don't grow with the files; CSV files without a schema may differ in their headers, so each is its own."""
    kinds: dict[str, list[str]] = {}
    for p in paths:
        kinds.setdefault(format_of(p), []).append(p)
    out = []
    for kind, group in kinds.items():
        r = spark.read.schema(schema) if schema else spark.read
        if kind == "csv" and not (schema and len(group) > 1):
            out += [read_any(spark, p, schema) for p in group]
        elif kind == "csv":
            out.append(nan_to_null(r.option("header", True).option("enforceSchema", False).option("multiLine", True).option("escape", '"').csv(group)))
        elif kind == "parquet":
            out.append(nan_to_null(r.option("mergeSchema", True).parquet(*group)))
        else:
            out.append(nan_to_null((r.option("multiLine", True) if kind == "array" else r).json(group)))
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """Paths under a glob in whatever file system it names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found or [])


def write_any(df: DataFrame, path: str, mode: str = "overwrite", single: bool = False) -> str:
    """df as the path's format. JSON has nulls spelled out and no NaN; single: one file, for small tables."""
    kind = format_of(path)
    w = nan_to_null(df)
    w = (w.coalesce(1) if single else w).write.mode(mode)
    if kind == "parquet":
        w.parquet(path)
    elif kind == "csv":
        w.option("header", True).csv(path)
    else:
        w.option("ignoreNullFields", "false").json(path)
    return path


def export(df: DataFrame, folder: str, name: str, formats=("parquet", "csv", "jsonl")) -> dict[str, str]:
    """df in several formats; the path of each."""
    if bad := set(formats) - {"parquet", "csv", "json", "jsonl"}:
        raise ValueError(f"unknown formats: {sorted(bad)}")
    return {f: write_any(df, f"{folder}/{name}.{f}") for f in formats}


def put_jsonl(df: DataFrame, root: str, path: str | None = None, upsert: bool = True) -> dict:
    """df as JSON lines under a store's root (a bucket URI); the default path has the UTC time."""
    path = path or time.strftime("data/%Y%m%dT%H%M%SZ.jsonl", time.gmtime())
    write_any(df, f"{root.rstrip('/')}/{path}", "overwrite" if upsert else "error")
    return {"root": root, "path": path, "rows": df.count()}


def get_jsonl(spark: SparkSession, root: str, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table that put_jsonl wrote; an empty one has no columns unless a schema is given."""
    return read_any(spark, f"{root.rstrip('/')}/{path}", schema)


def write_document(spark: SparkSession, text: str | dict | list, path: str) -> str:
    """A small JSON document or text, as one file through Spark's file systems."""
    body = text if isinstance(text, str) else json.dumps(text, indent=2, ensure_ascii=False)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()
    return path


def read_document(spark: SparkSession, path: str, default=None):
    """A JSON document, or the default where there is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return default
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def debug_dump(df: DataFrame, folder: str, n: int = 10) -> str:
    """The first n rows, for a look by eye."""
    return write_any(df.limit(n), f"{folder}/{time.strftime('%Y%m%dT%H%M%SZ', time.gmtime())}.jsonl", single=True)
