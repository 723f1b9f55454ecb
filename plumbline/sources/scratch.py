"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders written by this process and not yet cleared, by application.
_WRITTEN: dict[str, list[str]] = {}


def root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only for a local master that has none set."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str | None = None) -> str:
    """A path under root() that clear() will delete."""
    path = f"{root(spark)}/plumbline/{name or uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as soon as each write ends; what it wrote stands for them from there on."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame) -> DataFrame:
    """df, written once as Parquet under root() and read again.

    It cuts the lineage like checkpoint(), but runs the plan once, compresses,
    and lets later reads prune columns. A lost executor costs nothing that was
    written.
    """
    spark = df.sparkSession
    path = new_path(spark)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file; an error if there is one of the new name."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    where = hadoop(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(where, hadoop(to)):
        raise FileExistsError(to)


def clear(spark: SparkSession) -> int:
    """Deletes this application's intermediate tables, once the results that need them are written; how many."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete(spark, path)
    return len(paths)
