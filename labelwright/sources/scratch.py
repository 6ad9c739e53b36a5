"""Intermediate tables in the shared folder that the cluster names.

A written table cuts lineage, survives the loss of executors and gives its row
count from the file footers. The folder is ``spark.checkpoint.dir``; only a
local-mode session without that setting gets a temporary one.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

_local_roots: dict[str, str] = {}
_written: dict[str, list[str]] = {}
_scopes = threading.local()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="labelwright-")
    return _local_roots[sc.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    for scope in getattr(_scopes, "open", []):
        scope.append(path)
    return path


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[list[str]]:
    """Delete on leaving what this thread has stored meanwhile; paths taken out of the given list stay."""
    scopes = _scopes.open = getattr(_scopes, "open", [])
    paths: list[str] = []
    scopes.append(paths)
    try:
        yield paths
    finally:
        scopes.pop()
        kept = _written.get(spark.sparkContext.applicationId, [])
        for path in paths:
            _delete(spark, path)
            kept.remove(path)


def store(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write the frame as Parquet, partitioned if asked, and return the written table.

    Shuffle files of the write are never read again and go with its end, not when the driver
    collects its garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.partitionBy(by) if by else df.write
    with _shuffles_end(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


@contextlib.contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    given = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if given is None else spark.conf.set(_CLEANUP, given)


BROADCAST_BYTES = 32 << 20


def small(table: DataFrame, row_bytes: int, rows: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The table, to be broadcast if its counted rows fit the limit; else it is shuffled."""
    rows = table.count() if rows is None else rows
    return F.broadcast(table) if rows * row_bytes <= limit else table


def _delete(spark: SparkSession, text: str) -> None:
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(text)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def discard(spark: SparkSession) -> int:
    """Delete the tables this application stored, once their results are no longer read."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for text in paths:
        _delete(spark, text)
    return len(paths)
