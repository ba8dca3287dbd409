"""Intermediate tables on shared storage.

A table that several later steps read is written once under the cluster's checkpoint folder. The
written files survive the loss of executors, cut the lineage, and let later steps read only the
columns they need.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# With it, a query's shuffle files go when the query ends, not when the driver collects its garbage.
FREE_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Each driver process writes below a folder of its own.
_RUN = uuid4().hex

# Tables written so far in each open :func:`temporary`, with their paths.
_OPEN: list[list[tuple[DataFrame, str]]] = []


def scratch_root(spark: SparkSession) -> str:
    """The configured checkpoint folder, else a folder beside the session's tables.

    The warehouse is on a file system that all executors share, too. What a process wrote there is
    deleted when it ends.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    atexit.unregister(_discard_at_exit)
    atexit.register(_discard_at_exit, spark)
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/chatloom-scratch"


def _discard_at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None:
        discard(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_run_folder(spark)}/{name}-{uuid4().hex}"


def _run_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/chatloom-{_RUN}"


def discard(spark: SparkSession) -> None:
    """Delete what this process wrote, once none of its DataFrames is needed any more."""
    context = spark.sparkContext
    _delete(spark, _run_folder(spark))


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are written inside are deleted at the end, but for those that were handed to the
    function. No DataFrame that reads others may be used after that."""
    written: list[tuple[DataFrame, str]] = []
    kept: list[DataFrame] = []
    _OPEN.append(written)

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        _OPEN.remove(written)
    for table, path in written:
        if not any(table is one for one in kept):
            _delete(spark, path)
        elif _OPEN:
            _OPEN[-1].append((table, path))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind."""
    before = spark.conf.get(FREE_SHUFFLES_CONF, "false")
    spark.conf.set(FREE_SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES_CONF, before)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return a scan of what was written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path)
    if _OPEN:
        _OPEN[-1].append((table, path))
    return table


def materialize_and_measure(
    df: DataFrame, name: str, compression: str | None = None, **measures: Column
) -> tuple[DataFrame, dict[str, Any]]:
    """The same, with aggregates over the rows taken while they are written, not in another job."""
    watch = Observation()
    observed = df.observe(watch, *(column.alias(key) for key, column in measures.items()))
    return materialize(observed, name, compression), watch.get
