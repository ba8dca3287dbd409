"""What several of these operators share: tables by name, written intermediates, keyed hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.scratch import materialize, scratch_path

__all__ = ["delete_path", "fresh", "hand_back_memory", "keyed_long", "materialize", "path_exists", "rename_path", "scratch_path", "table"]

# Runs of anything but ASCII white space, as in text files; the same in every locale.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores in front until it is not one of ``taken``."""
    used = {other.lower() for other in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def keyed_long(key: str, *parts: Column) -> Column:
    """A non-negative 60-bit number that depends on a secret key and on every part."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hand_back_memory() -> None:
    """Return what a task has freed to the system: Python workers are used again by later stages,
    which would otherwise have to live beside it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only the GNU C library has it
        return


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path, files = _hadoop(spark, path)
    files.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, files = _hadoop(spark, path)
    return files.exists(hadoop_path)


def rename_path(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder in one step; False if the target is there already."""
    source_path, files = _hadoop(spark, source)
    target_path, _ = _hadoop(spark, target)
    files.mkdirs(target_path.getParent())
    return not files.exists(target_path) and files.rename(source_path, target_path)
