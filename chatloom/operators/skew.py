"""Joining many rows to a table with unique keys when one key may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than 1/SALTS of all rows, so there are fewer than SALTS hot keys.
SALTS = 128

# Keys of up to this many rows are never worth splitting.
HOT_ROWS = 100_000


def hot_limit(rows: int, hot_rows: int = HOT_ROWS) -> int:
    """A key with more rows than this is hot."""
    return max(hot_rows, rows // SALTS + 1)


def hot_keys(facts: DataFrame, key: str, rows: int, hot_rows: int = HOT_ROWS) -> list:
    """The hot keys among ``rows`` rows: fewer than SALTS values, found with partial counts."""
    limit = hot_limit(rows, hot_rows)
    if rows <= limit:
        return []
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    frequent = counts.where((F.col("_rows") > limit) & F.col(key).isNotNull())
    return [row[0] for row in frequent.select(key).collect()]


def lookup(
    facts: DataFrame, unique: DataFrame, key: str, spread: Column, hot: list, how: str = "inner"
) -> DataFrame:
    """Join ``facts`` to ``unique`` (one row per key), splitting the hot keys over SALTS tasks.

    ``spread`` is a column of ``facts`` that differs between rows of one key.
    """
    if not hot:
        return facts.join(unique, key, how)
    is_hot = F.col(key).isin(hot)
    salted_facts = facts.withColumn(
        "_salt",
        F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"),
    )
    every_salt = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted_unique = unique.withColumn(
        "_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0))))
    )
    return salted_facts.join(salted_unique, [key, "_salt"], how).drop("_salt")
