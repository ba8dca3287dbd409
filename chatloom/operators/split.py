"""Seeded order, exact-size split and sample cap, decided row by row.

The order is that of SHA-256 over seed and index. The k-th smallest hash is found by counting hash
prefixes, a few digits per pass, without sorting or moving any record. Membership of a row is then a
comparison with that cutoff, so splitting is a plain filter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 16**DIGITS counts reach the driver per pass; below FEW_ROWS rows the rest is ordered directly.
DIGITS = 3
FEW_ROWS = 4096


def order_hash(seed: int, index: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), index.cast("string")), 256)


def seeded_order(df: DataFrame, seed: int, index: str = "source_index") -> DataFrame:
    """All rows in seeded order; hashes are uniform, so the range partitions are balanced."""
    return df.orderBy(order_hash(seed, F.col(index)), index)


@dataclass(frozen=True)
class Cutoff:
    """Hash of the last row taken; ``None`` takes nothing."""

    last: str | None
    seed: int

    def takes(self, index: Column) -> Column:
        if self.last is None:
            return F.lit(False)
        return order_hash(self.seed, index) <= self.last


def find_cutoff(df: DataFrame, rows: int, take: int, seed: int, index: str) -> Cutoff:
    """Cutoff of the first ``take`` of ``rows`` rows in seeded order; ``index`` must be unique."""
    take = min(take, rows)
    if take <= 0:
        return Cutoff(None, seed)
    hashes = df.select(order_hash(seed, F.col(index)).alias("h"))
    prefix, left, candidates = "", take, rows
    while candidates > FEW_ROWS:
        digits = F.substring("h", len(prefix) + 1, DIGITS).alias("digits")
        counted = hashes.where(F.col("h").startswith(prefix)).groupBy(digits).count().collect()
        for digit, count in sorted((row["digits"], row["count"]) for row in counted):
            if left <= count:
                prefix, candidates = prefix + digit, count
                break
            left -= count
    few = hashes.where(F.col("h").startswith(prefix)).orderBy("h").limit(left)
    return Cutoff(few.agg(F.max("h")).first()[0], seed)


def eval_size(rows: int, ratio: float) -> int:
    """At least one row, otherwise rounded half to even; both sides must get rows."""
    if not 0 < ratio < 1:
        raise ValueError("eval_ratio has to lie between 0 and 1")
    if rows < 2:
        raise ValueError("a split needs at least two valid records that differ")
    size = max(1, round(rows * ratio))
    if size >= rows:
        raise ValueError("the ratio leaves no record for training")
    return size


def train_eval_split(
    df: DataFrame, rows: int, ratio: float, seed: int, index: str = "source_index"
) -> DataFrame:
    """Add ``split``: ``eval`` for the first rows in seeded order, ``train`` for the rest."""
    cutoff = find_cutoff(df, rows, eval_size(rows, ratio), seed, index)
    return df.withColumn("split", F.when(cutoff.takes(F.col(index)), "eval").otherwise("train"))


def sample_cap(
    df: DataFrame, rows: int, cap: int, seed: int, index: str = "source_index"
) -> DataFrame:
    """The first ``cap`` rows in seeded order; a negative cap means all."""
    if cap < 0:
        return df
    return df.where(find_cutoff(df, rows, cap, seed, index).takes(F.col(index)))
