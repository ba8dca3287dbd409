"""Leakage between training and evaluation sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators.similar import nearest_between
from chatloom.operators.vectors import VectorProfile


def exact_leakage(evaluated: DataFrame, trained: DataFrame, index: str, key: str) -> DataFrame:
    """Rows of ``evaluated`` whose key a row of ``trained`` has, with the first such row.

    Keys are made unique before the join, so a key with very many copies is one row on one side.
    """
    first = trained.groupBy(key).agg(F.min(index).alias("train_index"))
    found = evaluated.select(F.col(index).alias("eval_index"), key).join(first, key)
    return found.select("eval_index", "train_index")


def semantic_leakage(
    evaluated: DataFrame, trained: DataFrame, profile: VectorProfile, threshold: float, **spread
) -> DataFrame:
    """Rows of ``evaluated`` with a row of ``trained`` at least ``threshold`` similar, and the best.

    Both have ``row_index, embedding``, materialized; ``profile`` covers both.
    """
    found = nearest_between(evaluated, trained, profile, threshold, **spread)
    return found.select(
        F.col("duplicate_index").alias("eval_index"),
        F.col("matched_index").alias("train_index"),
        "similarity",
    )


def leakage_rate(leaked: DataFrame, evaluated_rows: int) -> DataFrame:
    """One row: evaluated rows, leaked ones, and their share."""
    count = F.count_distinct("eval_index")
    share = F.round(count / F.lit(max(1, evaluated_rows)), 6)
    return leaked.agg(
        F.lit(evaluated_rows).cast("long").alias("eval_records"),
        count.alias("leaked_records"),
        share.alias("leakage_rate"),
    )
