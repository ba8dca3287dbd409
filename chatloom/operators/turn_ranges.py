"""Validation of conversations from turn rows, without putting a conversation together.

The rules are those of :mod:`chatloom.operators.convert`. They depend on a conversation only through
a summary that can be put together from summaries of its parts: how many turns there are and how many
besides system turns, the first and the last role of these, whether two neighbours among them have one
role, and the first message error. Turns are dealt into ranges of conversation and turn, so a
conversation with very many turns is spread over many tasks; a range gives one summary for each of
its conversations, and these are merged in order.

Only roles and errors take part; texts are neither moved nor joined. ``normalized_turns`` gives the
turns of valid conversations as rows, for sinks that keep one row per turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.roles import SYSTEM_ROLE, chat_role, fold_role
from chatloom.functions.text import py_strip
from chatloom.operators.convert import BAD_FRAME, BAD_ROLE, NO_CONTENT, NOT_ALTERNATING
from chatloom.operators.skew import HOT_ROWS, hot_keys, lookup
from chatloom.scratch import materialize


def _checked(turns: DataFrame) -> DataFrame:
    """Turns with their role in a conversation and the error of each."""
    written = F.coalesce("role", F.lit("None"))
    role = chat_role(fold_role(written))
    error = F.when(F.coalesce(py_strip(F.col("text")) == "", F.lit(True)), NO_CONTENT).when(
        role.isNull(), F.concat(F.lit(BAD_ROLE), written)
    )
    return turns.select(
        "conv_id", "turn", written.alias("written"), role.alias("role"), error.alias("error")
    )


def summarize_ranges(turns: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row for each range and conversation: ``n_turns``, ``spoken`` (without system turns),
    ``first_role``, ``last_role``, ``repeats`` and ``first_error``."""
    checked = _checked(turns)
    key = ("conv_id", "turn", "written", "error")
    dealt = (
        checked.repartitionByRange(ranges, *key) if ranges else checked.repartitionByRange(*key)
    )
    ranged = materialize(
        dealt.sortWithinPartitions(*key).withColumn("range", F.spark_partition_id()), "turn-ranges"
    )
    spoken = F.col("role") != SYSTEM_ROLE
    in_range = Window.partitionBy("range", "conv_id").orderBy("turn", "written", "error")
    earlier = in_range.rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(spoken, F.col("role")), ignorenulls=True).over(earlier)
    place = F.struct("turn", "written", "error")
    return (
        ranged.withColumn("again", spoken & (F.col("role") == before))
        .groupBy("range", "conv_id")
        .agg(
            F.count(F.lit(1)).alias("n_turns"),
            F.count_if(spoken).alias("spoken"),
            F.min_by(F.when(spoken, F.col("role")), F.when(spoken, place)).alias("first_role"),
            F.max_by(F.when(spoken, F.col("role")), F.when(spoken, place)).alias("last_role"),
            F.count_if("again").alias("repeats"),
            F.min_by("error", F.when(F.col("error").isNotNull(), place)).alias("first_error"),
        )
    )


def merge_ranges(summaries: DataFrame) -> DataFrame:
    """The same over whole conversations, one row each."""
    in_order = Window.partitionBy("conv_id").orderBy("range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("last_role", ignorenulls=True).over(earlier)
    heard, failed = F.col("first_role").isNotNull(), F.col("first_error").isNotNull()
    return (
        summaries.withColumn("meets", F.coalesce(F.col("first_role") == before, F.lit(False)))
        .groupBy("conv_id")
        .agg(
            F.sum("n_turns").alias("n_turns"),
            F.sum("spoken").alias("spoken"),
            F.min_by("first_role", F.when(heard, F.col("range"))).alias("first_role"),
            F.max_by("last_role", F.when(heard, F.col("range"))).alias("last_role"),
            (F.sum("repeats") + F.count_if("meets")).alias("repeats"),
            F.min_by("first_error", F.when(failed, F.col("range"))).alias("first_error"),
        )
    )


def validate_turns(turns: DataFrame, ranges: int | None = None) -> DataFrame:
    """``conv_id, n_turns, error`` of every conversation of ``conv_id, turn, role, text`` rows.

    ``ranges`` spreads the work and does not change the result. Turns of one number are taken in
    the order of their roles.
    """
    merged = merge_ranges(summarize_ranges(turns, ranges))
    framed = (
        (F.col("spoken") >= 2) & (F.col("first_role") == "human") & (F.col("last_role") == "gpt")
    )
    error = F.coalesce(
        F.col("first_error"),
        F.when(~F.coalesce(framed, F.lit(False)), BAD_FRAME).when(
            F.col("repeats") > 0, NOT_ALTERNATING
        ),
    )
    return merged.select("conv_id", "n_turns", error.alias("error"))


def normalized_turns(
    turns: DataFrame, validity: DataFrame, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``conv_id, turn, from, value`` of the turns of valid conversations.

    ``validity`` is materialized. A conversation with a large part of all turns is joined in many
    tasks.
    """
    valid = validity.where(F.col("error").isNull()).select("conv_id", "n_turns")
    rows = validity.agg(F.coalesce(F.sum("n_turns"), F.lit(0))).first()[0]
    hot = []
    if rows > hot_rows:
        hot = hot_keys(turns, "conv_id", rows, hot_rows)
    spread = F.col("turn")
    joined = lookup(turns, valid.select("conv_id"), "conv_id", spread, hot)
    return joined.select(
        "conv_id",
        "turn",
        chat_role(fold_role(F.col("role"))).alias("from"),
        py_strip(F.col("text")).alias("value"),
    )
