"""Tables with one row per turn, to conversation arrays and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conversations_from_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` rows to one ``messages`` array per conversation."""
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    messages = F.transform(
        F.sort_array(F.collect_list(turn)),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
    )
    return turns.groupBy("conv_id").agg(messages.alias("messages"))


def turns_from_conversations(conversations: DataFrame, messages: str = "messages") -> DataFrame:
    """The inverse: one row per array entry, ``turn`` counted from 0."""
    rows = conversations.select("conv_id", F.posexplode(messages).alias("turn", "_message"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "_message.*")
