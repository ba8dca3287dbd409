"""Transforms of chat histories: arrays of ``STRUCT<role, content>`` in, the same out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.text import PY_WHITESPACE, py_strip

# Block marks, switch and turn formats of the chat template.
THINK_BLOCK = "(?s)<think>.*?</think>[" + PY_WHITESPACE + "]*"
NO_THINK = "/no_think"
TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>"
EMPTY_THOUGHT = "<think>\n\n</think>\n\n"
HISTORY_ROLES = ("user", "assistant")


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def strip_reasoning(text: Column) -> Column:
    """Drop every closed think block and the whitespace behind it; an unclosed one stays."""
    return py_strip(F.regexp_replace(text, F.lit(THINK_BLOCK), F.lit("")))


def history_from_roles(history: Column) -> Column:
    """Keep user and assistant messages (exact spelling), both without reasoning."""
    spoken = F.filter(
        F.coalesce(history, F.array().cast("array<struct<role:string,content:string>>")),
        lambda m: m["role"].isin(*HISTORY_ROLES),
    )
    return F.transform(
        spoken, lambda m: message(m["role"], strip_reasoning(F.coalesce(m["content"], F.lit(""))))
    )


def history_from_pairs(pairs: Column) -> Column:
    """(user, assistant) pairs to messages, without empty sides; the user side stays as it is."""

    def spoken(pair: Column) -> Column:
        sides = F.array(
            F.struct(
                pair["user"].alias("raw"),
                F.lit("user").alias("role"),
                pair["user"].alias("content"),
            ),
            F.struct(
                pair["assistant"].alias("raw"),
                F.lit("assistant").alias("role"),
                strip_reasoning(pair["assistant"]).alias("content"),
            ),
        )
        present = F.filter(sides, lambda s: F.coalesce(s["raw"] != "", F.lit(False)))
        return F.transform(present, lambda s: message(s["role"], s["content"]))

    empty = F.array().cast("array<struct<user:string,assistant:string>>")
    return F.flatten(F.transform(F.coalesce(pairs, empty), spoken))


def request_messages(system_prompt: Column, history: Column, query: Column) -> Column:
    """System prompt, cleaned history, new user message."""
    return F.concat(
        F.array(message("system", system_prompt)), history, F.array(message("user", query))
    )


def suppress_thinking(messages: Column) -> Column:
    """Put the no-think switch into a leading system message, or prepend one."""
    head = F.get(messages, F.lit(0))
    switched = F.array(
        message(head["role"], F.concat(head["content"], F.lit("\n" + NO_THINK)))
    )
    rest = F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0)))
    return F.when(head["role"] == "system", F.concat(switched, rest)).otherwise(
        F.concat(F.array(message("system", F.lit(NO_THINK))), messages)
    )


def turn_prompt(query: Column, *, thinking: bool = False) -> Column:
    """Prompt text of one user turn; the non-thinking form closes an empty thought at once."""
    return F.concat(
        F.lit(f"{TURN_OPEN}user\n"),
        query,
        F.lit(f"{TURN_CLOSE}\n{TURN_OPEN}assistant\n" + ("" if thinking else EMPTY_THOUGHT)),
    )
