"""Records of three formats to validated conversations, with the first error of each bad record.

Everything is one projection: no shuffle and no Python. Messages pass through a common form,
``ARRAY<STRUCT<is_entry, role, content>>``, where ``content`` is NULL unless it is a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.roles import SYSTEM_ROLE, chat_role, fold_role
from chatloom.functions.text import is_blank, py_strip
from chatloom.functions.variant import field, is_object, list_or_null, py_text, string_or_null

# Error texts.
NO_CONTENT = "Conversation message content must be a non-empty string"
BAD_ROLE = "Unsupported role: "
NO_INSTRUCTION = "Alpaca record is missing a non-empty instruction"
NO_MESSAGES = "ShareGPT record is missing conversations/messages"
BAD_ENTRY = "Each conversation entry must be an object"
BAD_FRAME = "Conversation must start with a user turn and end with an assistant turn"
NOT_ALTERNATING = "User and assistant turns must alternate"


def _entry(role: Column, content: Column, is_entry: Column | None = None) -> Column:
    return F.struct(
        (F.lit(True) if is_entry is None else is_entry).alias("is_entry"),
        role.alias("role"),
        content.alias("content"),
    )


def _missing(text: Column) -> Column:
    return F.coalesce(is_blank(text), F.lit(True))


def _qa(record: Column) -> tuple[Column, Column]:
    question = string_or_null(field(record, "question", "input"))
    answer = string_or_null(field(record, "answer", "output"))
    messages = F.array(_entry(F.lit("human"), question), _entry(F.lit("gpt"), answer))
    return messages, F.lit(None).cast("string")


def _alpaca(record: Column) -> tuple[Column, Column]:
    instruction = string_or_null(field(record, "instruction"))
    extra = string_or_null(field(record, "input"))
    # concat_ws leaves out NULL, which is what an unusable input becomes.
    prompt = F.concat_ws("\n\n", py_strip(instruction), F.nullif(py_strip(extra), F.lit("")))
    output = string_or_null(field(record, "output"))
    messages = F.array(_entry(F.lit("human"), prompt), _entry(F.lit("gpt"), output))
    return messages, F.when(_missing(instruction), NO_INSTRUCTION)


def _sharegpt(record: Column) -> tuple[Column, Column]:
    entries = list_or_null(field(record, "conversations", "messages"))
    messages = F.transform(
        entries,
        lambda m: _entry(
            py_text(field(m, "from", "role"), "None"),
            string_or_null(field(m, "value", "content")),
            is_object(m),
        ),
    )
    return messages, F.when(F.coalesce(F.size(entries), F.lit(-1)) <= 0, NO_MESSAGES)


_FORMATS = {"qa": _qa, "alpaca": _alpaca, "sharegpt": _sharegpt}


def convert_records(records: DataFrame, record_format: str, value: str = "v") -> DataFrame:
    """Add ``conversations`` and ``error``; exactly one of the two is NULL in each row."""
    messages, early = _FORMATS[record_format](F.col(value))
    return _validate(records.withColumn("_messages", messages).withColumn("_early", early))


def convert_messages(df: DataFrame, messages: str = "messages") -> DataFrame:
    """The same for a typed ``ARRAY<STRUCT<role, content>>`` column, e.g. from a turn table."""
    typed = F.transform(
        messages, lambda m: _entry(F.coalesce(m["role"], F.lit("None")), m["content"])
    )
    early = F.when(F.coalesce(F.size(messages), F.lit(-1)) <= 0, NO_MESSAGES)
    return _validate(df.withColumn("_messages", typed).withColumn("_early", early))


def _validate(df: DataFrame) -> DataFrame:
    # Two steps, so that each text is stripped once.
    stripped = F.transform(
        "_messages",
        lambda m: F.struct(
            m["is_entry"].alias("is_entry"),
            m["role"].alias("written_role"),
            fold_role(m["role"]).alias("folded"),
            py_strip(m["content"]).alias("content"),
        ),
    )
    checked = F.transform(
        stripped,
        lambda m: F.struct(
            chat_role(m["folded"]).alias("role"),
            m["content"].alias("content"),
            F.when(~m["is_entry"], BAD_ENTRY)
            .when(F.coalesce(m["content"] == "", F.lit(True)), NO_CONTENT)
            .when(chat_role(m["folded"]).isNull(), F.concat(F.lit(BAD_ROLE), m["written_role"]))
            .alias("error"),
        ),
    )
    # F.filter keeps message order, so the first entry is the first failing message.
    first_error = F.get(F.filter("_checked", lambda m: m["error"].isNotNull()), F.lit(0))["error"]
    dialogue = F.transform(
        F.filter("_checked", lambda m: m["role"] != SYSTEM_ROLE), lambda m: m["role"]
    )
    turns = F.size("_roles")
    framed = (
        (turns >= 2)
        & (F.get("_roles", F.lit(0)) == "human")
        & (F.get("_roles", turns - 1) == "gpt")
    )
    before_last = F.slice("_roles", F.lit(1), F.greatest(turns - 1, F.lit(0)))
    after_first = F.slice("_roles", F.lit(2), F.greatest(turns - 1, F.lit(0)))
    repeated = F.exists(
        F.zip_with(before_last, after_first, lambda left, right: left == right), lambda same: same
    )
    error = F.coalesce(
        F.col("_early"),
        F.col("_first_error"),
        F.when(~framed, BAD_FRAME).when(repeated, NOT_ALTERNATING),
    )
    normalized = F.transform(
        "_checked", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value"))
    )
    return (
        # Exploding a one-element array keeps a later filter on ``error`` above this point. Pushed
        # below it, the filter would repeat the work on the texts once for every use.
        df.select("*", F.explode(F.array(checked)).alias("_checked"))
        .withColumn("_first_error", first_error)
        .withColumn("_roles", dialogue)
        .withColumn("error", error)
        .withColumn("conversations", F.when(F.col("error").isNull(), normalized))
        .drop("_messages", "_early", "_checked", "_first_error", "_roles")
    )


def error_sample(converted: DataFrame, record_no: str, rows: int = 20) -> DataFrame:
    """The first rejected records as printed lines; top-k, so no full sort."""
    text = F.concat(F.lit("record "), F.col(record_no).cast("string"), F.lit(": "), F.col("error"))
    first = converted.where(F.col("error").isNotNull()).orderBy(record_no).limit(rows)
    return first.select(record_no, text.alias("message"))
