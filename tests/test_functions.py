from __future__ import annotations

import hypothesis.strategies as st
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from chatloom.functions import chat
from chatloom.functions.roles import chat_role, fold_role
from chatloom.functions.text import PY_WHITESPACE, is_blank, py_strip
from chatloom.functions.variant import field, is_object, parse_strict, py_text, string_or_null

TEXT = st.text(alphabet=st.sampled_from(PY_WHITESPACE + "ab é漢😀​﻿"), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=30, max_size=60))
def test_strip_is_that_of_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", py_strip(F.col("t")).alias("s"), is_blank(F.col("t")).alias("b")).collect()
    assert [(r.s, r.b) for r in rows] == [(r.t.strip(), not r.t.strip()) for r in rows]


def test_whitespace_is_complete():
    assert set(PY_WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def _parsed(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", parse_strict(F.col("t")).alias("v")
    )


def test_only_one_whole_json_value_is_accepted(spark):
    good = ['{"a":1}', ' {"a":1}\t', "[1,2]", '"x"', "null", '{"a":1,"a":2}', '{"a":[{"b":{}}]}']
    bad = ['{"a":1} x', '{"a":1}{"b":2}', '{"a":1}]', '{"a":1},2', "nul", "", '{"a":', "1 2", "{}}"]
    rows = _parsed(spark, *good, *bad).select("t", F.col("v").isNotNull().alias("ok")).collect()
    assert {r.t for r in rows if r.ok} == set(good)


def test_fallback_looks_at_presence_only(spark):
    rows = _parsed(
        spark, '{"a":"x","b":"y"}', '{"b":"y"}', '{"a":null,"b":"y"}', '{"a":"","b":"y"}', "{}"
    ).select(F.to_json(field(F.col("v"), "a", "b")).alias("f"))
    assert [r.f for r in rows.collect()] == ['"x"', '"y"', "null", '""', None]


def test_types_are_those_of_the_json_text(spark):
    values = _parsed(spark, '"1"', "1", "1.0", "true", "null", "{}", "[]")
    rows = values.select(
        string_or_null(F.col("v")).alias("s"),
        is_object(F.col("v")).alias("o"),
        py_text(F.col("v"), "gone").alias("p"),
    ).collect()
    assert [r.s for r in rows] == ["1"] + [None] * 6
    assert [r.o for r in rows] == [False] * 5 + [True, False]
    assert [r.p for r in rows][3:5] == ["True", "None"]
    absent = _parsed(spark, "{}").select(py_text(field(F.col("v"), "a"), "gone"))
    assert absent.first()[0] == "gone"


def test_roles(spark):
    written = ["user", " Human　", "GPT", "assistant\n", "System", "tool", "", None]
    df = spark.createDataFrame([(r,) for r in written], "r string")
    got = [r[0] for r in df.select(chat_role(fold_role(F.col("r")))).collect()]
    assert got == ["human", "human", "gpt", "gpt", "system", None, None, None]


def test_reasoning_is_removed_only_if_closed(spark):
    cases = {
        "<think>a</think>\n\nb": "b",
        "a <think>x\ny</think> 　b<think></think>": "a b",
        "<think>never closed": "<think>never closed",
        "<think>a<think>b</think>c</think>": "c</think>",
        " plain ": "plain",
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert [r[0] for r in df.select(chat.strip_reasoning(F.col("t"))).collect()] == list(
        cases.values()
    )


def _messages(spark, value, schema="h array<struct<role:string,content:string>>"):
    return spark.createDataFrame([(value,)], schema)


def _dump(df, column):
    return [tuple(m) for m in df.select(column).first()[0]]


def test_history_with_roles(spark):
    df = _messages(
        spark,
        [("system", "s"), ("user", " <think>q</think>hi "), ("User", "x"), ("assistant", None)],
    )
    got = _dump(df, chat.history_from_roles(F.col("h")))
    assert got == [("user", "hi"), ("assistant", "")]
    assert _dump(_messages(spark, None), chat.history_from_roles(F.col("h"))) == []


def test_history_with_pairs(spark):
    df = _messages(
        spark,
        [(" q ", "<think>t</think>a"), ("", "b"), ("c", None), (None, "")],
        "h array<struct<user:string,assistant:string>>",
    )
    got = _dump(df, chat.history_from_pairs(F.col("h")))
    assert got == [("user", " q "), ("assistant", "a"), ("assistant", "b"), ("user", "c")]


def test_requests_and_prompts(spark):
    df = _messages(spark, [("user", "a"), ("assistant", "b")])
    request = chat.request_messages(F.lit("sys"), F.col("h"), F.lit("q"))
    assert _dump(df, request) == [
        ("system", "sys"), ("user", "a"), ("assistant", "b"), ("user", "q")
    ]
    assert _dump(df, chat.suppress_thinking(request))[:2] == [
        ("system", "sys\n/no_think"), ("user", "a")
    ]
    assert _dump(df, chat.suppress_thinking(F.col("h")))[0] == ("system", "/no_think")
    assert _dump(_messages(spark, []), chat.suppress_thinking(F.col("h"))) == [
        ("system", "/no_think")
    ]
    prompt = df.select(chat.turn_prompt(F.lit("q"))).first()[0]
    assert prompt == (
        "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n"
    )
