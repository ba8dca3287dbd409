from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from chatloom.functions.variant import parse_strict
from chatloom.operators.convert import (
    BAD_ENTRY,
    BAD_FRAME,
    NO_CONTENT,
    NO_INSTRUCTION,
    NO_MESSAGES,
    NOT_ALTERNATING,
    convert_records,
    error_sample,
)
from chatloom.operators.texts import (
    NO_LIST,
    NO_USER,
    first_text_error,
    require_texts,
    text_of_records,
)
from chatloom.operators.texts import BAD_ENTRY as TEXT_BAD_ENTRY


def records(spark, *objects):
    rows = [(i, json.dumps(o)) for i, o in enumerate(objects)]
    df = spark.createDataFrame(rows, "i long, raw string")
    return df.withColumn("v", parse_strict(F.col("raw")))


def outcome(spark, record_format, *objects):
    rows = convert_records(records(spark, *objects), record_format).orderBy("i").collect()
    return [r.error or [tuple(m) for m in r.conversations] for r in rows]


def chat(*pairs):
    return {"conversations": [{"from": role, "value": text} for role, text in pairs]}


def test_qa(spark):
    pair = [("human", "q"), ("gpt", "a")]
    assert outcome(
        spark,
        "qa",
        {"question": " q　", "answer": "a\n"},
        {"input": "q", "output": "a", "other": [1]},
        {"question": "q", "input": "no", "answer": "a", "output": "no"},
        {"question": None, "input": "q", "answer": "a"},
        {"question": "", "input": "q", "answer": "a"},
        {"question": 5, "answer": "a"},
        {"question": "q", "answer": ["a"]},
        {},
    ) == [pair, pair, pair] + [NO_CONTENT] * 5


def test_alpaca(spark):
    assert outcome(
        spark,
        "alpaca",
        {"instruction": " i ", "output": "o"},
        {"instruction": "i", "input": " x ", "output": "o"},
        {"instruction": "i", "input": "\t", "output": "o"},
        {"instruction": "i", "input": 5, "output": "o"},
        {"instruction": "i", "input": None, "output": "o"},
        {"instruction": " ", "output": 5},
        {"instruction": 5, "output": "o"},
        {"instruction": "i", "output": 5},
        {"instruction": "i"},
    ) == [
        [("human", "i"), ("gpt", "o")],
        [("human", "i\n\nx"), ("gpt", "o")],
        [("human", "i"), ("gpt", "o")],
        [("human", "i"), ("gpt", "o")],
        [("human", "i"), ("gpt", "o")],
        NO_INSTRUCTION,
        NO_INSTRUCTION,
        NO_CONTENT,
        NO_CONTENT,
    ]


def test_sharegpt_messages(spark):
    good = [("human", "q"), ("gpt", "a")]
    assert outcome(
        spark,
        "sharegpt",
        chat(("USER", "q"), ("assistant ", "a")),
        {"messages": [{"role": "human", "content": "q"}, {"role": "gpt", "value": "a"}]},
        {"conversations": None, "messages": chat(("user", "q"))["conversations"]},
        {"conversations": []},
        {"conversations": "text"},
        {"conversations": {"from": "user"}},
        {},
        {"conversations": ["q"]},
        {"conversations": [{"from": "user", "value": "q"}, []]},
        chat(("tool", " "), ("user", 5)),
        chat(("tool", "x"), ("user", 5)),
        chat((None, "x")),
        {"conversations": [{"value": "x"}]},
        {"conversations": [{"from": None, "role": "user", "value": "x"}]},
        {"conversations": [{"from": "user", "value": None, "content": "x"}]},
    ) == [
        good, good, NO_MESSAGES, NO_MESSAGES, NO_MESSAGES, NO_MESSAGES, NO_MESSAGES,
        BAD_ENTRY, BAD_ENTRY, NO_CONTENT, "Unsupported role: tool",
        "Unsupported role: None", "Unsupported role: None", "Unsupported role: None", NO_CONTENT,
    ]


@pytest.mark.parametrize(
    "roles, expected",
    [
        ("ug", None),
        ("sugug", None),
        ("usgs", None),
        ("ugs", None),
        ("u", BAD_FRAME),
        ("s", BAD_FRAME),
        ("gu", BAD_FRAME),
        ("ugu", BAD_FRAME),
        ("gug", BAD_FRAME),
        ("uugg", NOT_ALTERNATING),
        ("uug", NOT_ALTERNATING),
        ("usug", NOT_ALTERNATING),
        ("ugsg", NOT_ALTERNATING),
    ],
)
def test_dialogue_shape(spark, roles, expected):
    names = {"u": "user", "g": "gpt", "s": "system"}
    (got,) = outcome(spark, "sharegpt", chat(*((names[r], "x") for r in roles)))
    if expected is None:
        assert [role[0] for role, _ in got] == [{"u": "h"}.get(r, r) for r in roles]
    else:
        assert got == expected


def test_a_filter_on_errors_does_not_repeat_the_conversion(spark):
    converted = convert_records(records(spark, {}), "sharegpt").where(F.col("error").isNull())
    plan = converted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(trim(") == 1


def test_error_sample_is_the_first_records(spark):
    df = spark.createDataFrame([(n, "bad" if n % 2 else None) for n in range(1, 100)],
                               "record_no long, error string")
    rows = error_sample(df, "record_no").collect()
    assert [r.message for r in rows] == [f"record {n}: bad" for n in range(1, 41, 2)]


def texts(spark, mode, *objects):
    rows = text_of_records(records(spark, *objects), mode).orderBy("i").collect()
    return [r.text_error or r.text for r in rows]


def test_text_modes(spark):
    record = chat(("system", "s"), (" User", " a "), ("gpt", "b"), ("human", "c"))
    odd = {"messages": [{"content": "x"}, {"role": None, "content": "y"}, {"from": 5, "value": "z"}]}
    broken = [{}, {"messages": []}, chat(("user", "a"), ("gpt", " ")), {"messages": [1]}]
    failed = [NO_LIST, NO_LIST, NO_CONTENT, TEXT_BAD_ENTRY]
    assert texts(spark, "first_user", record, odd, *broken) == ["a", NO_USER, *failed]
    assert texts(spark, "all_user", record, odd, *broken) == ["a\nc", NO_USER, *failed]
    assert texts(spark, "full_dialogue", record, odd, *broken) == [
        "system: s\nuser: a\ngpt: b\nhuman: c", ": x\nnone: y\n5: z", *failed
    ]
    with pytest.raises(ValueError):
        texts(spark, "last_user", record)


def test_first_bad_text_fails(spark):
    extracted = text_of_records(records(spark, chat(("user", "a")), {}, {}), "first_user")
    with pytest.raises(ValueError, match="record 1 has no"):
        require_texts(extracted.agg(first_text_error("i")).first()[0])
    require_texts(extracted.where("i = 0").agg(first_text_error("i")).first()[0])
