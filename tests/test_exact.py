from __future__ import annotations

import random

from pyspark.sql import functions as F

from chatloom.functions.variant import parse_strict
from chatloom.operators.exact import drop_rows, exact_copies, exact_log, record_key
from chatloom.operators.order import index_by_order
from chatloom.operators.skew import hot_keys


def keys(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    return [
        r[0] for r in df.select(record_key(parse_strict(F.col("raw")), F.col("raw"))).collect()
    ]


def test_equal_records_have_equal_keys(spark):
    for same in (
        ['{"a":1,"b":"x"}', ' { "b" : "x", "a":1 }'],
        ['{"a":"\\u00e9\\/"}', '{"a":"é/"}'],
        ['{"a":1.0}', '{"a":1.00}', '{"a":10e-1}'],
        ['{"a":1e2}', '{"a":100.0}'],
        ['{"a":[1,2.5,"x"],"b":{"d":1,"c":2}}', '{"b":{"c":2,"d":1},"a":[1,2.50,"x"]}'],
        ['{"a":1,"a":2}', '{"a":2}'],
        ['{"n":123456789012345678901234567890}', '{"n": 123456789012345678901234567890}'],
    ):
        assert len(set(keys(spark, *same))) == 1, same


def test_different_records_have_different_keys(spark):
    different = [
        '{"a":1}', '{"a":1.0}', '{"a":"1"}', '{"a":true}', '{"a":null}', "{}", '{"b":1}',
        '{"a":[1]}', '{"a":[1.0]}', '{"a":[1,"x"]}', '{"a":[1.0,"x"]}', '{"a":{"b":1}}',
        '{"a":1,"b":1}', '{"DECIMAL":1}', '{"a DECIMAL":1}', '{"a":"x "}',
        '{"a":123456789012345678901234567890}', '{"a":123456789012345678901234567891}',
    ]
    assert len(set(keys(spark, *different))) == len(different)


def keyed(spark, rows=3000):
    """A third of all rows has one key."""
    rng = random.Random(5)
    pairs = [(i, "hot" if rng.random() < 0.34 else f"k{rng.randrange(1500)}") for i in range(rows)]
    rng.shuffle(pairs)
    return spark.createDataFrame(pairs, "i long, key string").repartition(7), pairs


def test_copies_point_to_the_first_row_also_for_hot_keys(spark):
    df, pairs = keyed(spark)
    first = {}
    for i, key in sorted(pairs):
        first.setdefault(key, i)
    expected = {i: first[key] for i, key in pairs if first[key] != i}
    for hot_rows in (10, 10**6):
        copies, count = exact_copies(df, "i", hot_rows=hot_rows)
        assert {r.i: r.retained for r in copies.collect()} == expected
        assert count == len(expected)
        kept = {r.i for r in drop_rows(df, copies, "i").collect()}
        assert kept == set(first.values())


def test_hot_keys_are_few(spark):
    df, pairs = keyed(spark)
    assert hot_keys(df, "key", len(pairs), hot_rows=10) == ["hot"]
    assert hot_keys(df, "key", len(pairs)) == []


def test_no_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i long, key string")
    copies, count = exact_copies(df, "i")
    assert count == 0 and copies.isEmpty()


def test_log(spark):
    df = spark.createDataFrame(
        [(0, "k", "r0"), (3, "k", "r3"), (9, "k", "r9")], "i long, key string, record string"
    )
    rows = exact_log(exact_copies(df, "i")[0], df, "i").orderBy("duplicate_source_index").collect()
    assert [tuple(r) for r in rows] == [
        (3, 0, "exact_duplicate", 1.0, "r3"), (9, 0, "exact_duplicate", 1.0, "r9")
    ]


def test_dense_index_over_gaps(spark):
    rng = random.Random(1)
    values = rng.sample(range(10**6), 2000)
    df = spark.createDataFrame([(v,) for v in values], "n long").repartition(5)
    rows = index_by_order(df, "n", "at").collect()
    assert {r.n: r["at"] for r in rows} == {v: i for i, v in enumerate(sorted(values))}
