"""Dense positions over few and many groups, and records picked by reference."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chatloom.operators.marks import referenced, unreferenced
from chatloom.operators.order import index_by_split
from chatloom.operators.removal import removal_details
from chatloom.scratch import materialize


@pytest.mark.parametrize("few", [10**6, 5])
def test_index_over_many_groups(spark, few):
    rng = random.Random(3)
    rows, expected = [], {}
    for file in range(40):
        for start in sorted(rng.sample(range(1000), rng.randrange(1, 4))):
            first = rng.randrange(1 << 40)
            for place in range(rng.randrange(1, 6)):
                expected[file, start, first + place] = len(rows)
                rows.append((f"f{file:03d}", start, first + place))
    rng.shuffle(rows)
    df = materialize(spark.createDataFrame(rows, "file string, start long, at long").repartition(7), "g")
    found = index_by_split(df, ("file", "start"), "at", "i", few).collect()
    assert {(int(r.file[1:]), r.start, r.at): r.i for r in found} == expected
    assert index_by_split(df.limit(0), ("file", "start"), "at", "i", few).count() == 0


@pytest.mark.parametrize("bits, most", [(1 << 27, 1.0), (1 << 15, 1.1), (1 << 16, 1.1)])
def test_few_records_but_the_referenced_pass(spark, bits, most):
    rng = random.Random(4)
    wanted = rng.sample(range(90_000), 600)
    records = spark.range(90_000).select(F.col("id").alias("row_index"), F.lit("t").alias("text"))
    references = spark.createDataFrame([(n,) for n in wanted * 2], "row_index long")
    found = [row.row_index for row in referenced(records, references, bits).collect()]
    assert len(found) == len(set(found)) and set(found) >= set(wanted)
    assert len(found) <= most * len(wanted)
    plan = referenced(records, references, bits)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_details_of_few_among_many(spark):
    log = spark.createDataFrame(
        [(70_000, 5, 3, 0.95, "semantic_duplicate"), (9, 5, 3, 0.93, "semantic_duplicate")],
        "duplicate_index long, matched_index long, retained_index long, similarity double, reason string",
    )
    records = spark.range(80_000).select(
        F.col("id").alias("row_index"), F.concat(F.lit("t"), "id").alias("text"),
        F.concat(F.lit("r"), "id").alias("record"),
    )
    for many in (100, 10**9):
        rows = removal_details(log, 2, records, 80_000, many_records=many).collect()
        assert {(r.duplicate_text, r.matched_text, r.retained_text, r.record) for r in rows} == {
            ("t70000", "t5", "t3", "r70000"), ("t9", "t5", "t3", "r9")
        }


@pytest.mark.parametrize("bits, least", [(1 << 27, 0), (1 << 15, 0), (1 << 27, -5)])
def test_all_but_the_referenced_pass(spark, bits, least):
    """exact for any indexes; records stay where they are if these fit the table."""
    records = spark.range(least, 90_000).select(F.col("id").alias("i"), F.lit("t").alias("text"))
    gone = random.Random(6).sample(range(least, 90_000), 700)
    references = spark.createDataFrame([(n,) for n in gone * 2], "i long")
    left = unreferenced(records, references, "i", least, 89_999, bits)
    assert sorted(row.i for row in left.collect()) == sorted(set(range(least, 90_000)) - set(gone))
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftAnti" in plan) == (bits < 90_000 or least < 0)
    assert unreferenced(records, references.limit(0), "i", least, 89_999, bits).count() == 90_000 - least


def test_removed_records_move_without_their_texts(spark):
    """a text that is part of its record is taken from it where the record is."""
    log = spark.createDataFrame(
        [(70_000, 5, 3, 0.95, "semantic_duplicate"), (9, 5, 3, 0.93, "semantic_duplicate")],
        "duplicate_index long, matched_index long, retained_index long, similarity double, reason string",
    )
    records = spark.range(80_000).select(
        F.col("id").alias("row_index"), F.concat(F.lit("text "), "id").alias("record")
    )

    def text_of(rows):
        return rows.withColumn("text", F.substring("record", 6, 9))

    for many in (100, 10**9):
        rows = removal_details(
            log, 2, records, 80_000, many_records=many, most=79_999, text_of=text_of
        ).collect()
        assert {(r.duplicate_text, r.matched_text, r.retained_text, r.record) for r in rows} == {
            ("70000", "5", "3", "text 70000"), ("9", "5", "3", "text 9")
        }
