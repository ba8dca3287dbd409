from __future__ import annotations

import hashlib

import pytest

from chatloom.operators import split
from chatloom.operators.split import eval_size, find_cutoff, sample_cap, seeded_order, train_eval_split


def ranked(ids, seed):
    return sorted(ids, key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())


def ids_frame(spark, rows):
    return spark.range(rows).withColumnRenamed("id", "source_index").repartition(5)


@pytest.mark.parametrize("few_rows", [1, 40, 4096])
@pytest.mark.parametrize("take", [1, 17, 499, 500])
def test_cutoff_takes_exactly_the_smallest_hashes(spark, monkeypatch, few_rows, take):
    monkeypatch.setattr(split, "FEW_ROWS", few_rows)
    monkeypatch.setattr(split, "DIGITS", 1)
    df = ids_frame(spark, 500)
    cutoff = find_cutoff(df, 500, take, 7, "source_index")
    taken = {r[0] for r in df.where(cutoff.takes(df.source_index)).collect()}
    assert taken == set(ranked(range(500), 7)[:take])


def test_split_is_exact_and_repeatable(spark):
    df = ids_frame(spark, 333)
    first = train_eval_split(df, 333, 0.1, 42).collect()
    again = train_eval_split(df.repartition(2), 333, 0.1, 42).collect()
    assert sorted(first) == sorted(again)
    chosen = {r.source_index for r in first if r.split == "eval"}
    assert len(chosen) == 33 and chosen == set(ranked(range(333), 42)[:33])
    other = {r.source_index for r in train_eval_split(df, 333, 0.1, 43).collect() if r.split == "eval"}
    assert chosen != other


def test_seeded_order(spark):
    rows = seeded_order(ids_frame(spark, 50), 3).collect()
    assert [r[0] for r in rows] == ranked(range(50), 3)


@pytest.mark.parametrize("cap, left", [(-1, 50), (0, 0), (7, 7), (50, 50), (60, 50)])
def test_cap(spark, cap, left):
    rows = sample_cap(ids_frame(spark, 50), 50, cap, 3).collect()
    assert {r[0] for r in rows} == set(ranked(range(50), 3)[:left])


@pytest.mark.parametrize("rows, ratio, size", [(3, 0.34, 1), (2, 0.1, 1), (25, 0.1, 2), (35, 0.1, 4)])
def test_sizes_round_half_to_even(rows, ratio, size):
    assert eval_size(rows, ratio) == size


@pytest.mark.parametrize("rows, ratio", [(1, 0.5), (0, 0.5), (2, 0.9), (10, 0.0), (10, 1.0)])
def test_guards(rows, ratio):
    with pytest.raises(ValueError):
        eval_size(rows, ratio)
