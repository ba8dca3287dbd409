"""Packing by the configuration linear program: the plan against bounds, pieces against the tokenizer."""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chatloom.llm import op11_best_fit, queries
from chatloom.llm.byte_pieces import LONG_RUN, encoder

SF = "/root/testdata/sf0.001"


@cache
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t.,'sß<|")), max_size=60))
def test_ids_equal_the_tokenizers(text):
    assert encoder().ids(text).tolist() == encoder()._tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_special_texts():
    for text in ["<|endoftext|> a", " " * (3 * LONG_RUN) + "x", "\n \t" * LONG_RUN, "a" * 50_000, ""]:
        assert encoder().ids(text).tolist() == plain(text)


def used(packed, capacity):
    found = np.zeros(capacity + 1, dtype=np.int64)
    for chosen, times in packed:
        assert times > 0 and sum(n * copies for n, copies in chosen.items()) <= capacity
        for length, copies in chosen.items():
            found[length] += copies * times
    return found


def fewest(lengths, capacity):
    """The least number of sequences, by trying every way."""
    best = len(lengths)

    def place(rest, open_rooms):
        nonlocal best
        if len(open_rooms) >= best:
            return
        if not rest:
            best = len(open_rooms)
            return
        head, *tail = rest
        for at in range(len(open_rooms)):
            if open_rooms[at] >= head:
                place(tail, [*open_rooms[:at], open_rooms[at] - head, *open_rooms[at + 1 :]])
        place(tail, [*open_rooms, capacity - head])

    place(sorted(lengths, reverse=True), [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_small_plans_are_close_to_the_best(lengths):
    demand = np.bincount(lengths, minlength=21).astype(np.int64)
    packed = op11_best_fit.pack_histogram(demand)
    assert (used(packed, 20) == demand).all()
    assert sum(times for _, times in packed) <= fewest(lengths, 20) + 1


@pytest.mark.parametrize("shape", ["uniform", "short", "long", "one"])
def test_plans_of_many_pieces_come_near_the_bound(shape):
    generator = np.random.default_rng(4)
    sizes = {
        "uniform": generator.integers(1, 300, 4000),
        "short": generator.integers(1, 40, 6000),
        "long": generator.integers(151, 300, 1000),
        "one": np.full(1000, 70),
    }[shape]
    demand = np.bincount(sizes, minlength=301).astype(np.int64)
    packed = op11_best_fit.pack_histogram(demand)
    assert (used(packed, 300) == demand).all()
    bound = max(sizes.sum() / 300, (sizes > 150).sum(), len(sizes) / 4 if shape == "one" else 0)
    assert sum(times for _, times in packed) <= 1.01 * bound + 2


def test_the_cover_is_a_cover():
    demand = np.bincount([3, 3, 5, 7, 7, 7, 9, 11, 11], minlength=21).astype(float)
    covered = np.zeros(21)
    for chosen, uses in op11_best_fit.solve(demand):
        for length, copies in chosen.items():
            covered[length] += copies * uses
    assert np.allclose(covered, demand)


def check_pieces(rows, texts, capacity):
    """Every id once, pieces where the contract cuts, sequences gapless and not too long."""
    by_text = defaultdict(list)
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
        by_text[row.doc_id].append(row)
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    for doc_id, mine in texts.items():
        expected = []
        for text in mine:
            ids = np.array([*plain(text), 0], dtype="<u4")
            cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
            for piece, (start, stop) in enumerate(itertools.pairwise(cuts)):
                expected.append((piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
        got = [(r.piece, r.start, r.length, r.ids_crc32) for r in by_text.pop(doc_id)]
        assert sorted(got) == sorted(expected)
    assert not by_text
    return len(sequences), sum(length for places in sequences.values() for _, length in places)


def test_pieces_of_awkward_documents(awkward):
    texts = defaultdict(list)
    for row in awkward.select("doc_id", "text").collect():
        texts[row.doc_id].append(row.text)
    for capacity in (2048, 16):
        rows = op11_best_fit.pack_documents(awkward.repartition(3), capacity=capacity).collect()
        check_pieces(rows, texts, capacity)


def test_query_packs_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {row.doc_id: [row.text] for row in docs.collect()}
    result = queries.QUERIES["op11_best_fit_packing"](spark, SF)
    assert dict(result.dtypes) == {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint",
        "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint",
    }
    sequences, ids = check_pieces(result.collect(), texts, 2048)
    assert sequences <= 1.02 * ids / 2048 + 2


def test_no_documents(no_documents):
    assert op11_best_fit.pack_documents(no_documents).count() == 0
