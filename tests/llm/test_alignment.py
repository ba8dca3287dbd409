"""Alignment of two tokenizers against a loop over every pair of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import cache

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatloom.llm import op12_alignment, queries
from chatloom.llm.word_pieces import byte_letters

SF = "/root/testdata/sf0.001"


@cache
def models():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    return a, b


def ranges(sizes):
    end = 0
    for size in sizes:
        yield end, end + size
        end += size


def tokens(text):
    """(id, begin, end) of A and of B, or nothing."""
    a, b = models()
    if not text:
        return [], []
    letters = byte_letters()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    data_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    data_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        data_b.append(bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    whole = (" " + text).encode()
    if b"".join(data_a) != whole or b"".join(data_b) != whole:
        return [], []
    return (
        [(i, *r) for i, r in zip(ids_a, ranges(map(len, data_a)), strict=True)],
        [(i, *r) for i, r in zip(ids_b, ranges(map(len, data_b)), strict=True)],
    )


def expected(texts):
    """Rows for the texts, by trying all pairs of tokens near each other."""
    linked, parts = [], []
    for text in texts:
        a, b = tokens(text)
        links, low = [], 0
        for i, begin, end in a:
            while low < len(b) and b[low][2] <= begin:
                low += 1
            at = low
            while at < len(b) and b[at][1] < end:
                links.append((i, b[at][0]))
                at += 1
        both = sorted({end for *_, end in a} & {end for *_, end in b})
        groups, begin = [], 0
        for end in both:
            groups.append(
                "|".join(
                    ",".join(str(i) for i, first, last in side if begin <= first and last <= end)
                    for side in (a, b)
                )
                if len(a) < 400
                else None
            )
            begin = end
        linked.append(links)
        parts.append((len(a), len(b), len(both), groups))
    counts = Counter(pair for links in linked for pair in set(links))
    best = Counter()
    for (i, _), count in counts.items():
        best[i] = max(best[i], count)
    rows = []
    for links, (n_a, n_b, n_groups, groups) in zip(linked, parts, strict=True):
        digest = "" if not n_a else hashlib.sha256(";".join(groups).encode()).hexdigest() if None not in groups else None
        rows.append(
            (n_a, n_b, n_groups, len(links), sum(counts[p] == best[p[0]] for p in links),
             sum(counts[p] for p in links), digest)
        )
    return rows


def got(frame):
    return [tuple(row)[1:] for row in frame.collect()]


def same(found, wanted):
    """A digest of None stands for one that the loop leaves out."""
    assert len(found) == len(wanted)
    for mine, other in zip(found, wanted, strict=True):
        assert mine[:6] == other[:6]
        assert other[6] is None or mine[6] == other[6]


TEXTS = [
    "The quick brown fox", "The quick brown fox", "", None, " leading and  two  spaces ", "tab\tnew\nline\r\n",
    "<|endoftext|> <s> </s> <0x41>", "Ünï çödé 😀 中文字符 かな", "a" * 300, "▁ literal mark", "x\x00y",
    "é ﬁ ² ½", "lorem ipsum " * 1500, " ", "\n",
]


def frame(spark, texts):
    rows = [(n, text, "clash") for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, pairs string").coalesce(1)


@pytest.mark.parametrize("shared", [op12_alignment.SHARED_PAIRS, 0])
def test_links_of_special_texts(spark, shared):
    found = op12_alignment.link_counts(frame(spark, TEXTS), shared_pairs=shared).orderBy("doc_id")
    assert tuple(found.columns) == op12_alignment.COLUMNS
    same(got(found), expected(TEXTS))


def test_long_texts_are_parted(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [row.text for row in docs.orderBy("n_chars").select("text").collect()[-12:]]
    aligner = op12_alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    whole = op12_alignment.part_lanes
    found = []
    for size in (1 << 30, 1024, 7):
        monkeypatch.setattr(op12_alignment, "part_lanes", lambda *a, size=size: whole(*a, size))
        found.append(aligner.align(texts))
    for other in found[1:]:
        for name, values in found[0].items():
            assert list(values) == list(other[name])


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    found = queries.QUERIES["op12_token_alignment"](spark, SF)
    assert found.columns == list(op12_alignment.COLUMNS)
    assert all(kind == "bigint" for name, kind in found.dtypes if name != "groups_sha256")
    same(got(found.orderBy("doc_id")), expected([row.text for row in rows]))


def test_awkward_documents(awkward):
    found = op12_alignment.link_counts(awkward.repartition(3))
    rows = awkward.select("doc_id", "text").collect()
    wanted = expected([row.text for row in rows])
    key = lambda row: (str(row[0]), row[1:7])
    mine = sorted((tuple(row) for row in found.collect()), key=key)
    other = sorted(((row.doc_id, *numbers) for row, numbers in zip(rows, wanted, strict=True)), key=key)
    assert [row[0] for row in mine] == [row[0] for row in other]
    same([row[1:] for row in mine], [row[1:] for row in other])


def test_no_documents_and_no_tokens(spark, no_documents):
    assert op12_alignment.link_counts(no_documents).count() == 0
    empty = no_documents.sparkSession.createDataFrame([(1, None), (None, "")], "doc_id bigint, text string")
    found = op12_alignment.link_counts(empty)
    assert found.where(F.col("n_links") + F.col("n_best") + F.col("count_sum") > 0).count() == 0
    assert found.where("groups_sha256 = ''").count() == 2
