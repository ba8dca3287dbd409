"""Alignment of two tokenizers over the same texts, by merging their tokens in lockstep.

Tokenizer A reads a space and the text, tokenizer B the text, before which it writes a space itself;
so both cut the same bytes. Two tokens are linked where their byte ranges overlap; where a token of
each ends at the same byte, the text is cut into groups. A pair of ids counts once for each document
that has it linked.

* A task reads some megabytes of texts at a time. Every document is a lane of one state: a pointer to
  its token of A, one to its token of B, and the place of its next link. A step writes a link for all
  lanes at once, marks a cut where both tokens end together, and moves on the pointer whose token
  ends first, or both. Lanes that are through leave the state. A long document enters as several
  lanes, parted at bytes where both tokenizers end a token, so few steps serve long texts, too.
* What is kept of a document is its digest and its different id pairs with their numbers of links,
  written once. Pairs are counted over all documents by an aggregation with partial counts.
* The counts go back to the documents: a table of at most ``SHARED_PAIRS`` pairs (twelve bytes each)
  is sent to the tasks; a larger one is joined by pair, in which case documents' pairs are shuffled.

Edge cases: null and empty texts, and texts whose tokens do not give back their bytes, have zeros and
an empty digest; null and repeated ids are kept, row by row; empty tables give no rows; extra columns
are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.byte_pieces import encoder
from chatloom.llm.common import materialize

BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"

# Tokens of A in one lane, at least, before a document is parted.
LANE_TOKENS = 1024
# Bytes of text that are aligned at a time.
CALL_BYTES = 3 << 20
# Pairs in a table that is sent to all tasks: 48 MB.
SHARED_PAIRS = 4_000_000

ALIGNED = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<bigint>, times array<int>"
)
_ALIGNED_NAMES = [field.split()[0] for field in ALIGNED.split(", ")]
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

_PIECES: dict[str, PieceTokenizer] = {}


class PieceTokenizer:
    """Tokenizer B: ids of texts and the bytes of each id."""

    def __init__(self, path: str) -> None:
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()
        self.token_bytes = [self._bytes(place) for place in range(self.size)]

    def _bytes(self, place: int) -> bytes:
        piece = self._model.id_to_piece(place)
        if self._model.is_byte(place):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def _path(name: str) -> str:
    return name if os.path.isabs(name) else public_tokenizers.path(name)


def pieces(name: str) -> PieceTokenizer:
    path = _path(name)
    if path not in _PIECES:
        _PIECES[path] = PieceTokenizer(path)
    return _PIECES[path]


class Aligner:
    """Two tokenizers, their tokens' lengths in bytes, and ids written as digits."""

    def __init__(self, byte_file: str, piece_file: str) -> None:
        self.a, self.b = encoder(byte_file, special=False), pieces(piece_file)
        self._a_bytes = [self.a.token_bytes.get(place, b"") for place in range(self.a.size)]
        self._a_sizes = np.array([len(data) for data in self._a_bytes])
        self._b_sizes = np.array([len(data) for data in self.b.token_bytes])
        digits = [str(place).encode() for place in range(max(self.a.size, self.b.size))]
        # An id behind each sign that may stand before it, by (sign, id).
        self._written = np.array(
            [sign + number for sign in (b",", b";", b"|", b"") for number in digits], dtype=object
        )
        self._ids = len(digits)

    def tokens(self, text: str, b_ids: list[int]) -> np.ndarray | None:
        """The ids of A, if both tokenizers give back the bytes of the text."""
        if not text:
            return None
        data = b" " + text.encode()
        if b"".join(map(self.b.token_bytes.__getitem__, b_ids)) != data:
            return None
        ids = self.a.ids(" " + text)
        return ids if b"".join(map(self._a_bytes.__getitem__, ids.tolist())) == data else None

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list[str]]:
        """Numbers and digest of each text; ``pairs`` and ``times`` of all, in order, and where each
        text's begin and end in them (``offsets``)."""
        all_b = self.b.ids(texts)
        found = [self.tokens(text, ids) for text, ids in zip(texts, all_b, strict=True)]
        kept = np.array([place for place, ids in enumerate(found) if ids is not None], dtype=int)
        result: dict = {name: np.zeros(len(texts), dtype=np.int64) for name in _COUNTS}
        result |= {"groups_sha256": [""] * len(texts), "pairs": np.empty(0, dtype=np.int64)}
        result |= {"times": np.empty(0, dtype=np.int32), "offsets": np.zeros(len(texts) + 1, int)}
        if not len(kept):
            return result
        ids_a = np.concatenate([found[place] for place in kept]).astype(np.int64)
        ids_b = np.concatenate([np.array(all_b[place], dtype=np.int64) for place in kept])
        result["n_a"][kept] = [len(found[place]) for place in kept]
        result["n_b"][kept] = [len(all_b[place]) for place in kept]
        stops_a, stops_b = np.cumsum(result["n_a"][kept]), np.cumsum(result["n_b"][kept])
        # Both sides have the same bytes in every text, so ends in the joined texts compare.
        ends_a, ends_b = np.cumsum(self._a_sizes[ids_a]), np.cumsum(self._b_sizes[ids_b])
        lanes = part_lanes(ends_a, ends_b, stops_a, stops_b)
        links, cuts_a, cuts_b = merge(ids_a * self.b.size, ids_b, ends_a, ends_b, lanes)

        rooms = lanes.stop_a - lanes.first_a + lanes.stop_b - lanes.first_b
        text_of = np.repeat(lanes.text, rooms)[links >= 0]
        links = links[links >= 0]
        result["n_links"][kept] = np.bincount(text_of, minlength=len(kept))
        span = self.a.size * self.b.size
        keys = text_of * span + links
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        owner = keys[first] // span
        result["pairs"] = keys[first] - owner * span
        result["times"] = np.diff(np.append(first, len(keys))).astype(np.int32)
        different = np.zeros(len(texts), dtype=np.int64)
        different[kept] = np.bincount(owner, minlength=len(kept))
        result["offsets"] = np.concatenate([[0], np.cumsum(different)])

        text_of_a = np.repeat(np.arange(len(kept)), result["n_a"][kept])
        result["n_groups"][kept] = np.bincount(text_of_a[cuts_a], minlength=len(kept))
        written = self._groups(ids_a, ids_b, cuts_a, cuts_b, stops_a)
        starts = np.concatenate([[0], (stops_a + stops_b)[:-1]])
        for place, start, stop in zip(kept.tolist(), starts, stops_a + stops_b, strict=True):
            digest = hashlib.sha256(b"".join(written[start:stop].tolist()))
            result["groups_sha256"][place] = digest.hexdigest()
        return result

    def _groups(
        self, ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray,
        stops_a: np.ndarray,
    ) -> np.ndarray:
        """All tokens in the order of the digest, the ids of A before those of B in each group, each
        with the sign before it."""
        group_a, group_b = np.cumsum(cuts_a) - cuts_a, np.cumsum(cuts_b) - cuts_b
        groups = int(cuts_a.sum())
        before_b = np.cumsum(np.bincount(group_b, minlength=groups))
        through_a = np.cumsum(np.bincount(group_a, minlength=groups))
        signs_a = np.where(np.append(True, cuts_a[:-1]), 1, 0)
        signs_a[np.append(0, stops_a[:-1])] = 3  # nothing stands before a text's first group
        signs_b = np.where(np.append(True, cuts_b[:-1]), 2, 0)
        places_a = np.arange(len(ids_a)) + np.append(0, before_b[:-1])[group_a]
        places_b = np.arange(len(ids_b)) + through_a[group_b]
        order = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        order[places_a] = signs_a * self._ids + ids_a
        order[places_b] = signs_b * self._ids + ids_b
        return self._written[order]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Lanes(NamedTuple):
    """Stretches of texts that begin and end where both tokenizers do, by number of token."""

    text: np.ndarray
    first_a: np.ndarray
    stop_a: np.ndarray
    first_b: np.ndarray
    stop_b: np.ndarray


def part_lanes(
    ends_a: np.ndarray, ends_b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray,
    lane_tokens: int = LANE_TOKENS,
) -> Lanes:
    """A lane for each text, and several for long ones."""
    rows = []
    start_a = start_b = 0
    for text, (stop_a, stop_b) in enumerate(zip(stops_a.tolist(), stops_b.tolist(), strict=True)):
        if stop_a - start_a > 2 * lane_tokens:
            _, in_a, in_b = np.intersect1d(
                ends_a[start_a:stop_a], ends_b[start_b:stop_b], assume_unique=True,
                return_indices=True,
            )
            wanted = np.arange(lane_tokens, stop_a - start_a - lane_tokens, lane_tokens)
            chosen = np.unique(np.searchsorted(in_a, wanted))
            chosen = chosen[chosen < len(in_a) - 1]  # the last common end is the text's
            cuts = zip((start_a + 1 + in_a[chosen]).tolist(), (start_b + 1 + in_b[chosen]).tolist(), strict=True)
            for cut_a, cut_b in cuts:
                rows.append((text, start_a, cut_a, start_b, cut_b))
                start_a, start_b = cut_a, cut_b
        rows.append((text, start_a, stop_a, start_b, stop_b))
        start_a, start_b = stop_a, stop_b
    return Lanes(*np.array(rows, dtype=np.int64).T)


def merge(
    codes_a: np.ndarray, codes_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, lanes: Lanes
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of all lanes in lockstep, and whether a group ends with each token of A and of B.

    A lane's links, sums of the two tokens' codes, lie in a stretch with room for one fewer than it
    has tokens on both sides; places that are not needed hold -1.
    """
    rooms = lanes.stop_a - lanes.first_a + lanes.stop_b - lanes.first_b
    links = np.full(int(rooms.sum()), -1, dtype=np.int64)
    cuts_a, cuts_b = np.zeros(len(ends_a), dtype=bool), np.zeros(len(ends_b), dtype=bool)
    at_a, at_b, stop_a = lanes.first_a.copy(), lanes.first_b.copy(), lanes.stop_a
    at_link = np.cumsum(rooms) - rooms
    while len(at_a):
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        links[at_link] = codes_a[at_a] + codes_b[at_b]
        on_a, on_b = end_a <= end_b, end_b <= end_a
        cut = on_a & on_b
        cuts_a[at_a[cut]] = True
        cuts_b[at_b[cut]] = True
        at_a += on_a
        at_b += on_b
        at_link += 1
        going = at_a < stop_a
        if not going.all():
            at_a, at_b, at_link, stop_a = at_a[going], at_b[going], at_link[going], stop_a[going]
    return links, cuts_a, cuts_b


def align_documents(
    docs: DataFrame, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE,
    call_bytes: int = CALL_BYTES,
) -> DataFrame:
    """One row per document: see ``ALIGNED``. ``pairs`` are A's id times B's size plus B's id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_file, piece_file)
        task = TaskContext.get().partitionId()
        row = task << 33
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < len(texts):
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + call_bytes, "right")))
                found = aligner.align(texts.slice(start, stop - start).to_pylist())
                offsets = pa.array(found["offsets"], pa.int32())
                columns = [
                    pa.array(np.arange(row, row + stop - start)),
                    batch.column(0).slice(start, stop - start),
                    *(pa.array(found[name]) for name in _COUNTS),
                    pa.array(found["groups_sha256"], pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(found["pairs"])),
                    pa.ListArray.from_arrays(offsets, pa.array(found["times"])),
                ]
                yield pa.RecordBatch.from_arrays(columns, _ALIGNED_NAMES)
                row += stop - start
                start = stop

    narrow = docs.select(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))
    return narrow.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair``, in how many documents it is linked, and whether no pair of its A id is in more."""
    counts = materialize(
        aligned.select(F.explode("pairs").alias("pair"))
        .groupBy("pair")
        .agg(F.count(F.lit(1)).alias("documents")),
        "pair-counts",
    )
    id_a = F.floor(F.col("pair") / size_b).alias("a")
    most = counts.groupBy(id_a).agg(F.max("documents").alias("most"))
    return (
        counts.withColumn("a", id_a)
        .join(most, "a")
        .select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))
    )


def link_counts(docs: DataFrame, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE,
                shared_pairs: int = SHARED_PAIRS) -> DataFrame:
    """``COLUMNS`` of every document."""
    aligned = materialize(align_documents(docs, byte_file, piece_file), "aligned")
    counts = materialize(pair_counts(aligned, pieces(piece_file).size), "pair-statistics")
    if counts.count() <= shared_pairs:
        return _with_shared(aligned, counts)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    sums = (
        links.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("documents")).alias("count_sum"),
        )
    )
    return (
        aligned.drop("pairs", "times").join(sums, "row", "left").na.fill(0, ["n_best", "count_sum"])
    ).select(*COLUMNS)


def _with_shared(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    found = counts.orderBy("pair").toArrow()
    table = tuple(found.column(place).to_numpy() for place in range(3))
    shared = aligned.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint>")
    def summed(pairs: pa.Array, times: pa.Array) -> pa.Array:
        keys, documents, best = shared.value
        lengths = pc.list_value_length(pairs).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        times = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        places = np.searchsorted(keys, pairs.flatten().to_numpy(zero_copy_only=False))
        sums = []
        for values in (times * best[places], times * documents[places]):
            running = np.concatenate([[0], np.cumsum(values)])
            sums.append(pa.array(running[ends] - running[ends - lengths]))
        return pa.StructArray.from_arrays(sums, ["n_best", "count_sum"])

    return aligned.withColumn("sums", summed("pairs", "times")).select(
        *COLUMNS[:5], "sums.n_best", "sums.count_sum", "groups_sha256"
    )
