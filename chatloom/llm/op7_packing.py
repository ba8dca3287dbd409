"""Hierarchical multi-length packing of documents into training sequences.

A document's ids, with an end id, are routed to the smallest context tier that holds them; what
exceeds the longest tier is cut into full windows first. Tiers are packed from the longest down:
each window starts with one item of its tier, its gap is filled with the longest items of shorter
tiers that fit, and what then remains is filled by cutting one more item, whose rest goes back to
its tier. So every window but the last of a task is exactly full. The windows of a tier are then
dealt to step groups of about equal token counts and equal attention cost (sum of squared piece
lengths), in a snake order of cost.

Each task packs the rows it scans, some megabytes of ids at a time; what is left open is packed with
the next rows. No row is shuffled, memory does not grow with a partition, and a task that runs again
on the same rows makes the same pieces. Window numbers hold the task's number in the upper bits.

Edge cases: a null or empty text is its end id alone; rows that repeat are packed each; a long text
spans as many windows as it needs; empty tables give no pieces; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from chatloom.llm.common import hand_back_memory
from chatloom.llm.word_pieces import TOKENIZER_FILE, encoder

END_ID = 2
TIERS = (512, 1024, 2048, 4096)

# Ids that a task packs at a time; two bytes each.
BUFFER_TOKENS = 4_000_000
STEP_TOKENS = 131_072

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_group bigint"
)
_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


class _Shelf:
    """Items (document, start, length) by length, with the longest that fits found in one step."""

    def __init__(self) -> None:
        self._by_length: dict[int, list[tuple[int, int]]] = {}
        self._lengths = 0  # bit n: there is an item of length n

    def put(self, document: int, start: int, length: int) -> None:
        if length:
            self._by_length.setdefault(length, []).append((document, start))
            self._lengths |= 1 << length

    def _take(self, length: int) -> tuple[int, int, int]:
        stack = self._by_length[length]
        document, start = stack.pop()
        if not stack:
            del self._by_length[length]
            self._lengths &= ~(1 << length)
        return document, start, length

    def longest(self, most: int) -> tuple[int, int, int] | None:
        fitting = self._lengths & ((1 << (most + 1)) - 1)
        return self._take(fitting.bit_length() - 1) if fitting else None

    def shortest_above(self, least: int) -> tuple[int, int, int] | None:
        longer = self._lengths >> (least + 1)
        if not longer:
            return None
        return self._take((longer & -longer).bit_length() + least)


def pack(items: list[tuple[int, int]], tiers: tuple[int, ...] = TIERS, last: bool = True):
    """Windows from (document, tokens): full ones as (tier, pieces), and what is left over.

    Pieces are (document, start, length). With ``last`` everything is placed, in a final window
    that may have a gap; otherwise the pieces of that window are returned as items to pack later.
    """
    longest = tiers[-1]
    windows: list[tuple[int, list[tuple[int, int, int]]]] = []
    shelf = _Shelf()
    for document, start, tokens in ((i[0], 0, i[1]) if len(i) == 2 else i for i in items):
        whole = tokens // longest if tokens > longest else 0
        for place in range(whole):
            windows.append((longest, [(document, start + place * longest, longest)]))
        shelf.put(document, start + whole * longest, tokens - whole * longest)
    for tier in reversed(tiers):
        below = tiers[tiers.index(tier) - 1] if tier != tiers[0] else 0
        while True:
            first = shelf.longest(tier)
            if first is None or first[2] <= below:
                if first is not None:
                    shelf.put(*first)
                break
            pieces, gap = [first], tier - first[2]
            while gap:
                item = shelf.longest(gap)
                if item is None:
                    item = shelf.shortest_above(gap)
                    if item is None:
                        break
                    document, start, length = item
                    shelf.put(document, start + gap, length - gap)
                    item = (document, start, gap)
                pieces.append(item)
                gap -= item[2]
            if gap:  # nothing else is left
                return (windows + [(longest, pieces)], []) if last else (windows, pieces)
            windows.append((tier, pieces))
    return windows, []


def step_groups(windows: list, step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group number for each window: groups of one tier, of equal size and cost."""
    numbers = [0] * len(windows)
    groups = 0
    for tier in sorted({tier for tier, _ in windows}):
        places = [place for place, window in enumerate(windows) if window[0] == tier]
        cost = {p: sum(piece[2] ** 2 for piece in windows[p][1]) for p in places}
        places.sort(key=lambda p: (-cost[p], p))
        count = max(1, round(len(places) * tier / step_tokens))
        for rank, place in enumerate(places):
            lap, at = divmod(rank, count)
            numbers[place] = groups + (at if lap % 2 == 0 else count - 1 - at)
        groups += count
    return numbers


def _packed(
    batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, tiers: tuple[int, ...],
    buffer_tokens: int, step_tokens: int,
) -> Iterator[pa.RecordBatch]:
    encode = encoder(vocabulary).ids
    end = np.array([end_id], dtype="<u2")
    base = TaskContext.get().partitionId() << 32
    ids: dict[int, np.ndarray] = {}
    names: dict[int, int | None] = {}
    items: list = []
    held = documents = sequences = groups = 0

    def emit(last: bool) -> pa.RecordBatch:
        nonlocal items, ids, names, held, sequences, groups
        windows, rest = pack(items, tiers, last)
        columns: list[list] = [[] for _ in _NAMES]
        group_of = step_groups(windows, step_tokens)
        for (tier, pieces), group in zip(windows, group_of, strict=True):
            offset = 0
            for document, start, length in pieces:
                part = ids[document][start : start + length]
                row = (
                    names[document], start, length, zlib.crc32(part.astype("<u4").tobytes()),
                    len(ids[document]), base + sequences, offset, tier, base + groups + group,
                )
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                offset += length
            sequences += 1
        groups += max(group_of, default=-1) + 1
        kept = {document for document, _, _ in rest}
        ids = {document: ids[document] for document in kept}
        names = {document: names[document] for document in kept}
        items, held = list(rest), sum(length for _, _, length in rest)
        types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], _NAMES
        )

    for batch in batches:
        doc_ids = iter(batch.column(0).to_pylist())
        for all_ids, ends in encode(batch.column(1)):
            start = 0
            for stop in ends.tolist():
                array = np.append(all_ids[start:stop], end)
                ids[documents], names[documents] = array, next(doc_ids)
                items.append((documents, len(array)))
                documents += 1
                held += len(array)
                start = stop
            if held >= buffer_tokens:
                yield emit(last=False)
    if items:
        yield emit(last=True)
    hand_back_memory()


def pack_documents(
    docs: DataFrame, vocabulary: str = TOKENIZER_FILE, end_id: int = END_ID,
    tiers: tuple[int, ...] = TIERS, buffer_tokens: int = BUFFER_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece of a document (``doc_id``, ``text``): see the module."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(batches, vocabulary, end_id, tiers, buffer_tokens, step_tokens)

    narrow = docs.select(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))
    return narrow.mapInArrow(run, SCHEMA)
