"""Packing of documents into few sequences by the configuration linear program of their lengths.

A document's ids, with an end id, are one piece; a longer document is cut into full pieces behind a
first piece that may be shorter. What has to be packed is then a histogram: how many pieces there are
of each length, at most as many numbers as a sequence has tokens, whatever the size of the corpus.

* A configuration says how many pieces of each length fill one sequence. The linear program asks for
  the least number of sequences, over all configurations, that covers the histogram. It is solved by
  multiplicative weights: every length has a price, at first its share of a sequence; a knapsack
  program over the places of a sequence finds the configurations worth most; each is used for a part
  of its lengths' demand, and covered lengths become cheaper in proportion.
* The solution is rounded down; what remains, some pieces for each configuration, is packed by the
  same knapsack program in whole sequences, longest pieces first, the last ones one by one.
* Pieces meet the plan without being moved: a task numbers its pieces of each length as it encodes
  them, sums over tasks make that a number among all pieces of the length, and the plan, a small
  table, tells from it the sequence and the place in it.

Texts go through one scan; only narrow rows of pieces are shuffled. A task that runs again numbers
its pieces the same way.

Edge cases: a null or empty text is its end id alone; repeated rows and ids are packed each; a long
text makes as many full pieces as it needs; empty tables give no pieces; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.byte_pieces import TOKENIZER_FILE, encoder
from chatloom.llm.common import materialize

END_ID = 0
CAPACITY = 2048

# Part of a length's demand that one use of a configuration covers at most, configurations taken
# from one pricing, and how much a covered length's price falls.
STEP = 0.125
PER_PRICING = 24
DISCOUNT = 0.02
LONG_BONUS = 1e-5
# Sequences that are left for packing one by one.
TAIL = 48

PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, task int, place bigint"
_PIECE_NAMES = [field.split()[0] for field in PIECES.split(", ")]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]

_FLUSH_ROWS = 50_000

Configuration = dict[int, int]


class Knapsack:
    """The most valuable filling of every number of places, lengths used any number of times."""

    def __init__(self, prices: np.ndarray) -> None:
        """``prices`` of the lengths 0, 1, …; minus infinity where there are none."""
        capacity = len(prices) - 1
        self.best = best = np.zeros(capacity + 1)
        self._choice = choice = np.zeros(capacity + 1, dtype=np.int64)
        for places in range(1, capacity + 1):
            values = best[places - 1 :: -1] + prices[1 : places + 1]
            length = int(values.argmax())
            if values[length] > best[places - 1]:
                best[places], choice[places] = values[length], length + 1
            else:
                best[places] = best[places - 1]

    def filling(self, places: int) -> Configuration:
        found: Configuration = {}
        while places:
            length = int(self._choice[places])
            if length:
                found[length] = found.get(length, 0) + 1
                places -= length
            else:
                places -= 1
        return found


def first_prices(capacity: int) -> np.ndarray:
    """A length's share of a sequence, and a little more for long ones: of equally full sequences
    the one of fewer pieces is worth most, which keeps short pieces for the gaps of later ones."""
    shares = np.arange(capacity + 1) / capacity
    prices = shares * (1 + LONG_BONUS * shares)
    prices[0] = -np.inf
    return prices


def _with(length: int, knapsack: Knapsack, capacity: int) -> Configuration:
    found = knapsack.filling(capacity - length)
    found[length] = found.get(length, 0) + 1
    return found


def solve(demand: np.ndarray, step: float = STEP) -> list[tuple[Configuration, float]]:
    """Configurations and how often each is used, in fractions: a cover of the demand.

    ``demand[n]`` is the number of pieces of length n; the last index is the capacity.
    """
    capacity = len(demand) - 1
    open_share = (demand > 0).astype(float)
    uses: dict[tuple, float] = {}
    while open_share.any():
        discount = np.exp(DISCOUNT * (open_share - 1))
        knapsack = Knapsack(np.where(open_share > 0, first_prices(capacity) * discount, -np.inf))
        # Long pieces leave little choice, so they go first.
        for length in np.flatnonzero(open_share)[::-1][:PER_PRICING].tolist():
            if open_share[length] <= 0:
                continue
            chosen = _with(length, knapsack, capacity)
            if any(open_share[other] <= 0 for other in chosen):
                continue  # covered since the pricing; the next one leaves it out
            share = min(
                min(step, open_share[other]) * demand[other] / copies
                for other, copies in chosen.items()
            )
            key = tuple(sorted(chosen.items()))
            uses[key] = uses.get(key, 0.0) + share
            for other, copies in chosen.items():
                left = open_share[other] - share * copies / demand[other]
                open_share[other] = left if left > 1e-9 else 0.0
    return [(dict(key), use) for key, use in uses.items()]


def _fill_one(left: np.ndarray, first: int) -> Configuration:
    """The fullest sequence with a piece of length ``first``, from the pieces that are left."""
    capacity = len(left) - 1
    room = capacity - first
    items = []
    for length in np.flatnonzero(left[: room + 1]).tolist():
        copies = min(int(left[length]) - (length == first), room // length)
        part = 1
        while copies > 0:
            items.append((length, min(part, copies)))
            copies -= part
            part *= 2
    reached = np.zeros((len(items) + 1, room + 1), dtype=bool)
    reached[0, 0] = True
    for place, (length, copies) in enumerate(items):
        size = length * copies
        reached[place + 1] = reached[place]
        if size <= room:
            reached[place + 1, size:] |= reached[place, : room + 1 - size]
    total = int(np.flatnonzero(reached[-1])[-1])
    found = {first: 1}
    for place in range(len(items), 0, -1):
        if not reached[place - 1, total]:
            length, copies = items[place - 1]
            found[length] = found.get(length, 0) + copies
            total -= length * copies
    return found


def round_down(
    demand: np.ndarray, solution: list[tuple[Configuration, float]]
) -> list[tuple[Configuration, int]]:
    """Whole sequences with exactly the pieces of the demand."""
    capacity = len(demand) - 1
    lengths = np.arange(capacity + 1)
    left = demand.astype(np.int64).copy()
    packed: list[tuple[Configuration, int]] = []

    def use(chosen: Configuration, times: int) -> None:
        packed.append((chosen, times))
        for length, copies in chosen.items():
            left[length] -= copies * times

    for chosen, uses in solution:
        if (times := int(uses + 1e-6)) > 0:
            times = min(times, *(int(left[length]) // copies for length, copies in chosen.items()))
            if times > 0:
                use(chosen, times)
    while (lengths * left).sum() > TAIL * capacity:
        knapsack = Knapsack(np.where(left > 0, first_prices(capacity), -np.inf))
        for length in np.flatnonzero(left)[::-1][:PER_PRICING].tolist():
            if not left[length]:
                continue
            chosen = {length: 1}
            room = capacity - length
            for other, copies in sorted(knapsack.filling(room).items(), reverse=True):
                fitting = min(copies, int(left[other]) - chosen.get(other, 0))
                if fitting > 0:
                    chosen[other] = chosen.get(other, 0) + fitting
                    room -= other * fitting
            # Where the filling asks for more pieces than there are, the longest that fit take their place.
            while room:
                fitting_lengths = np.flatnonzero(left[: room + 1])[::-1]
                other = next((n for n in fitting_lengths.tolist() if left[n] > chosen.get(n, 0)), 0)
                if not other:
                    break
                chosen[other] = chosen.get(other, 0) + 1
                room -= other
            use(chosen, min(int(left[n]) // copies for n, copies in chosen.items()))
    while left.any():
        use(_fill_one(left, int(np.flatnonzero(left)[-1])), 1)
    return packed


def pack_histogram(demand: np.ndarray) -> list[tuple[Configuration, int]]:
    """Configurations and how many sequences have each; full pieces are sequences of their own."""
    capacity = len(demand) - 1
    shorter = demand.copy()
    shorter[[0, capacity]] = 0
    packed = round_down(shorter, solve(shorter))
    if demand[capacity]:
        packed.append(({capacity: 1}, int(demand[capacity])))
    return packed


def places_table(packed: list[tuple[Configuration, int]]) -> np.ndarray:
    """Rows (length, first number, pieces in a sequence, first sequence, offset): the pieces of a
    length from that number on fill the sequences of one configuration. Sorted."""
    rows = []
    used: dict[int, int] = {}
    sequences = 0
    for chosen, times in packed:
        offset = 0
        for length, copies in sorted(chosen.items(), reverse=True):
            first = used.get(length, 0)
            rows.append((length, first, copies, sequences, offset))
            used[length] = first + copies * times
            offset += copies * length
        sequences += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def cut_documents(
    docs: DataFrame, vocabulary: str = TOKENIZER_FILE, end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece; ``place`` numbers the pieces of one length that one task makes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        rows: list[tuple] = []

        def written() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, _PIECE_TYPES, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, _PIECE_NAMES)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id))
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                first = (len(ids) - 1) % capacity + 1
                stops = range(first, len(ids) + 1, capacity)
                start = 0
                for piece, stop in enumerate(stops):
                    length = stop - start
                    crc = zlib.crc32(data[4 * start : 4 * stop])
                    rows.append((doc_id, piece, start, length, crc, task, seen[length]))
                    seen[length] += 1
                    start = stop
                if len(rows) >= _FLUSH_ROWS:
                    yield written()
                    rows.clear()
        if rows:
            yield written()

    narrow = docs.select(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))
    return narrow.mapInArrow(run, PIECES)


def pack_documents(
    docs: DataFrame, vocabulary: str = TOKENIZER_FILE, end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece of a document (``doc_id``, ``text``), with its sequence and place there."""
    spark = docs.sparkSession
    pieces = materialize(cut_documents(docs, vocabulary, end_id, capacity), "pieces")
    counts = materialize(
        pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("pieces")), "piece-counts"
    )
    # At most one row for each length.
    demand = np.zeros(capacity + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect():
        demand[row.length] = row.pieces
    shared = spark.sparkContext.broadcast(places_table(pack_histogram(demand)))

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def placed(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        table = shared.value
        # A piece's row is the last one of its length that begins at or before its number.
        keys = (table[:, 0] << 48) + table[:, 1]
        length = lengths.to_numpy(zero_copy_only=False).astype(np.int64)
        number = numbers.to_numpy(zero_copy_only=False)
        row = table[np.searchsorted(keys, (length << 48) + number, "right") - 1]
        sequence, place = np.divmod(number - row[:, 1], row[:, 2])
        offset = row[:, 4] + place * length
        return pa.StructArray.from_arrays(
            [pa.array(row[:, 3] + sequence), pa.array(offset)], ["sequence_id", "offset"]
        )

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = counts.select(
        "task", "length", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before")
    )
    return (
        pieces.join(before, ["task", "length"])
        .withColumn("at", placed("length", F.col("before") + F.col("place")))
        .select(
            "doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"),
            "ids_crc32", "at.sequence_id", "at.offset",
        )
    )
