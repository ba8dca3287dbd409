"""Phrases whose words stand together more often than chance, by merging sorted streams of counts.

Texts are cut into pieces at punctuation and line ends and into words at blanks. A phrase of 2 to 5
words that occurs often enough is a candidate; each of its cuts compares its count a with those of
the two parts, 1000·a·n / (l·r), and the lowest value is its score. A candidate that occurs nowhere
but inside a longer one is dropped.

* Counting: only phrases whose neighbouring words are all frequent pairs, and frequent triples, can be
  frequent. A first scan counts words exactly and pairs in ``CELLS`` cells, to which pairs are dealt by
  a hash; a cell that reaches the least count may hold frequent pairs, the others cannot. A second scan
  does the same for triples that run through such pairs. Which cells may is a table of 16 MB for each,
  whatever the size of the corpus: it saves work and never decides a count. A third scan counts the
  phrases that run through such pairs and triples, combined in a task for each core, and Spark adds
  them up.
* Streams: counts are kept in two orders, by a phrase's words from the first on and from the last on,
  in ranges of the first (last) two words. In prefix order, a phrase's beginnings are the rows that
  stand open above it: one pass gives the count of every left part and whether one more word behind
  the phrase leaves its count as it is. The pass in suffix order does the same for right parts and
  words before it, and scores. A pass holds one phrase's parts at a time and looks nothing up.

Everything is per language; a null language counts as ``und``. Edge cases: null and empty texts have
no words; repeated rows count each; long texts are read whole; empty tables give no rows; extra
columns are not read; scores are exact however large the products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import hand_back_memory, materialize
from chatloom.operators.skew import hot_keys, lookup

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
NO_LANGUAGE = "und"

CELL_BITS = 27
CELLS = 1 << CELL_BITS
BLOCK_BITS = 17
# A task's count of one cell is written in 15 bits.
MOST_PARTIAL = (1 << 15) - 1

# Bytes of text that are split at a time, and counts of cells that a task holds.
CALL_BYTES = 4 << 20
HELD_CELLS = 1_500_000
# Rows of counts that a task adds up before it sends them on.
HELD_ROWS = 400_000
# Different phrases that a task keeps to add up; beyond, it sends them on and begins anew.
HELD_PHRASES = 1_000_000

_WORD, _BLANK, _BREAK = range(3)
_KINDS = np.full(256, _WORD, dtype=np.uint8)
_KINDS[[0x20, 0x09]] = _BLANK
_KINDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK

FIRST_COUNTS = "lang string, word string, f bigint, block int, cells binary"
CELL_COUNTS = "block int, cells binary"
PHRASES = "lang string, phrase string, f bigint"
LEFT = "lang string, words array<string>, a bigint, last_f bigint, inside boolean, parts array<bigint>"
SCORED = "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


class Words:
    """The words of some texts as numbers of a dictionary, in order, with piece and language."""

    def __init__(self, texts: pa.Array, languages: pa.Array) -> None:
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        blob = texts.buffers()[2]
        data = np.frombuffer(blob, dtype=np.uint8)[offsets[0] : offsets[-1]] if blob else np.empty(0, np.uint8)
        starts_of_texts = offsets[:-1] - offsets[0]
        data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        kinds = _KINDS[data]
        in_word = kinds == _WORD
        opens = np.zeros(len(data) + 1, dtype=bool)
        opens[starts_of_texts] = True
        begins = in_word & (opens[:-1] | ~np.append(False, in_word[:-1]))
        stops = in_word & (opens[1:] | ~np.append(in_word[1:], False))
        first = np.flatnonzero(begins)
        lengths = np.flatnonzero(stops) + 1 - first
        places = np.zeros(len(first) + 1, dtype=np.int32)
        np.cumsum(lengths, out=places[1:])
        words = pa.StringArray.from_buffers(
            len(first), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[in_word]))
        ).dictionary_encode()
        self.dictionary = words.dictionary
        self.codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.pieces = np.cumsum((kinds == _BREAK) | opens[:-1], dtype=np.int32)[first]
        encoded = languages.dictionary_encode()
        self.languages = encoded.dictionary
        text_of = np.searchsorted(starts_of_texts, first, "right") - 1
        self.lang = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text_of]

    def together(self) -> np.ndarray:
        """Whether each word but the last has the next one in its piece."""
        return self.pieces[1:] == self.pieces[:-1]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word and of each language of the dictionaries."""
        return tuple(
            np.fromiter(
                map(xxhash.xxh64_intdigest, values.cast(pa.binary()).to_pylist()), np.uint64, len(values)
            )
            for values in (self.dictionary, self.languages)
        )

    def cells(self, at: np.ndarray, length: int) -> np.ndarray:
        """The cells of the phrases of ``length`` words that begin at some places."""
        words, languages = self.hashes()
        mixed = languages[self.lang[at]]
        for place in range(length):
            mixed = (mixed ^ words[self.codes[at + place]]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - CELL_BITS)


def _calls(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        languages = pc.fill_null(batch.column(0), NO_LANGUAGE)
        texts = pc.fill_null(batch.column(1), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + CALL_BYTES, "right")))
            words = Words(texts.slice(start, stop - start), languages.slice(start, stop - start))
            if len(words.codes):
                yield words
            start = stop


class _Cells:
    """Counts of cells that a task has seen, sent on in blocks."""

    def __init__(self) -> None:
        self._held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, cells: np.ndarray) -> bool:
        """Count some cells; whether it is time to send the counts on."""
        if len(cells):
            self._held.append(np.unique(cells, return_counts=True))
        return sum(len(one) for one, _ in self._held) > HELD_CELLS

    def blocks(self) -> tuple[pa.Array, pa.Array]:
        """Numbers of blocks, and their cells with counts; nothing is held afterwards."""
        if not self._held:
            return pa.array([], pa.int32()), pa.array([], pa.binary())
        cells, counts = (np.concatenate(side) for side in zip(*self._held, strict=True))
        self._held.clear()
        order = np.argsort(cells)
        cells = cells[order]
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        cells, counts = cells[first], np.add.reduceat(counts[order], first)
        numbers = (cells >> np.uint64(BLOCK_BITS)).astype(np.int32)
        entries = (cells & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint32) << np.uint32(15)
        entries |= np.minimum(counts, MOST_PARTIAL).astype(np.uint32)
        first = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
        parts = [part.astype("<u4").tobytes() for part in np.split(entries, first[1:])]
        return pa.array(numbers[first]), pa.array(parts, pa.binary())


class _Counts:
    """Rows of (language, words, count) that a task has seen, added up before they are sent on."""

    def __init__(self, name: str, most: int | None = None) -> None:
        self._names = ["lang", name, "f"]
        self._held: list[pa.RecordBatch] = []
        self._rows = 0
        self._most = HELD_ROWS // 2 if most is None else most
        self._full = HELD_ROWS

    def add(self, lang: pa.Array, words: pa.Array, counts: np.ndarray) -> pa.Table | None:
        columns = [lang, words, pa.array(counts.astype(np.int64))]
        self._held.append(pa.RecordBatch.from_arrays(columns, self._names))
        self._rows += len(counts)
        if self._rows <= self._full:
            return None
        table = self.take()
        if table.num_rows > self._most:
            self._full = HELD_ROWS
            return table
        self._held, self._rows = table.to_batches(), table.num_rows
        self._full = max(HELD_ROWS, 2 * table.num_rows)
        return None

    def take(self) -> pa.Table:
        if not self._held:
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.table([pa.array([], kind) for kind in kinds], names=self._names)
        table = pa.Table.from_batches(self._held)
        self._held, self._rows = [], 0
        summed = table.group_by(self._names[:2], use_threads=False).aggregate([("f", "sum")])
        return summed.rename_columns(self._names)


def _first_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and those of cells of pairs in blocks."""
    names = _names(FIRST_COUNTS)
    cells, counts = _Cells(), _Counts("word")

    def of_words(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in table.to_batches():
            rest = [pa.nulls(batch.num_rows, kind) for kind in (pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *rest], names)

    def of_cells() -> pa.RecordBatch:
        blocks = cells.blocks()
        kinds = (pa.string(), pa.string(), pa.int64())
        rest = [pa.nulls(len(blocks[0]), kind) for kind in kinds]
        return pa.RecordBatch.from_arrays([*rest, *blocks], names)

    for words in _calls(batches):
        size = len(words.dictionary)
        keys, seen = np.unique(words.lang * size + words.codes, return_counts=True)
        lang, word = np.divmod(keys, size)
        full = counts.add(
            words.languages.take(pa.array(lang)), words.dictionary.take(pa.array(word)), seen
        )
        if full is not None:
            yield from of_words(full)
        if cells.add(words.cells(np.flatnonzero(words.together()), 2)):
            yield of_cells()
    yield from of_words(counts.take())
    yield of_cells()
    hand_back_memory()


def _second_scan(batches: Iterator[pa.RecordBatch], pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of cells of triples of which both pairs may be frequent."""
    cells = _Cells()
    for words in _calls(batches):
        if cells.add(words.cells(_both(_frequent_pairs(words, pairs)), 3)):
            yield pa.RecordBatch.from_arrays([*cells.blocks()], _names(CELL_COUNTS))
    yield pa.RecordBatch.from_arrays([*cells.blocks()], _names(CELL_COUNTS))
    hand_back_memory()


def _marked(cells: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (table[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _frequent_pairs(words: Words, table: np.ndarray) -> np.ndarray:
    """Whether a pair that may be frequent begins at each word."""
    found = np.zeros(len(words.codes), dtype=bool)
    at = np.flatnonzero(words.together())
    found[at[_marked(words.cells(at, 2), table)]] = True
    return found


def _both(follows: np.ndarray) -> np.ndarray:
    """Places that are marked as well as the next one."""
    return np.flatnonzero(follows[:-1] & follows[1:])


def frequent_cells(counted: DataFrame, min_count: int) -> np.ndarray:
    """One bit for each cell: whether its phrases occur at least ``min_count`` times together."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                entries = np.frombuffer(data, dtype="<u4")
                if block not in totals:
                    totals[block] = np.zeros(1 << BLOCK_BITS, dtype=np.int64)
                totals[block][entries >> 15] += entries & MOST_PARTIAL
        bits = [np.packbits(total >= min_count, bitorder="little").tobytes() for total in totals.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array(bits, pa.binary())], ["block", "bits"]
        )

    blocks = counted.where(F.col("block").isNotNull()).select("block", "cells")
    table = np.zeros(CELLS // 8, dtype=np.uint8)
    size = (1 << BLOCK_BITS) // 8
    # At most one row for each block: 16 MB in all.
    for row in blocks.repartition(32, "block").mapInArrow(summed, "block int, bits binary").collect():
        table[row.block * size : (row.block + 1) * size] = np.frombuffer(row.bits, dtype=np.uint8)
    return table


def _third_scan(
    batches: Iterator[pa.RecordBatch], pairs: np.ndarray, triples: np.ndarray, max_words: int
) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases that run through pairs and triples that may be frequent."""
    counts = _Counts("phrase", HELD_PHRASES)
    for words in _calls(batches):
        for lang, phrases, seen in _phrases(words, pairs, triples, max_words):
            if (full := counts.add(lang, phrases, seen)) is not None:
                yield from full.to_batches()
    yield from counts.take().to_batches()
    hand_back_memory()


def _phrases(
    words: Words, pairs: np.ndarray, triples: np.ndarray, max_words: int
) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """The phrases of a call, those of each length by language, phrase and count."""
    size = len(words.dictionary)
    follows = _frequent_pairs(words, pairs)
    at = np.flatnonzero(follows)
    triple = np.zeros(len(follows), dtype=bool)
    starts = _both(follows)
    triple[starts[_marked(words.cells(starts, 3), triples)]] = True
    # Phrases of n words are numbered in their order; a longer one is such a number and one more word.
    number = words.lang[at] * size + words.codes[at]
    for length in range(2, max_words + 1):
        different, first, number, counts = np.unique(
            number * size + words.codes[at + length - 1],
            return_index=True, return_inverse=True, return_counts=True,
        )
        if not len(different):
            return
        begin = at[first]
        parts = [words.dictionary.take(pa.array(words.codes[begin + place])) for place in range(length)]
        lang = words.languages.take(pa.array(words.lang[begin]))
        yield lang, pc.binary_join_element_wise(*parts, " "), counts
        longer = triple[at + length - 2]
        at, number = at[longer], number[longer]


def partial_counts(narrow: DataFrame, pairs: Broadcast, triples: Broadcast, max_words: int) -> DataFrame:
    """Counts of phrases that may be frequent, one row for each phrase and task that has it.

    A frequent phrase stands in nearly every split, so a task for each split would send rows that grow
    with the splits times the phrases; a task for each core reads many and sends a phrase once.
    """

    def third_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _third_scan(batches, pairs.value, triples.value, max_words)

    cores = narrow.sparkSession.sparkContext.defaultParallelism
    return narrow.coalesce(cores).mapInArrow(third_scan, PHRASES)


def count_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases of two words and more (``lang, phrase, f``), frequent words (``lang, word,
    f``) and the number of words of each language (``lang, n``)."""
    if not 0 < min_count <= MOST_PARTIAL or max_words < 2:
        raise ValueError(f"a count of 1 to {MOST_PARTIAL} and two words at least")
    narrow = docs.select(docs["lang"].cast("string"), docs["text"].cast("string"))
    context = docs.sparkSession.sparkContext
    first = materialize(narrow.mapInArrow(_first_scan, FIRST_COUNTS), "word-counts")
    pairs = context.broadcast(frequent_cells(first, min_count))
    second = materialize(
        narrow.mapInArrow(lambda batches: _second_scan(batches, pairs.value), CELL_COUNTS), "triples"
    )
    triples = context.broadcast(frequent_cells(second, min_count))

    counted = first.where(F.col("block").isNull())
    frequent = F.col("f") >= min_count
    partial = partial_counts(narrow, pairs, triples, max_words)
    phrases = partial.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))
    return (
        materialize(phrases.where(frequent), "phrases"),
        materialize(words.where(frequent), "words"),
        counted.groupBy("lang").agg(F.sum("f").alias("n")),
    )


def _stream(rows: DataFrame, words: Column) -> DataFrame:
    """Rows in the order of ``words``, in ranges that keep phrases with the same first two together."""
    ordered = rows.withColumn("order", words)
    return ordered.repartitionByRange(
        "lang", F.col("order")[0], F.col("order")[1]
    ).sortWithinPartitions("lang", "order")


def _open_parts(lang: str, words: list[str], stack: list[list]) -> list[list]:
    """Take from the stack what is no beginning of these words, and return it."""
    closed = []
    while stack and not (stack[-1][0] == lang and words[: len(stack[-1][1])] == stack[-1][1]):
        closed.append(stack.pop())
    return closed


def _prefix_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the counts of their beginnings, and whether a word behind them is always the same.

    The stack holds the row at hand and its beginnings: language, words, count, whether a longer
    phrase has the same count, count of the first word, row.
    """
    names = _names(LEFT)
    stack: list[list] = []
    columns: list[list] = [[] for _ in names]

    def out(closed: list[list]) -> None:
        for lang, words, count, inside, parts, last in closed:
            row = (lang, words, count, last, inside, parts)
            for column, value in zip(columns, row, strict=True):
                column.append(value)

    def written() -> pa.RecordBatch:
        kinds = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names
        )
        for column in columns:
            column.clear()
        return batch

    for batch in batches:
        for lang, words, count, first, last in zip(
            *(batch.column(place).to_pylist() for place in range(5)), strict=True
        ):
            out(_open_parts(lang, words, stack))
            if stack:
                parent = stack[-1]
                parts = [*parent[4], parent[2]]
                parent[3] = parent[3] or parent[2] == count
            else:
                parts = [first]
            stack.append([lang, words, count, False, parts, last])
        yield written()
    out(stack[::-1])
    yield written()


def _suffix_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scored candidates that stand not always inside the same longer phrase."""
    names = _names(SCORED)
    stack: list[list] = []
    columns: list[list] = [[] for _ in names]

    def out(closed: list[list]) -> None:
        for lang, backward, count, inside, rights, lefts, n in closed:
            if inside:
                continue
            cuts = zip(lefts, reversed(rights), strict=True)
            score, _, left, right = min(
                (1000 * count * n // (left * right), place, left, right)
                for place, (left, right) in enumerate(cuts)
            )
            row = (lang, " ".join(reversed(backward)), count, left, right, n, score)
            for column, value in zip(columns, row, strict=True):
                column.append(value)

    def written() -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names
        )
        for column in columns:
            column.clear()
        return batch

    for batch in batches:
        for lang, backward, count, last, inside, lefts, n in zip(
            *(batch.column(place).to_pylist() for place in range(7)), strict=True
        ):
            out(_open_parts(lang, backward, stack))
            if stack:
                parent = stack[-1]
                rights = [*parent[4], parent[2]]
                parent[3] = parent[3] or parent[2] == count
            else:
                rights = [last]
            stack.append([lang, backward, count, inside, rights, lefts, n])
        yield written()
    out(stack[::-1])
    yield written()


def score_phrases(phrases: DataFrame, words: DataFrame, sizes: DataFrame) -> DataFrame:
    """Candidates that are not dropped, with their scores: see ``SCORED``."""
    total = phrases.count()
    rows = phrases.select("lang", F.split("phrase", " ", -1).alias("words"), F.col("f").alias("a"))
    # Only phrases of two words take counts of words; longer ones get them from these in the streams.
    key = lambda word: F.concat(word, F.lit(" "), F.col("lang"))
    of_words = words.select(key(F.col("word")).alias("key"), F.col("f").alias("word_f"))
    two = rows.where(F.size("words") == 2)
    for name, place in (("first_f", 0), ("last_f", 1)):
        two = two.withColumn("key", key(F.col("words")[place]))
        hot = hot_keys(two, "key", total)
        two = lookup(two, of_words.withColumnRenamed("word_f", name), "key", F.col("words"), hot)
        two = two.drop("key")
    none = F.lit(None).cast("bigint")
    longer = rows.where(F.size("words") > 2).withColumns({"first_f": none, "last_f": none})
    every = materialize(two.unionByName(longer), "phrase-counts")
    prefix = _stream(every, F.col("words")).select("lang", "words", "a", "first_f", "last_f")
    lefts = prefix.mapInArrow(_prefix_pass, LEFT)
    hot = hot_keys(every, "lang", total)
    sized = lookup(lefts, sizes, "lang", F.col("words"), hot)
    suffix = _stream(materialize(sized, "left-counts"), F.reverse("words"))
    return suffix.select("lang", "order", "a", "last_f", "inside", "parts", "n").mapInArrow(
        _suffix_pass, SCORED
    )


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of each language (``lang``, ``text``) by score, count and phrase."""
    scored = score_phrases(*count_phrases(docs, min_count, max_words))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


COLLOCATION_SQL = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), cut AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut
), sizes AS (
    SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), grams AS (
    SELECT lang, w[i : i + k - 1] AS p, k
    FROM starts, (SELECT unnest(range(1, 6)) AS k) AS widths
    WHERE i + k - 1 <= len(w)
), f AS (
    SELECT lang, p, k, count(*)::HUGEINT AS a FROM grams GROUP BY lang, p, k HAVING count(*) >= 100
), kept AS (
    SELECT c.* FROM f AS c
    WHERE c.k >= 2 AND NOT EXISTS (
        SELECT 1 FROM f AS longer
        WHERE longer.lang = c.lang AND longer.k = c.k + 1 AND longer.a >= c.a
          AND (longer.p[: c.k] = c.p OR longer.p[2 :] = c.p)
    ) AND NOT EXISTS (
        SELECT 1 FROM f AS longer
        WHERE longer.lang = c.lang AND longer.k > c.k + 1 AND longer.a >= c.a
          AND (contains(' ' || array_to_string(longer.p, ' ') || ' ', ' ' || array_to_string(c.p, ' ') || ' '))
    )
), cuts AS (
    SELECT c.lang, c.p, c.a, left_part.k AS cut, left_part.a AS l, right_part.a AS r, n,
           (1000 * c.a * n) // (left_part.a * right_part.a) AS score
    FROM kept AS c
    JOIN sizes USING (lang)
    JOIN f AS left_part ON left_part.lang = c.lang AND left_part.k < c.k
        AND left_part.p = c.p[: left_part.k]
    JOIN f AS right_part ON right_part.lang = c.lang AND right_part.k = c.k - left_part.k
        AND right_part.p = c.p[left_part.k + 1 :]
), lowest AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a,
           arg_min(struct_pack(l := l, r := r, n := n, score := score), (score, cut)) AS best
    FROM cuts GROUP BY lang, p, a
), ranked AS (
    SELECT lang, phrase, a, best.l AS l, best.r AS r, best.n AS n, best.score AS score,
           row_number() OVER (
               PARTITION BY lang ORDER BY best.score DESC, a DESC, encode(phrase)
           ) AS rank
    FROM lowest
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
