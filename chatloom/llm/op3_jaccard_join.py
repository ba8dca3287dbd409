"""N-gram Jaccard self-join with a MinHash LSH forest and exact verification.

1. Equal texts are one node. Every text gets ``TREES * MAX_DEPTH`` MinHash symbols of 16 bits.
2. Each tree is a prefix trie over its ``MAX_DEPTH`` symbols, kept as sorted keys. Matched prefixes
   are shortened from the full depth until a pair at the threshold shares one in some tree with the
   target probability; texts below one trie node of that depth are a group.
3. A pair belongs to the first tree in which it shares its prefix, and only if its symbols agree in
   enough places. Groups are cut into tiles of a bounded number of texts and compared tile by tile;
   what leaves a tile pair is one row per text, never a pair.
4. The texts that still have partners are brought to their tile pairs, where the shingle sets decide
   exactly. A tile pair reports each text's number of links and the local component it belongs to.
5. Components of those local components, over different texts only, are the classes.

So hot groups cost more tile pairs, not larger ones, copies cost one row each, and no step emits
all pairs of a group. The recall of links comes from the target (a miss of at most 1e-5 for a pair
exactly at the threshold, far less above it).

Result of ``jaccard_join``: per row ``doc_id``, ``class_id`` (the least id of its class), ``links``
(other documents with a similarity of at least the threshold, copies counted each) and ``copies``
(rows of the same text). Edge cases: a null text counts as empty; texts without words are linked to
equal texts only; shorter texts than a shingle are one shingle; rows that repeat count as copies;
null ids are kept, and a class of null ids alone has a null class; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import fresh, hand_back_memory, materialize
from chatloom.llm.components import connected_components
from chatloom.llm.shingles import jaccard, shingle_set
from chatloom.operators.skew import SALTS, lookup
from chatloom.scratch import materialize_and_measure

THRESHOLD = 0.8
TREES = 32
MAX_DEPTH = 6
TARGET_RECALL = 0.99999

# Texts of a tile: what a task holds of one group at a time is two tiles.
TILE_TEXTS = 256

# Nodes to fetch texts for, up to which their ids are broadcast (some 40 bytes each) to the scan
# of the documents; beyond it both sides are shuffled.
BROADCAST_NODES = 500_000

# An estimate this much below the threshold is 4.8 standard deviations of 192 symbols away.
ESTIMATE_SLACK = 0.14


def forest_depth(
    threshold: float = THRESHOLD, trees: int = TREES, depth: int = MAX_DEPTH,
    target: float = TARGET_RECALL,
) -> int:
    """The longest prefix that still reaches the target recall at the threshold."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240229)
    odd = random.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    return odd, random.integers(0, 1 << 32, count, dtype=np.uint32)


def symbols(shingles: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """MinHash symbols of a set that is not empty."""
    base = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(odd), 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(base), 512):
        values = base[start : start + 512, None] * odd + add
        values ^= values >> np.uint32(15)
        np.minimum(least, values.min(axis=0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2")


def text_key(text: Column) -> Column:
    """128 bits of SHA-256 of a text."""
    digest = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    return F.unhex(F.substring(digest, 1, 32))


def _sketched(trees: int, depth: int):
    count = trees * depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd, add = _permutations(count)
        for batch in batches:
            found = []
            for text in batch.column(2):
                shingles = shingle_set(text.as_py())
                found.append(symbols(shingles, odd, add).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())],
                ["doc_id", "key", "symbols"],
            )
        hand_back_memory()

    return run


def _prefix_rows(nodes: DataFrame, trees: int, depth: int, used: int) -> DataFrame:
    """One row for each node and tree: a 64-bit key of the tree and its prefix."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    start = F.col("tree") * (2 * depth) + 1
    return (
        nodes.where(F.col("symbols").isNotNull())
        .select("key", "symbols", tree.alias("tree"))
        .select(
            "key",
            F.xxhash64("tree", F.substring("symbols", start, F.lit(2 * used))).alias("prefix"),
            "tree",
        )
    )


class _Unit:
    """The rows of one tile pair: where its candidate pairs are found and decided."""

    def __init__(self, tree: int, low: int, high: int) -> None:
        self.tree, self.low, self.high = tree, low, high
        self.keys: list[bytes] = []
        self.tiles: list[int] = []
        self.symbols: list[bytes] = []
        self.more: list = []
        self._known: set[bytes] = set()

    def add(self, key: bytes, tile: int, symbols: bytes, more=None) -> None:
        if key not in self._known:  # rows of one id and text repeat a node
            self._known.add(key)
            self.keys.append(key)
            self.tiles.append(tile)
            self.symbols.append(symbols)
            self.more.append(more)

    def candidates(self, trees: int, depth: int, used: int, least: float):
        """Places of the pairs whose first common prefix is in this tree, a block at a time."""
        table = np.frombuffer(b"".join(self.symbols), "<u2").reshape(len(self.keys), trees, depth)
        prefixes = table[:, : self.tree + 1, :used]
        tiles = np.array(self.tiles)
        left = np.flatnonzero(tiles == self.low)
        right = left if self.low == self.high else np.flatnonzero(tiles == self.high)
        for place in left:
            others = right[right > place] if self.low == self.high else right
            same = (prefixes[others] == prefixes[place]).all(axis=2)
            first = same[:, self.tree] & ~same[:, : self.tree].any(axis=1)
            others = others[first]
            if len(others):
                agree = (table[others] == table[place]).mean(axis=(1, 2))
                others = others[agree >= least]
            if len(others):
                yield int(place), others


_UNIT = ("prefix", "tree", "low", "high")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT)


def _links(nodes: DataFrame, docs: DataFrame, threshold, trees, depth, target, tile_texts,
           broadcast_nodes) -> DataFrame:
    """Per node and tile pair with links: ``key``, ``text_links``, ``links`` and ``local``.

    ``links`` counts the documents of the linked texts, ``local`` is the least key of the node's
    component inside the tile pair.
    """
    used = forest_depth(threshold, trees, depth, target)
    least = threshold - ESTIMATE_SLACK
    prefixes = _prefix_rows(nodes, trees, depth, used)
    sizes = (
        prefixes.groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("size"))
        .where(F.col("size") > 1)
    )
    tiles = F.ceil(F.col("size") / tile_texts).cast("int")
    members = materialize(
        prefixes.join(sizes, "prefix")
        .withColumn("tiles", tiles)
        .withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
        .select("prefix", "tree", "key", "tile", "tiles"),
        "forest-members",
    )
    placed = members.join(nodes.select("key", "symbols"), "key").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    )
    units = placed.select(
        "prefix",
        "tree",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        "key",
        "tile",
        "symbols",
    )

    def shortlist(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows = [*_UNIT, "key", "tile"], []

        def batch_of(some: list) -> pa.RecordBatch:
            columns = zip(*some, strict=True) if some else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names
            )

        for prefix, unit in _named_units(batches, False):
            partners = set()
            for place, others in unit.candidates(trees, depth, used, least):
                partners.add(place)
                partners.update(others.tolist())
            for place in sorted(partners):
                rows.append(
                    (prefix, unit.tree, unit.low, unit.high, unit.keys[place], unit.tiles[place])
                )
            if len(rows) > 20_000:
                yield batch_of(rows)
                rows = []
        yield batch_of(rows)

    wanted, seen = materialize_and_measure(
        _dealt(units).mapInArrow(
            shortlist, "prefix bigint, tree int, low int, high int, key binary, tile int"
        ),
        "forest-shortlist",
        rows=F.count(F.lit(1)),
    )
    texts = docs.select(
        F.col("doc_id").alias("rep"), text_key(F.col("text")).alias("key"), "text"
    )
    ids = nodes.join(wanted.select("key").distinct(), "key").select("key", "rep")
    if seen["rows"] <= broadcast_nodes:
        ids = F.broadcast(ids)
    # One row for each node: the one with the node's least id.
    texts = texts.join(
        ids.withColumnRenamed("rep", "_rep").withColumnRenamed("key", "_key"),
        (F.col("key") == F.col("_key")) & F.col("rep").eqNullSafe(F.col("_rep")),
    ).select("key", "text")
    carried = wanted.join(texts, "key").join(nodes.select("key", "symbols", "copies"), "key")
    carried = carried.select(*_UNIT, "key", "tile", "symbols", "text", "copies")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "text_links", "links", "local"]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        for _, unit in _named_units(batches, True):
            sets: dict[int, np.ndarray] = {}
            root = list(range(len(unit.keys)))
            counts = np.zeros((len(unit.keys), 2), dtype=np.int64)

            def shingles(place: int) -> np.ndarray:
                if place not in sets:
                    sets[place] = shingle_set(unit.more[place][0])
                return sets[place]

            def find(place: int) -> int:
                while root[place] != place:
                    root[place] = root[root[place]]
                    place = root[place]
                return place

            for place, others in unit.candidates(trees, depth, used, least):
                mine = shingles(place)
                for other in others.tolist():
                    theirs = shingles(other)
                    few, many = sorted((len(mine), len(theirs)))
                    if few >= threshold * many and jaccard(mine, theirs) >= threshold:
                        counts[place] += (1, unit.more[other][1])
                        counts[other] += (1, unit.more[place][1])
                        root[find(place)] = find(other)
            linked = np.flatnonzero(counts[:, 0]).tolist()
            least_key: dict[int, bytes] = {}
            for place in linked:
                top = find(place)
                least_key[top] = min(least_key.get(top, unit.keys[place]), unit.keys[place])
            if linked:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([unit.keys[p] for p in linked], kinds[0]),
                        pa.array(counts[linked, 0], kinds[1]),
                        pa.array(counts[linked, 1], kinds[2]),
                        pa.array([least_key[find(p)] for p in linked], kinds[3]),
                    ],
                    names,
                )
        hand_back_memory()

    return materialize(
        _dealt(carried).mapInArrow(
            verify, "key binary, text_links bigint, links bigint, local binary"
        ),
        "forest-links",
    )


def _named_units(batches: Iterator[pa.RecordBatch], more: bool) -> Iterator[tuple[int, _Unit]]:
    current, unit = None, None
    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for row in zip(*columns, strict=True):
            if row[:4] != current:
                if unit is not None:
                    yield current[0], unit
                current, unit = row[:4], _Unit(*row[1:4])
            unit.add(row[4], row[5], row[6], row[7:] if more else None)
    if unit is not None:
        yield current[0], unit


def _classed_rows(
    docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, depth: int = MAX_DEPTH,
    target: float = TARGET_RECALL, tile_texts: int = TILE_TEXTS,
    broadcast_nodes: int = BROADCAST_NODES,
) -> DataFrame:
    """Per row ``doc_id``, ``key`` and the facts of its text; ``kept`` marks the rows of the class's
    least id (and least key, should several texts have that id)."""
    keyed = docs.select(
        F.col("doc_id").cast("bigint"),
        text_key(F.col("text")).alias("key"),
        F.col("text").cast("string"),
    )
    rows, seen = materialize_and_measure(
        keyed.mapInArrow(_sketched(trees, depth), "doc_id bigint, key binary, symbols binary"),
        "forest-symbols",
        rows=F.count(F.lit(1)),
    )
    nodes = materialize(
        rows.groupBy("key").agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.min("symbols").alias("symbols"),
        ),
        "forest-nodes",
    )
    links = _links(nodes, docs, threshold, trees, depth, target, tile_texts, broadcast_nodes)
    counted = links.groupBy("key").agg(
        F.sum("links").alias("links"), F.sum("text_links").alias("text_links")
    )
    roots = connected_components(
        links.select(F.col("key").alias("u"), F.col("local").alias("v"))
    ).select(F.col("node").alias("key"), "root")
    classed = (
        nodes.select("key", "rep", "copies")
        .join(counted, "key", "left")
        .join(roots, "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    order = F.struct(F.col("rep").isNull().alias("none"), "rep", "key")
    least = classed.groupBy("root").agg(F.min(order).alias("first"))
    described = materialize(
        classed.join(least, "root").select(
            "key",
            F.col("first.rep").alias("class_id"),
            (F.col("first.key") == F.col("key")).alias("first"),
            "copies",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("text_links", F.lit(0)).alias("text_links"),
        ),
        "forest-classes",
    )
    # Texts with more than 1/128 of all rows: fewer than 128, whose rows are dealt to many tasks.
    limit = seen["rows"] // SALTS + 1
    hot = [row[0] for row in described.where(F.col("copies") > limit).select("key").collect()]
    rows = rows.select("doc_id", "key", F.monotonically_increasing_id().alias("_spread"))
    joined = lookup(rows, described, "key", F.col("_spread"), hot)
    return joined.withColumn(
        "kept", F.col("first") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    )


def jaccard_join(docs: DataFrame, **settings) -> DataFrame:
    """One row per document with its class and number of links: see the module."""
    return _classed_rows(docs, **settings).select(
        "doc_id", "class_id", "links", "text_links", "copies"
    )


def representatives(docs: DataFrame, **settings) -> DataFrame:
    """One row of ``docs`` for each class, one with the least id; all columns are kept.

    The rows that go are joined to ``docs``, broadcast up to ``BROADCAST_NODES`` of them.
    """
    names = docs.columns
    own_id, own_key, mark_id, mark_key, stays = (
        fresh(name, names) for name in ("own_id", "own_key", "mark_id", "mark_key", "stays")
    )
    marks, seen = materialize_and_measure(
        _classed_rows(docs, **settings)
        .groupBy("doc_id", "key")
        .agg(F.bool_and("kept").alias(stays), F.count(F.lit(1)).alias("times"))
        .where(~F.col(stays) | (F.col("times") > 1))
        .select(F.col("doc_id").alias(mark_id), F.col("key").alias(mark_key), stays),
        "forest-marks",
        rows=F.count(F.lit(1)),
        again=F.count_if(stays),
    )
    if seen["rows"] <= settings.get("broadcast_nodes", BROADCAST_NODES):
        marks = F.broadcast(marks)
    marked = docs.withColumns(
        {own_id: F.col("doc_id").cast("bigint"), own_key: text_key(F.col("text"))}
    ).join(
        marks,
        F.col(own_id).eqNullSafe(F.col(mark_id)) & (F.col(own_key) == F.col(mark_key)),
        "left",
    )
    result = marked.where(F.col(stays).isNull())
    if seen["again"]:
        # A row that is there several times stays once.
        result = result.unionByName(marked.where(stays).dropDuplicates([own_id, own_key]))
    return result.select(*names)
