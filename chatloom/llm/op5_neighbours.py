"""Approximate nearest neighbours by collision counting over query-aware hash tables.

The largest inner product becomes the least distance: vectors are scaled by the largest norm and get
one more coordinate that makes their length 1, queries are scaled to length 1. Each of
``PROJECTIONS`` random directions gives a sorted array of projections. A window around the query's
own projection grows in every array at once (virtual rehashing: radius ``R``, then ``R * GROWTH``
...), each entry that a window reaches counts for its vector, and a vector whose count reaches the
collision threshold is verified with its exact score. A query ends when its k-th best verified
distance lies inside the radius; once windows hold everything, every vector has been verified, so
the search can never come back with too few.

All rows are indexed, those that repeat an id and vector as one, in segments of about
``SEGMENT_ROWS`` random rows; queries come in blocks.
One unit of work is a segment and a block: it builds the segment's arrays and keeps the best k for
each query of the block; the best of those are merged. Nothing that grows with the data is held in
one place.

Result: ``query_id``, ``rank``, ``vec_id``, ``score`` (inner product in double precision on the
original vectors), nearest first, ties to the smaller ``vec_id``. Edge cases: vectors that are null,
empty, zero or hold null or non-finite components, and rows without id, take no part; vectors of
another length are no candidates; repeated rows of an id and vector count once, and a query id with
several vectors asks with the least of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


NEAREST = 20
PROJECTIONS = 24
COLLISIONS = 0.5
GROWTH = 1.25
FIRST_RADIUS = 0.1
SEGMENT_ROWS = 16_384
QUERY_ROWS = 2_048


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Segment:
    """The sorted projection arrays of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 7) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order].astype(np.float64)
        norms = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.norm = float(np.sqrt(norms.max()))
        last = np.sqrt(np.maximum(0.0, 1.0 - norms / self.norm**2))
        points = np.column_stack([self.vectors / self.norm, last])
        directions = np.random.default_rng(seed).standard_normal((points.shape[1], PROJECTIONS))
        projected = points @ directions
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(projected.T, self.order, axis=1)
        self.directions = directions[:-1]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """For each query the ids and scores of its best k, best first."""
        queries = queries.astype(np.float64)
        lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        centres = (queries / lengths[:, None]) @ self.directions
        reach = float(np.abs(self.sorted).max() + np.abs(centres).max())
        radii = [FIRST_RADIUS]
        while radii[-1] <= reach:
            radii.append(radii[-1] * GROWTH)
        # Ends of the window of every query in every array, for every radius.
        shape = (len(radii), PROJECTIONS, len(queries))
        low, high = np.empty(shape, dtype=np.int64), np.empty(shape, dtype=np.int64)
        start = np.empty(shape[1:], dtype=np.int64)
        for table, line in enumerate(self.sorted):
            middle = centres[:, table]
            start[table] = np.searchsorted(line, middle)
            for step, radius in enumerate(radii):
                low[step, table] = np.searchsorted(line, middle - radius, "left")
                high[step, table] = np.searchsorted(line, middle + radius, "right")
        return [
            self._search_one(
                query_ids[place], queries[place], lengths[place], k, radii,
                start[:, place].tolist(), low[:, :, place].tolist(), high[:, :, place].tolist(),
            )
            for place in range(len(queries))
        ]

    def _search_one(self, query_id, query, length, k, radii, start, low, high):
        size, needed = len(self.ids), int(np.ceil(COLLISIONS * PROJECTIONS))
        counts = np.zeros(size, dtype=np.int64)
        verified = self.ids == query_id  # the query's own row is no candidate
        places, scores = np.empty(0, dtype=np.int64), np.empty(0)
        inner, outer = start, start
        for radius, lows, highs in zip(radii, low, high, strict=True):
            grown = []
            for row, a, b, c, d in zip(self.order, lows, inner, outer, highs, strict=True):
                if a < b:
                    grown.append(row[a:b])
                if c < d:
                    grown.append(row[c:d])
            inner, outer = lows, highs
            if not grown:
                continue
            counts += np.bincount(np.concatenate(grown), minlength=size)
            fresh = np.flatnonzero((counts >= needed) & ~verified)
            if len(fresh):
                verified[fresh] = True
                places = np.concatenate([places, fresh])
                scores = np.concatenate([scores, self.vectors[fresh] @ query])
            if len(scores) >= k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                if 2.0 - 2.0 * kth / (self.norm * length) <= radius * radius:
                    break
        best = np.lexsort((places, -scores))[:k]
        return self.ids[places[best]], scores[best]


_UNIT = ("dim", "segment", "block")
_FOUND = "query_id bigint, vec_id bigint, score double"


def _search_units(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    def emit(unit) -> pa.RecordBatch:
        rows: list[tuple] = [((), (), ())]
        sides = [
            (np.array(ids, dtype=np.int64), np.stack(vectors)) if ids else None
            for ids, vectors in unit
        ]
        if all(side is not None for side in sides):
            (ids, vectors), (query_ids, queries) = sides
            found = Segment(ids, vectors).search(query_ids, queries, k)
            rows = [
                (np.full(len(best), query), best, score)
                for query, (best, score) in zip(query_ids, found, strict=True)
            ]
        columns = [np.concatenate([row[at] for row in rows]) for at in range(3)]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)),
             pa.array(columns[2].astype(np.float64))],
            ["query_id", "vec_id", "score"],
        )

    current, unit = None, None
    for batch in batches:
        names = list(zip(*(batch.column(at).to_pylist() for at in range(3)), strict=True))
        roles, ids = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        flat = batch.column(5).flatten().to_numpy(zero_copy_only=False)
        offset = 0
        for name, role, row_id in zip(names, roles, ids, strict=True):
            if name != current:
                if unit is not None:
                    yield emit(unit)
                current, unit = name, (([], []), ([], []))
            vector = flat[offset : offset + name[0]]
            offset += name[0]
            unit[role][0].append(row_id)
            unit[role][1].append(vector)
    if unit is not None:
        yield emit(unit)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, segment_rows: int = SEGMENT_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` nearest rows of each query among all rows of ``vec_id``, ``embedding``."""
    # Repeated rows are one before they are counted, dealt to segments and take one of k places.
    rows = (
        vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select(
            F.col("vec_id").cast("bigint").alias("id"),
            F.col("embedding").alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
        .groupBy("id", "vector")
        .agg(F.max("asks").alias("asks"))
        .withColumn("dim", F.size("vector"))
    )
    counts = rows.agg(F.count(F.lit(1)), F.coalesce(F.count_if("asks"), F.lit(0))).first()
    segments, blocks = -(-counts[0] // segment_rows) or 1, -(-counts[1] // query_rows) or 1
    queries = (
        rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
        .withColumn("dim", F.size("vector"))
    )

    def number(count: int, *columns) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    indexed = rows.select(
        "dim", number(segments, "id", "vector").alias("segment"), every(blocks).alias("block"),
        F.lit(0).alias("role"), "id", "vector",
    )
    asking = queries.select(
        "dim", every(segments).alias("segment"), number(blocks, "id").alias("block"),
        F.lit(1).alias("role"), "id", "vector",
    )
    units = indexed.unionByName(asking).repartition(segments * blocks, *_UNIT)
    found = units.sortWithinPartitions(*_UNIT, "role").mapInArrow(
        lambda batches: _search_units(batches, k), _FOUND
    )
    # At most k rows for each query and segment.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


