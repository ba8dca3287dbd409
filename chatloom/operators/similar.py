"""Nearest earlier neighbour by cosine similarity: an exact, blocked join.

For every row the join finds the earlier row (smaller index) with the highest dot product, if that
reaches the threshold. All earlier rows count, also removed ones; equal scores go to the smallest
index. ``nearest_between`` does the same from one set of rows to another.

How the work is spread
----------------------
* Of rows with identical vectors only the first is offered as a match; all of them look for one.
  That holds for vectors of any length, because equal vectors have equal scores with every row.
* Some rows serve as centres in two levels: a row lives at a leaf, found through the pivot that the
  leaf belongs to. Leaves are cut into tiles of bounded size in the order of the tree, and
  consecutive tiles form groups, so a group holds neighbouring leaves.
* The rows of a leaf are told apart by rings of angles to its centre, so that far rows don't widen the
  reach of near ones. A row's own angle to the centre and the interval of a ring's angles say whether
  the ring can hold a row that is close enough; whole pivots are ruled out first. So every row finds
  the groups that it has to meet by itself, from tables as large as the tree, and is sent to the
  cells of its own group with each of them. Nothing lists pairs of groups.
* Inside a cell the same test with the tiles' own centres decides which tiles are multiplied. A cell
  holds one group and streams the other. It emits at most one candidate per row, never the pairs; a
  partial aggregation keeps the best candidate.
* Where one set looks for matches in another, only the offered rows live in the tree. The asking rows
  are dealt to parts by a hash and stream past the groups in their reach; two offered tiles never
  meet.
* A table that fits one group is compared in one cell, without a tree.
* Where nothing can be ruled out a row has as many copies as there are groups. Cells are then dealt to
  rounds; the copies of a round are gone before the next one's are sent, so the disk follows the rows.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators.exact import exact_copies
from chatloom.operators.marks import unreferenced
from chatloom.operators.vectors import VectorProfile, squared_norm
from chatloom.scratch import materialize, materialize_and_measure

SEMANTIC_REASON = "semantic_duplicate"  # fixed value

MATCH_SCHEMA = "duplicate_index long, matched_index long, similarity double"
_MATCH_FIELDS = [
    ("duplicate_index", pa.int64()),
    ("matched_index", pa.int64()),
    ("similarity", pa.float64()),
]

# Bounds that hold for any input size: bytes of vectors in one tile and in one group of tiles, bytes
# of all pivots and of all leaves (they are broadcast), number of pivots and leaves.
TILE_BYTES = 32 << 20
GROUP_BYTES = 128 << 20
PIVOT_BYTES = 16 << 20
LEAF_BYTES = 32 << 20
MAX_PIVOTS = 2048
MAX_LEAVES = 1 << 16
# Up to so many leaves are chosen from a larger sample, so that they lie apart.
SPREAD_LEAVES = 1024

# Rings of a leaf: up to half of the widest angle of two matching rows, up to it, up to twice it, beyond.
RING_EDGES = (0.5, 1.0, 2.0)
RINGS = len(RING_EDGES) + 1

# Tasks of the comparison; beyond, a task gets several cells.
MAX_TASKS = 50_000

# Bytes of copies that are sent to cells in one round: so many, or so many times the vectors if that is
# more. Cells of a round are few, so that each gets more tasks.
ROUND_BYTES = 1 << 30
ROUND_COPIES = 4
TASKS_PER_ROUND_CELL = 8

# Rows whose reach is found at a time, and bytes of vectors in one batch that is sent on.
ROWS_PER_REACH = 1024
BATCH_BYTES = 4 << 20

MIN_TILE_ROWS = 256
ROWS_PER_PRODUCT = 512
COLUMNS_PER_PRODUCT = 2048
CELLS_PER_CORE = 4
# Cells are dealt by a hash; with so many tasks for each, few of them share one.
TASKS_PER_CELL = 2

# Rows that are widened to double precision at a time.
ROWS_PER_CAST = 8192
# Of pairs that single precision cannot decide, more than one in so many are multiplied as a block.
DENSE = 64

# Rows of the sample for the basis, and its lengths: see :func:`basis_of`.
SKETCH_ROWS = 1024
SKETCHES = (32, 48, 64, 96, 128, 192, 256, 384, 512)

# Fewer rows are not worth a group of their own.
MIN_GROUP_ROWS = 2048

# Slack for rounding in the pruning test, and digits at which two scores count as equal.
PRUNING_SLACK = 1e-6
SCORE_DIGITS = 12
TIE = 0.5 * 10.0**-SCORE_DIGITS


@dataclass(frozen=True)
class Tiling:
    rows: int
    tile_rows: int
    pivots: int
    leaves: int
    groups: int
    # Parts of the asking rows, where these are a set of their own, and tiles of each part.
    parts: int = 1
    part_tiles: int = 1


def plan_tiling(
    rows: int, dimension: int, parallelism: int, requested_rows: int | None = None,
    asking: int | None = None,
) -> Tiling:
    """Tiles and groups that give every core some cells and fit the byte bounds.

    ``rows`` are those that live in the tree; ``asking`` the number of a second set.
    """
    width = 4 * max(dimension, 1)
    cells = CELLS_PER_CORE * parallelism
    few = 2 * requested_rows if requested_rows else MIN_GROUP_ROWS
    for_memory = math.ceil(rows * width / GROUP_BYTES)
    if asking is None:
        wanted, parts = math.ceil(math.sqrt(2 * cells)), 1
    else:
        # The product of both counts is the number of cells; copies are fewest in this proportion.
        wanted = max(1, math.ceil(math.sqrt(cells * rows / max(1, asking))))
        groups = max(1, for_memory, min(wanted, math.ceil(rows / few)))
        parts = min(math.ceil(cells / groups), max(1, math.ceil(asking / few)))
    for_all_cores = math.ceil(rows / (2 * wanted))
    tile_rows = min(
        max(1, TILE_BYTES // width), requested_rows or max(MIN_TILE_ROWS, for_all_cores)
    )
    tiles = max(1, math.ceil(rows / tile_rows))
    groups = min(tiles, max(1, min(wanted, math.ceil(rows / few)), for_memory))
    leaves = min(MAX_LEAVES, max(1, LEAF_BYTES // width), tiles)
    pivots = min(MAX_PIVOTS, max(1, PIVOT_BYTES // width), math.ceil(math.sqrt(leaves)))
    part_tiles = max(1, math.ceil((asking or 0) / (parts * tile_rows)))
    return Tiling(rows, tile_rows, pivots, leaves, groups, parts, part_tiles)


def nearest_earlier(
    vectors: DataFrame,
    profile: VectorProfile,
    threshold: float,
    *,
    index: str = "row_index",
    vector: str = "embedding",
    chunk_rows: int = ROWS_PER_PRODUCT,
    tile_rows: int | None = None,
) -> DataFrame:
    """``duplicate_index, matched_index, similarity`` of every row with a close earlier row.

    ``vectors`` must be materialized and checked, with norms as ``profile`` says. The last two
    parameters spread the work and do not change the result.
    """
    rows = vectors.select(F.col(index).alias("id"), F.col(vector).alias("vec"))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    tiling = plan_tiling(profile.n_rows, profile.dimension, cores, tile_rows)
    # In one cell identical rows cost nothing that would be worth finding them first.
    if tiling.groups > 1:
        copies, n_copies = identical(rows)
        if n_copies:
            return _with_copies(rows, copies, n_copies, profile, threshold, chunk_rows, tile_rows)
    return _best_matches(_flagged(rows, True, True), tiling, profile, threshold, True, chunk_rows)


def _flagged(rows: DataFrame, asks: bool, offered: bool) -> DataFrame:
    return rows.select("id", "vec", F.lit(asks).alias("asks"), F.lit(offered).alias("offered"))


def _with_copies(
    rows: DataFrame, copies: DataFrame, n_copies: int, profile: VectorProfile, threshold: float,
    chunk_rows: int, tile_rows: int | None,
) -> DataFrame:
    """Matches where some rows have the vector of an earlier one.

    Of identical rows the first one takes part in the join. A later one matches it, with the squared
    length of both as score, unless some other row scores as much with them: a rival, which the
    first one's comparisons show. Only copies of rows with rivals look for their match.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    later = materialize(copies.select("id", F.col("retained").alias("first")), "identical")
    span = rows.agg(F.min("id"), F.max("id")).first()
    first = materialize(unreferenced(rows, later, "id", *span), "distinct")
    tiling = plan_tiling(profile.n_rows - n_copies, profile.dimension, cores, tile_rows)
    found = materialize(
        _candidates(
            _flagged(first, True, True), tiling, profile, threshold, True, chunk_rows, rivals=True
        ),
        "found",
    )
    # Vectors stay where they are, but for those of copies with rivals.
    again = rows.select("id", squared_norm(F.col("vec")).alias("own")).join(later, "id")
    with_rival = found.select(
        F.col("duplicate_index").alias("first"),
        F.col("rival"),
        F.col("best.similarity").alias("_score"),
    )
    # Scores were rounded, so the tie width is taken twice.
    rival = F.coalesce("rival", F.lit(False)) | F.coalesce(
        F.col("_score") >= F.col("own") - 3 * TIE, F.lit(False)
    )
    again, seen = materialize_and_measure(
        again.join(with_rival, "first", "left").select(
            "id", "first", "own", rival.alias("rival")
        ),
        "copies",
        rivals=F.count_if("rival"),
        least=F.min(F.when(F.col("rival"), F.col("own"))),
    )
    matches = _matches_of(found.where(F.col("best").isNotNull())).unionByName(
        again.where(~F.col("rival") & (F.round("own", SCORE_DIGITS) >= threshold)).select(
            F.col("id").alias("duplicate_index"),
            F.col("first").alias("matched_index"),
            F.round("own", SCORE_DIGITS).alias("similarity"),
        )
    )
    if not seen["rivals"]:
        return matches
    asking = _flagged(rows.join(again.where("rival").select("id"), "id"), True, False)
    every = asking.unionByName(_flagged(first, False, True))
    tiling = plan_tiling(
        profile.n_rows - n_copies + seen["rivals"], profile.dimension, cores, tile_rows
    )
    # Each of them has its first one, so nothing below that can be the best match.
    least = max(threshold, seen["least"] - 1e-9)
    best = _candidates(every, tiling, profile, least, True, chunk_rows)
    best = _matches_of(best).where(F.col("similarity") >= threshold)
    return matches.unionByName(best)


def nearest_between(
    asking: DataFrame,
    offered: DataFrame,
    profile: VectorProfile,
    threshold: float,
    *,
    index: str = "row_index",
    vector: str = "embedding",
    chunk_rows: int = ROWS_PER_PRODUCT,
    tile_rows: int | None = None,
) -> DataFrame:
    """The same from the rows of ``asking`` to their best match in ``offered``, in any order.

    ``profile`` covers both sides.
    """
    sides = [
        _flagged(
            rows.select(F.col(index).alias("id"), F.col(vector).alias("vec")), asks, not asks
        )
        for rows, asks in ((asking, True), (offered, False))
    ]
    n_asking = asking.count()
    cores = asking.sparkSession.sparkContext.defaultParallelism
    tiling = plan_tiling(
        max(0, profile.n_rows - n_asking), profile.dimension, cores, tile_rows, n_asking
    )
    both = sides[0].unionByName(sides[1])
    return _best_matches(both, tiling, profile, threshold, False, chunk_rows)


def _best_matches(
    flagged: DataFrame, tiling: Tiling, profile: VectorProfile, threshold: float, earlier: bool,
    chunk_rows: int,
) -> DataFrame:
    return _matches_of(_candidates(flagged, tiling, profile, threshold, earlier, chunk_rows))


def _candidates(
    flagged: DataFrame, tiling: Tiling, profile: VectorProfile, threshold: float, earlier: bool,
    chunk_rows: int, rivals: bool = False,
) -> DataFrame:
    cosine = least_cosine(threshold, profile)
    most = copies_per_round(profile)
    dealt = shipped(flagged, tiling, cosine, earlier, profile.dimension, most)
    basis = None
    if (tiling.groups > 1 or tiling.parts > 1) and profile.dimension > SKETCHES[0]:
        sample = _hashed_sample(flagged.where("offered"), tiling.rows, SKETCH_ROWS)
        basis = basis_of(sample, threshold)
    best = [
        _best_by_row(cells, threshold, cosine, earlier, chunk_rows, basis, rivals)
        for cells in (dealt if isinstance(dealt, list) else [dealt])
    ]
    if len(best) == 1:
        return best[0]
    # At most one row for each vector and round.
    every = reduce(DataFrame.unionByName, [materialize(found, "round") for found in best])
    columns = [F.max("best").alias("best")]
    if rivals:
        columns.append(F.bool_or("rival").alias("rival"))
    return every.groupBy("duplicate_index").agg(*columns)


def copies_per_round(profile: VectorProfile) -> int:
    """How many copies of vectors may be on disk at a time."""
    width = 4 * max(profile.dimension, 1)
    return max(ROUND_BYTES // width, ROUND_COPIES * profile.n_rows, 1)


def least_cosine(threshold: float, profile: VectorProfile) -> float:
    """No two rows with a lower cosine reach the threshold."""
    return min(1.0, threshold / profile.max_norm**2) - PRUNING_SLACK


def best_candidates(
    dealt: DataFrame, threshold: float, cosine: float, earlier: bool, chunk_rows: int
) -> DataFrame:
    """The best match of each row over all the cells in which it stands (see ``shipped``)."""
    return _matches_of(_best_by_row(dealt, threshold, cosine, earlier, chunk_rows))


def _best_by_row(
    dealt: DataFrame, threshold: float, cosine: float, earlier: bool, chunk_rows: int,
    basis: np.ndarray | None = None, rivals: bool = False,
) -> DataFrame:
    """``duplicate_index``, its ``best`` match (of a row with nothing but rivals, NULL), and with
    ``rivals`` whether a ``rival`` was seen."""
    shared = dealt.sparkSession.sparkContext.broadcast(basis)
    best = F.max(F.struct(F.col("similarity"), (-F.col("matched_index")).alias("_earliest")))
    columns = [best.alias("best")]
    if rivals:
        noted = F.col("matched_index").isNull()
        best = F.max(
            F.when(~noted, F.struct("similarity", (-F.col("matched_index")).alias("_earliest")))
        )
        columns = [best.alias("best"), F.bool_or(noted).alias("rival")]
    return (
        dealt.mapInArrow(
            lambda batches: _compare(
                batches, threshold, cosine, earlier, chunk_rows, shared.value, rivals
            ),
            MATCH_SCHEMA,
        )
        .groupBy("duplicate_index")
        .agg(*columns)
    )


def _matches_of(best: DataFrame) -> DataFrame:
    return best.select(
        "duplicate_index",
        (-F.col("best._earliest")).alias("matched_index"),
        F.col("best.similarity").alias("similarity"),
    )


def basis_of(sample: np.ndarray, threshold: float) -> np.ndarray | None:
    """Orthonormal columns on which a pair's product, plus the product of the lengths of what is left
    of both rows, seldom reaches the threshold; None where whole vectors are cheaper.

    That sum is never below the score, so any basis gives the same result. It is taken from half of
    the sample and tried on the other half.
    """
    dimension = sample.shape[1] if sample.ndim == 2 else 0
    if len(sample) < 64:
        return None
    axes = np.linalg.svd(sample[::2], full_matrices=False)[2].T
    rows = sample[1::2]
    square = np.einsum("ij,ij->i", rows, rows)
    pairs = np.triu_indices(len(rows), 1)
    # Rough costs of a pair: its product, and where that does not decide, reading both vectors.
    cheapest, chosen = 0.75 * dimension, None
    for length in SKETCHES:
        if length > axes.shape[1]:
            break
        inside = rows @ axes[:, :length]
        rest = np.sqrt(np.maximum(square - np.einsum("ij,ij->i", inside, inside), 0))
        passing = (inside @ inside.T + np.outer(rest, rest))[pairs] >= threshold
        cost = length + passing.mean() * 50 * (dimension + 50)
        if cost < cheapest:
            cheapest, chosen = cost, np.ascontiguousarray(axes[:, :length])
    return chosen


def identical(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows whose vector an earlier row has, too, and their number.

    The key is two 64-bit hashes with different seeds; the vectors themselves are not shuffled.
    """
    hashes = F.concat_ws("-", F.hex(F.xxhash64("vec")), F.hex(F.xxhash64(F.lit(1), "vec")))
    return exact_copies(rows.select("id", hashes.alias("key")), "id")


@dataclass(frozen=True)
class Centres:
    """Leaves in the order of their pivots; those of pivot p are ``starts[p]`` to ``starts[p + 1]``."""

    leaves: np.ndarray
    pivots: np.ndarray
    starts: np.ndarray

    def stretches(self) -> Iterator[tuple[int, int, int]]:
        for pivot in range(len(self.pivots)):
            start, stop = int(self.starts[pivot]), int(self.starts[pivot + 1])
            if start < stop:
                yield pivot, start, stop

    def nearest_leaf(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A leaf for each row, the nearest one of the nearest pivot, and the cosine with it."""
        homes = np.zeros(len(matrix), dtype=np.int32)
        leans = np.zeros(len(matrix))
        lengths = np.linalg.norm(matrix, axis=1)
        nearest = (matrix @ self.pivots.T).argmax(axis=1) if len(matrix) else homes
        for pivot, start, stop in self.stretches():
            rows = np.flatnonzero(nearest == pivot)
            for begin in range(0, len(rows), ROWS_PER_PRODUCT):
                some = rows[begin : begin + ROWS_PER_PRODUCT]
                scores = matrix[some] @ self.leaves[start:stop].T
                leaf = scores.argmax(axis=1)
                homes[some] = start + leaf
                leans[some] = scores[np.arange(len(some)), leaf] / lengths[some]
        return homes, leans


def centres_of(sample: np.ndarray, pivots: int) -> Centres:
    """Two levels from rows: all are leaves, some of them pivots."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    tops = unit[:: max(1, len(unit) // max(1, pivots))][:pivots]
    owner = np.concatenate(
        [
            (unit[start : start + ROWS_PER_PRODUCT] @ tops.T).argmax(axis=1)
            for start in range(0, len(unit), ROWS_PER_PRODUCT)
        ]
    )
    order = np.argsort(owner, kind="stable")
    return Centres(unit[order], tops, np.searchsorted(owner[order], np.arange(len(tops) + 1)))


def widest_angle(cosine: float) -> float:
    """No two rows with a greater angle match."""
    return math.acos(max(-1.0, min(1.0, cosine))) + PRUNING_SLACK


def rings_of(leaves: np.ndarray, leans: np.ndarray, cosine: float) -> np.ndarray:
    """Numbers of the rings in which rows live, leaf by leaf."""
    angles = np.arccos(np.clip(leans, -1.0, 1.0))
    edges = np.array(RING_EDGES) * widest_angle(cosine)
    return leaves * RINGS + np.searchsorted(edges, angles).astype(np.int32)


@dataclass(frozen=True)
class Places:
    """Where rows live, and which angles they have there: arrays as long as the tree."""

    centres: Centres
    nearest: np.ndarray  # least and greatest angle to the leaf's centre, by ring; not finite
    farthest: np.ndarray  # where no row lives
    spans: np.ndarray  # of pivots, over all rows of their leaves
    first: np.ndarray  # number of a ring's first tile; one more entry at the end
    groups: int

    def group(self, tiles: np.ndarray) -> np.ndarray:
        return tiles * self.groups // max(1, int(self.first[-1]))

    def tile(self, rings: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self.first[rings] + mixed(ids) % (self.first[rings + 1] - self.first[rings])

    def reach(self, matrix: np.ndarray, cosine: float) -> np.ndarray:
        """Whether each row may have a match in each group."""
        found = np.zeros((len(matrix), self.groups), dtype=bool)
        lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
        widest = widest_angle(cosine)

        def angles(rows: np.ndarray | slice, centres: np.ndarray) -> np.ndarray:
            return np.arccos(np.clip(matrix[rows] @ centres.T / lengths[rows], -1.0, 1.0))

        near = angles(slice(None), self.centres.pivots) <= self.spans + widest
        for pivot, start, stop in self.centres.stretches():
            rings = np.arange(start * RINGS, stop * RINGS)
            rings = rings[np.isfinite(self.nearest[rings])]
            if not len(rings):
                continue
            lowest, highest = self.group(self.first[rings]), self.group(self.first[rings + 1] - 1)
            names = np.arange(lowest[0], highest[-1] + 1)
            # A group that is known to be in reach needs no further ring.
            rows = np.flatnonzero(near[:, pivot] & ~found[:, names].all(axis=1))
            if not len(rows):
                continue
            angle = angles(rows, self.centres.leaves[start:stop])[:, rings // RINGS - start]
            hit = (angle >= self.nearest[rings] - widest) & (angle <= self.farthest[rings] + widest)
            holds = (lowest[:, None] <= names) & (names <= highest[:, None])
            found[np.ix_(rows, names)] |= (hit.astype(np.float32) @ holds.astype(np.float32)) > 0
        return found


def places_of(
    centres: Centres, sizes: list[tuple[int, int, float, float]], tile_rows: int, groups: int
) -> Places:
    """From (ring, rows, least and greatest cosine with the leaf's centre) of rings where rows live."""
    rings = len(centres.leaves) * RINGS
    nearest, farthest = np.full(rings, np.inf), np.full(rings, -np.inf)
    tiles = np.zeros(rings + 1, dtype=np.int64)
    for ring, rows, least, greatest in sizes:
        nearest[ring] = math.acos(max(-1.0, min(1.0, greatest))) - PRUNING_SLACK
        farthest[ring] = math.acos(max(-1.0, min(1.0, least))) + PRUNING_SLACK
        tiles[ring + 1] = math.ceil(rows / tile_rows)
    spans = np.full(len(centres.pivots), -np.inf)
    radii = farthest.reshape(-1, RINGS).max(axis=1, initial=-np.inf)
    for pivot, start, stop in centres.stretches():
        lean = np.clip(centres.leaves[start:stop] @ centres.pivots[pivot], -1.0, 1.0)
        spans[pivot] = (np.arccos(lean) + radii[start:stop]).max() + PRUNING_SLACK
    first = np.cumsum(tiles)
    return Places(
        centres, nearest, farthest, spans, first, max(1, min(groups, int(first[-1])))
    )


def mixed(ids: np.ndarray) -> np.ndarray:
    """A non-negative number that looks random, from each id."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(8)).astype(np.int64)


def _sample(rows: DataFrame, tiling: Tiling, dimension: int) -> np.ndarray:
    """Rows for the leaves, at most LEAF_BYTES. Any choice gives the same result; hash order follows
    the density of the data, so a dense region gets many."""
    most = max(1, LEAF_BYTES // (4 * max(1, dimension)))
    wanted = tiling.leaves if tiling.leaves > SPREAD_LEAVES else min(most, 4 * tiling.leaves)
    return spread_out(_hashed_sample(rows, tiling.rows, wanted), tiling.leaves)


def _hashed_sample(rows: DataFrame, n_rows: int, wanted: int) -> np.ndarray:
    # The filter leaves a few times as many candidates as needed, so that their ordering stays small.
    every = max(1, n_rows // (4 * wanted))
    candidates = rows.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0)
    chosen = candidates.orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(wanted)
    return matrix_of(chosen.select("vec").toArrow().column(0))


def spread_out(sample: np.ndarray, wanted: int) -> np.ndarray:
    """The first rows for half of the places, then each time the row farthest from all chosen ones:
    small groups of rows that stand alone get a leaf, too."""
    if len(sample) <= wanted:
        return sample
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen = list(range((wanted + 1) // 2))
    closest = (unit @ unit[chosen].T).max(axis=1)
    while len(chosen) < wanted:
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, unit @ unit[chosen[-1]])
    return sample[chosen]


DEALT = (
    "low long, high long, right boolean, tile long, id long, asks boolean, offered boolean, "
    "vec array<float>"
)
DEALT_NAMES = [field.split()[0] for field in DEALT.split(", ")]


def shipped(
    flagged: DataFrame, tiling: Tiling, cosine: float, earlier: bool = True, dimension: int = 0,
    most: int | None = None,
) -> DataFrame | list[DataFrame]:
    """One row per (cell, vector), sorted by cell, side and tile.

    Rows are all of one set, each asking (``earlier``), or of two, those that ask and those that are
    offered; then only the offered ones live in the tree. Where they are more than ``most``, a list:
    the same rows in rounds of about as many, each with whole cells.
    """
    spark = flagged.sparkSession
    lives = F.lit(True) if earlier else F.col("offered")
    if tiling.groups == 1 and tiling.parts == 1:
        tiles = max(1, math.ceil(tiling.rows / tiling.tile_rows))
        right = F.lit(False) if earlier else F.col("asks")
        one = flagged.select(
            F.lit(0).cast("long").alias("low"),
            F.lit(0 if earlier else 1).cast("long").alias("high"), right.alias("right"),
            F.pmod(F.xxhash64("id"), F.lit(tiles)).alias("tile"), "id", "asks", "offered", "vec",
        )
        return one.repartition(1).sortWithinPartitions("low", "high", "right", "tile", "id")
    sample = _sample(flagged.where(lives), tiling, dimension)
    if not len(sample):
        return spark.createDataFrame([], DEALT)
    centres = spark.sparkContext.broadcast(centres_of(sample, tiling.pivots))

    @F.arrow_udf("struct<home:int,lean:double>")
    def place(vectors: pa.Array) -> pa.Array:
        leaves, leans = centres.value.nearest_leaf(matrix_of(vectors))
        homes = rings_of(leaves, leans, cosine)
        return pa.StructArray.from_arrays([pa.array(homes), pa.array(leans)], ["home", "lean"])

    routed = materialize(
        flagged.where(lives).withColumn("place", place("vec")).select(
            "id", "vec", "asks", "offered", "place.home", "place.lean"
        ),
        "routed",
    )
    # At most MAX_LEAVES * RINGS rows.
    sizes = [
        tuple(row)
        for row in routed.groupBy("home")
        .agg(F.count(F.lit(1)), F.min("lean"), F.max("lean"))
        .collect()
    ]
    places = places_of(centres.value, sizes, tiling.tile_rows, tiling.groups)
    shared = spark.sparkContext.broadcast(places)
    parts = None if earlier else (tiling.parts, tiling.part_tiles)
    every = routed.drop("lean")
    if not earlier:
        asking = flagged.where(~F.col("offered")).withColumn("home", F.lit(-1))
        every = every.unionByName(asking)

    every = every.select("id", "vec", "asks", "offered", "home")
    rounds, rows = 1, sum(size[1] for size in sizes)
    if most is not None and not earlier:
        rows = every.count()
    # No row has more copies than that.
    if most is not None and rows * max(places.groups, tiling.parts) > most:

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sent = _dealt(batches, shared.value, cosine, parts, counted=True)
            yield pa.RecordBatch.from_arrays([pa.array([sum(sent)], pa.int64())], ["copies"])

        copies = every.mapInArrow(count, "copies long").agg(F.sum("copies")).first()[0]
        rounds = max(1, math.ceil((copies or 0) / most))
    cells = places.groups * ((places.groups + 1) / 2 if earlier else tiling.parts)
    tasks = TASKS_PER_CELL * cells if rounds == 1 else TASKS_PER_ROUND_CELL * cells / rounds

    def dealt(part: int) -> DataFrame:
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _dealt(batches, shared.value, cosine, parts, (part, rounds))

        return (
            every.mapInArrow(deal, DEALT)
            .repartition(max(1, min(MAX_TASKS, math.ceil(tasks))), "low", "high")
            .sortWithinPartitions("low", "high", "right", "tile", "id")
        )

    return dealt(0) if rounds == 1 else [dealt(part) for part in range(rounds)]


def round_of(low: np.ndarray, high: np.ndarray, rounds: int) -> np.ndarray:
    """The round of each cell: a row's cells with neighbouring groups are in different ones."""
    return (low + high) % rounds


def _dealt(
    batches: Iterator[pa.RecordBatch], places: Places, cosine: float,
    asking: tuple[int, int] | None, turn: tuple[int, int] = (0, 1), counted: bool = False,
) -> Iterator[pa.RecordBatch]:
    """Rows once for each of their cells: of their own group and a group in their reach, or with
    ``asking`` (parts of the asking rows, and tiles of each), of such a part and a group.

    Of all rounds' cells only those of one, ``turn``; with ``counted`` just the numbers of rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_REACH):
            some = batch.slice(start, ROWS_PER_REACH)
            ids, asks, homes = (
                some.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 4)
            )
            matrix = matrix_of(some.column(1))
            guest = homes < 0
            tiles = np.zeros(len(ids), dtype=np.int64)
            tiles[~guest] = places.tile(homes[~guest], ids[~guest])
            own = places.group(tiles)
            if asking is None:
                rows, partners = np.nonzero(places.reach(matrix, cosine))
                low, high = np.minimum(own[rows], partners), np.maximum(own[rows], partners)
                right = own[rows] > partners
            else:
                parts, part_tiles = asking
                askers, groups = np.nonzero(places.reach(matrix[guest], cosine))
                askers = np.flatnonzero(guest)[askers]
                hosts = np.repeat(np.flatnonzero(~guest), parts)
                every = np.tile(np.arange(parts), int((~guest).sum()))
                rows = np.concatenate([askers, hosts])
                low = np.concatenate([mixed(ids[askers]) % parts, every])
                high = parts + np.concatenate([groups, own[hosts]])
                right = guest[rows]
                tiles[guest] = mixed(ids[guest]) // parts % part_tiles
            if counted:
                yield len(rows)
                continue
            now = round_of(low, high, turn[1]) == turn[0]
            rows, low, high, right = rows[now], low[now], high[now], right[now]
            step = max(1, BATCH_BYTES // (4 * max(1, matrix.shape[1])))
            for begin in range(0, len(rows), step):
                part = slice(begin, begin + step)
                at = pa.array(rows[part])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(low[part], pa.int64()), pa.array(high[part], pa.int64()),
                        pa.array(right[part]), pa.array(tiles[rows[part]]),
                        *(some.column(i).take(at) for i in (0, 2, 3, 1)),
                    ],
                    DEALT_NAMES,
                )


def matrix_of(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(vectors), -1) if len(vectors) else np.empty((0, 0))


_FOUND = ("best", "partner", "rival")


class _Rows:
    """Rows in order of id, in tiles with centres and radii, and the best match of each so far.

    ``bounds`` are vectors in single precision whose products with those of other rows are, but for
    the slack, at least the scores, and without a basis equal to them. ``rival`` says of an offered
    row whether a later row is at least as close to it as a copy of its own would be.
    """

    def __init__(self, parts: list[tuple], basis: np.ndarray | None) -> None:
        tiles, ids, asks, offered, vectors = (
            np.concatenate(column) if len(parts) > 1 else column[0]
            for column in zip(*parts, strict=True)
        )
        starts = np.flatnonzero(np.append(True, tiles[1:] != tiles[:-1]))
        self.sizes = np.diff(np.append(starts, len(ids)))
        self.centres = np.empty((len(starts), vectors.shape[1]))
        self.radii = np.empty(len(starts))
        square = np.empty(len(ids))
        bounds = vectors if basis is None else np.empty((len(ids), basis.shape[1] + 1), np.float32)
        for first, last in _runs(self.sizes, ROWS_PER_CAST):
            begin, end = starts[first], starts[last - 1] + self.sizes[last - 1]
            wide = vectors[begin:end].astype(np.float64)
            square[begin:end] = np.einsum("ij,ij->i", wide, wide)
            if basis is not None:
                inside = wide @ basis
                rest = square[begin:end] - np.einsum("ij,ij->i", inside, inside)
                bounds[begin:end, :-1], bounds[begin:end, -1] = inside, np.sqrt(np.maximum(rest, 0))
            wide /= np.sqrt(square[begin:end, None])
            at = starts[first:last] - begin
            centres = np.add.reduceat(wide, at)
            lengths = np.linalg.norm(centres, axis=1, keepdims=True)
            centres = np.where(lengths > 1e-9, centres / np.maximum(lengths, 1e-9), wide[at])
            lean = np.einsum("ij,ij->i", wide, np.repeat(centres, self.sizes[first:last], axis=0))
            self.centres[first:last] = centres
            least = np.clip(np.minimum.reduceat(lean, at), -1, 1)
            self.radii[first:last] = np.arccos(least) + PRUNING_SLACK
        self.longest = math.sqrt(square.max(initial=0.0))
        if not 1e-12 < self.longest < 1e15:  # products would leave the range of single precision
            bounds = bounds.astype(np.float64)
        self.exact = basis is None
        order = np.argsort(ids, kind="stable")
        self.tiles = np.repeat(np.arange(len(starts)), self.sizes)[order]
        self.ids, self.asks, self.offered = ids[order], asks[order], offered[order]
        self.vectors, self.square = vectors[order], square[order]
        self.bounds = self.vectors if bounds is vectors else bounds[order]
        self.best = np.full(len(ids), -np.inf)
        self.partner = np.zeros(len(ids), dtype=np.int64)
        self.rival = np.zeros(len(ids), dtype=bool)

    def part(self, chosen: np.ndarray) -> _Rows:
        """The chosen rows; what is found for them is handed back by ``put``."""
        if chosen.all():
            return self
        some = copy.copy(self)
        for name in (*_FOUND, "tiles", "ids", "asks", "offered", "vectors", "square"):
            setattr(some, name, getattr(self, name)[chosen])
        some.bounds = some.vectors if self.bounds is self.vectors else self.bounds[chosen]
        return some

    def put(self, some: _Rows, chosen: np.ndarray, names: tuple[str, ...] = _FOUND) -> None:
        if some is not self:
            for name in names:
                getattr(self, name)[chosen] = getattr(some, name)

    def reach(self, others: _Rows, cosine: float) -> np.ndarray:
        """Which tiles may hold a match of which tiles of others."""
        angles = np.arccos(np.clip(self.centres @ others.centres.T, -1.0, 1.0))
        angles -= self.radii[:, None] + others.radii
        return np.cos(np.maximum(0.0, angles)) >= cosine

    def take(self, rows: np.ndarray, partners: np.ndarray, scores: np.ndarray) -> None:
        """Better matches win, and of equal ones the earlier."""
        known, at = self.best[rows], self.partner[rows]
        better = (scores > known + TIE) | ((scores >= known - TIE) & (partners < at))
        rows = rows[better]
        self.best[rows], self.partner[rows] = scores[better], partners[better]


def _runs(sizes: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """Consecutive tiles with at least so many rows together."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        base = ends[first - 1] if first else 0
        last = min(len(sizes), int(np.searchsorted(ends, base + rows)) + 1)
        yield first, last
        first = last


def _meet(
    one: _Rows, two: _Rows, threshold: float, earlier: bool, chunk_rows: int, rivals: bool = False
) -> None:
    """Update the best matches of both sides (of one, if they are the same) from their products."""
    _ask(one, two, threshold, earlier, chunk_rows, rivals)
    if one is not two:
        _ask(two, one, threshold, earlier, chunk_rows, rivals)


def _ask(
    asking: _Rows, offered: _Rows, threshold: float, earlier: bool, chunk_rows: int, rivals: bool
) -> None:
    """Rows on both sides are in order of id, so with ``earlier`` few pairs are multiplied in vain."""
    if not asking.asks.any() or not offered.offered.any():
        return
    one, two = asking.part(asking.asks), offered.part(offered.offered)
    slack = 2**-23 * (one.bounds.shape[1] + 8) * one.longest * two.longest + 10 * TIE
    for start in range(0, len(one.ids), chunk_rows):
        ids = one.ids[start : start + chunk_rows]
        last = int(np.searchsorted(two.ids, ids[-1])) if earlier else len(two.ids)
        for begin in range(0, last, COLUMNS_PER_PRODUCT):
            others = two.ids[begin : min(last, begin + COLUMNS_PER_PRODUCT)]
            end = begin + len(others)
            bounds = one.bounds[start : start + chunk_rows] @ two.bounds[begin:end].T
            if earlier and others[-1] >= ids[0]:
                bounds[others >= ids[:, None]] = -np.inf
            _improve(one, start, two, begin, bounds, threshold, slack)
            if rivals:
                _note_rivals(one, start, two, begin, bounds, slack)
    asking.put(one, asking.asks, ("best", "partner"))
    offered.put(two, offered.offered, ("rival",))


def _improve(
    one: _Rows, start: int, two: _Rows, begin: int, bounds: np.ndarray, threshold: float,
    slack: float,
) -> None:
    """Only rows that may get a better match go on, with the columns that may be it; mostly few."""
    least = np.maximum(threshold, one.best[start : start + len(bounds)]) - slack
    top = bounds.max(axis=1)
    near = np.flatnonzero(top >= least)
    if not near.size:
        return
    least = least[near]
    if one.exact:
        least = np.maximum(least, top[near] - slack)
    close = bounds[near] >= least[:, None]
    rows = start + near
    if np.count_nonzero(close) > close.size // DENSE:
        scores = _products(one, rows, two, np.arange(begin, begin + bounds.shape[1]))
        scores[~close] = -np.inf
        top = scores.max(axis=1)
        # ids ascend, so the first score within the tie width is the earliest row.
        match = (scores >= top[:, None] - TIE).argmax(axis=1)
    else:
        at, columns = np.nonzero(close)
        scores = _scores(one, rows[at], two, begin + columns)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        top = np.maximum.reduceat(scores, first)
        good = np.flatnonzero(scores >= top[at] - TIE)
        match = columns[good[np.unique(at[good], return_index=True)[1]]]
    hit = top >= threshold
    one.take(rows[hit], two.ids[begin + match[hit]], top[hit])


def _note_rivals(
    one: _Rows, start: int, two: _Rows, begin: int, bounds: np.ndarray, slack: float
) -> None:
    own = two.square[begin : begin + bounds.shape[1]]
    open_ = ~two.rival[begin : begin + bounds.shape[1]]
    near = np.flatnonzero(open_ & (bounds.max(axis=0) >= own - slack))
    if not near.size:
        return
    own = own[near]
    close = bounds[:, near] >= own - slack
    if np.count_nonzero(close) > close.size // DENSE:
        scores = _products(one, np.arange(start, start + len(bounds)), two, begin + near)
        scores[~close] = -np.inf
        two.rival[begin + near[scores.max(axis=0) >= own - TIE]] = True
    else:
        at, columns = np.nonzero(close)
        scores = _scores(one, start + at, two, begin + near[columns])
        two.rival[begin + near[columns[scores >= own[columns] - TIE]]] = True


def _products(one: _Rows, rows: np.ndarray, two: _Rows, columns: np.ndarray) -> np.ndarray:
    return one.vectors[rows].astype(np.float64) @ two.vectors[columns].astype(np.float64).T


def _scores(one: _Rows, rows: np.ndarray, two: _Rows, columns: np.ndarray) -> np.ndarray:
    """Of pairs, in double precision."""
    scores = np.empty(len(rows))
    step = max(1, BATCH_BYTES // (8 * max(1, one.vectors.shape[1])))
    for begin in range(0, len(rows), step):
        part = slice(begin, begin + step)
        left = one.vectors[rows[part]].astype(np.float64)
        scores[part] = np.einsum("ij,ij->i", left, two.vectors[columns[part]].astype(np.float64))
    return scores


def _compare(
    batches: Iterator[pa.RecordBatch], threshold: float, cosine: float, earlier: bool,
    chunk_rows: int, basis: np.ndarray | None = None, rivals: bool = False,
) -> Iterator[pa.RecordBatch]:
    """The cells of a sorted partition: the left group is held, the right one streams past.

    Small tiles cost no loop of their own: neighbouring ones are multiplied together with all held
    tiles that any of them may reach.
    """

    def found(rows: _Rows) -> Iterator[pa.RecordBatch]:
        hits = np.flatnonzero(rows.best >= threshold)
        noted = np.flatnonzero(rows.rival)
        names = [name for name, _ in _MATCH_FIELDS]
        scores = np.round(rows.best[hits], SCORE_DIGITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.ids[hits]), pa.array(rows.partner[hits]), pa.array(scores)], names
        )
        if len(noted):
            nulls = [pa.nulls(len(noted), kind) for _, kind in _MATCH_FIELDS[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(rows.ids[noted]), *nulls], names)

    def meet(stream: _Rows, held: _Rows) -> None:
        reach = stream.reach(held, cosine)
        if reach.all():
            return _meet(stream, held, threshold, earlier, chunk_rows, rivals)
        for first, last in _runs(stream.sizes, chunk_rows):
            tiles = reach[first:last].any(axis=0)
            if not tiles.any():
                continue
            mine = (stream.tiles >= first) & (stream.tiles < last)
            theirs = tiles[held.tiles]
            one, two = stream.part(mine), held.part(theirs)
            if stream is held:
                # Each row is in one run, which asks; the offered side gets its rivals only.
                _ask(one, two, threshold, earlier, chunk_rows, rivals)
                held.rival[theirs] |= two.rival
                held.best[mine], held.partner[mine] = one.best, one.partner
            else:
                _meet(one, two, threshold, earlier, chunk_rows, rivals)
                stream.put(one, mine)
                held.put(two, theirs)

    cell, parts, held = None, [], None

    def finish() -> Iterator[pa.RecordBatch]:
        rows = held or (_Rows(parts, basis) if parts else None)
        if rows is None:
            return
        if cell[0] == cell[1]:
            meet(rows, rows)
        yield from found(rows)

    for name, right, piece in _pieces(batches):
        if name != cell:
            if cell is not None:
                yield from finish()
            cell, parts, held = name, [], None
        if not right:
            parts.append(piece)
            continue
        if held is None and parts:
            held, parts = _Rows(parts, basis), []
        if held is not None:
            stream = _Rows([piece], basis)
            # Pairs within a group are left to other cells, or do not count.
            meet(stream, held)
            yield from found(stream)
    if cell is not None:
        yield from finish()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, tuple]]:
    """The rows of each cell and side of a sorted partition, as they lie in the batches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        low, high, right, tiles, ids, asks, offered = (
            batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)
        )
        vectors = batch.column(7).flatten().to_numpy(zero_copy_only=False)
        vectors = vectors.astype(np.float32, copy=False).reshape(batch.num_rows, -1)
        changes = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (right[1:] != right[:-1])
        edges = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            part = slice(start, end)
            columns = (tiles[part], ids[part], asks[part], offered[part], vectors[part])
            yield (int(low[start]), int(high[start])), bool(right[start]), columns
