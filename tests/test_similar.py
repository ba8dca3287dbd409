"""The similarity join against a loop over the full matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom.operators.anchors import resolve_anchors
from chatloom.operators.removal import match_log, removal_details
from chatloom.operators import similar
from chatloom.operators.similar import (
    centres_of,
    nearest_between,
    nearest_earlier,
    places_of,
    plan_tiling,
    rings_of,
    shipped,
)
from chatloom.operators.vectors import (
    attach_vectors,
    normalize,
    profile_vectors,
    require_vectors,
)
from chatloom.scratch import materialize


def frame(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    rows = [(int(i), [float(x) for x in row]) for i, row in zip(ids, matrix)]
    return spark.createDataFrame(rows, "row_index long, embedding array<float>").repartition(3)


def unit(matrix):
    return (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)).astype(np.float32)


def expected(matrix, threshold, ids=None):
    ids = np.arange(len(matrix)) if ids is None else np.asarray(ids)
    order = np.argsort(ids)
    wide, ids = matrix[order].astype(np.float64), ids[order]
    found, anchors = {}, {}
    for i in range(1, len(wide)):
        scores = np.round(wide[:i] @ wide[i], 10)
        j = int(scores.argmax())
        if scores[j] >= threshold:
            found[int(ids[i])] = (int(ids[j]), round(float(scores[j]), 6))
            anchors[int(ids[i])] = anchors.get(int(ids[j]), int(ids[j]))
    return found, anchors


def computed(vectors, threshold, **spread):
    profile = profile_vectors(vectors)
    require_vectors(profile)
    matches = materialize(
        nearest_earlier(
            normalize(vectors, profile), profile.after_normalization(), threshold, **spread
        ),
        "matches",
    )
    rows = match_log(resolve_anchors(matches)).collect()
    assert len({r.duplicate_index for r in rows}) == len(rows)
    return (
        {r.duplicate_index: (r.matched_index, r.similarity) for r in rows},
        {r.duplicate_index: r.retained_index for r in rows},
    )


def clustered(rows=400, dimension=8, seed=3):
    """A third of the rows in one tight cluster, some loose clusters, some noise."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimension))
    label = np.where(rng.random(rows) < 0.34, 0, rng.integers(1, 12, rows))
    spread = np.where(label == 0, 0.02, 0.3)[:, None]
    return unit(centres[label] + spread * rng.normal(size=(rows, dimension)))


@pytest.mark.parametrize("threshold", [0.3, 0.92, 0.999])
@pytest.mark.parametrize(
    "spread", [{}, {"tile_rows": 9}, {"tile_rows": 50, "chunk_rows": 7}]
)
def test_result_does_not_depend_on_how_work_is_spread(spark, threshold, spread):
    matrix = clustered()
    vectors = materialize(frame(spark, matrix), "vectors")
    assert computed(vectors, threshold, **spread) == expected(matrix, threshold)


def test_indexes_need_not_be_dense(spark):
    matrix = clustered(60)
    ids = np.random.default_rng(0).permutation(10_000)[:60]
    vectors = frame(spark, matrix, ids)
    assert computed(vectors, 0.9, tile_rows=8) == expected(matrix, 0.9, ids)


def test_many_identical_vectors(spark):
    rng = np.random.default_rng(2)
    base = clustered(40)
    matrix = base[np.where(rng.random(300) < 0.4, 0, rng.integers(0, 40, 300))]
    for spread in ({}, {"tile_rows": 5}):
        assert computed(frame(spark, matrix), 0.9, **spread) == expected(matrix, 0.9)


def test_vectors_close_to_unit_length_are_used_as_they_are(spark):
    rng = np.random.default_rng(4)
    matrix = (clustered(120) * rng.uniform(0.9992, 1.0008, (120, 1))).astype(np.float32)
    matrix[50:60] = matrix[40:50]
    vectors = frame(spark, matrix)
    assert not profile_vectors(vectors).off_unit
    for spread in ({}, {"tile_rows": 7}):
        assert computed(vectors, 0.95, **spread) == expected(matrix, 0.95)


def test_one_long_vector_normalizes_all(spark):
    matrix = clustered(60)
    stretched = matrix.copy()
    stretched[7] *= 3
    vectors = frame(spark, stretched)
    assert profile_vectors(vectors).off_unit
    found, anchors = computed(vectors, 0.9)
    wanted, wanted_anchors = expected(matrix, 0.9)
    assert anchors == wanted_anchors and found.keys() == wanted.keys()
    assert all(abs(found[i][1] - wanted[i][1]) < 2e-6 for i in found)


def test_three_vectors(spark):
    matrix = unit(np.array([[1.0, 0.0], [0.97, 0.2], [0.0, 1.0]]))
    found, anchors = computed(frame(spark, matrix), 0.95, tile_rows=2)
    assert anchors == {1: 0} and found[1][1] == pytest.approx(0.979398, abs=2e-6)


def test_removed_rows_remove_later_rows(spark):
    angles = np.radians([0, 20, 40, 60, 200])
    matrix = unit(np.stack([np.cos(angles), np.sin(angles)], axis=1))
    found, anchors = computed(frame(spark, matrix), 0.93)
    assert {i: m for i, (m, _) in found.items()} == {1: 0, 2: 1, 3: 2}
    assert anchors == {1: 0, 2: 0, 3: 0}


def test_long_chain_and_hot_anchor(spark):
    rows = [(i, i - 1, 0.95) for i in range(1, 130)] + [(i, 0, 0.95) for i in range(200, 500)]
    matches = spark.createDataFrame(
        rows, "duplicate_index long, matched_index long, similarity double"
    )
    for hot_rows in (5, 10**6):
        anchored = resolve_anchors(matches, hot_rows=hot_rows).collect()
        assert len(anchored) == len(rows) and {r.retained_index for r in anchored} == {0}
        assert {(r.duplicate_index, r.matched_index) for r in anchored} == {r[:2] for r in rows}


def test_no_rows_and_one_row(spark):
    assert computed(frame(spark, np.empty((0, 2))).limit(0), 0.9) == ({}, {})
    assert computed(frame(spark, np.array([[1.0, 0.0]])), 0.9) == ({}, {})


@pytest.mark.parametrize(
    "bad, message",
    [
        ([[1.0, 0.0], [0.0, 0.0]], "zero"),
        ([[1.0, 0.0], [1.0]], "length"),
        ([[1.0, 0.0], [float("nan"), 0.0]], "NaN"),
        ([[1.0, 0.0], [float("inf"), 0.0]], "infinite"),
    ],
)
def test_bad_vectors(spark, bad, message):
    with pytest.raises(ValueError, match=message):
        require_vectors(profile_vectors(frame(spark, bad)))


def test_supplied_vectors_must_match_the_records(spark):
    vectors = frame(spark, np.eye(3))
    records = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "row_index long, t string")
    assert attach_vectors(records, vectors, "row_index").count() == 3
    with pytest.raises(ValueError, match="3 != 2"):
        attach_vectors(records.limit(2), vectors, "row_index")
    other = vectors.withColumn("row_index", F.col("row_index") + 1)
    with pytest.raises(ValueError, match="NULL"):
        require_vectors(profile_vectors(attach_vectors(records, other, "row_index")))


def test_details_with_hot_texts(spark):
    log = spark.createDataFrame(
        [(i, i - 1, 0, 0.95, "semantic_duplicate") for i in range(1, 40)],
        "duplicate_index long, matched_index long, retained_index long, similarity double,"
        " reason string",
    )
    records = spark.range(50).select(
        F.col("id").alias("row_index"),
        F.concat(F.lit("t"), "id").alias("text"),
        F.concat(F.lit("r"), "id").alias("record"),
    )
    for hot_rows in (5, 10**6):
        rows = removal_details(log, 39, records, hot_rows=hot_rows).collect()
        assert len(rows) == 39
        for r in rows:
            i = r.duplicate_index
            assert (r.duplicate_text, r.matched_text, r.retained_text, r.record) == (
                f"t{i}", f"t{i - 1}", "t0", f"r{i}"
            )


def test_twins_of_unequal_length(spark):
    v = unit(np.array([[0.6, 0.8]]))[0]
    matrix = np.stack([v * np.float32(1 + 4e-7), v, v, v * np.float32(1 + 8e-7), v])
    for threshold in (0.9, 1.0):
        for tile_rows in (None, 1):
            assert computed(frame(spark, matrix), threshold, tile_rows=tile_rows) == expected(
                matrix, threshold
            )


def test_matches_between_two_sets(spark):
    matrix = clustered(200)
    asking, offered = frame(spark, matrix[:50]), frame(spark, matrix[50:])
    both = profile_vectors(asking.unionByName(offered))
    scores = np.round(matrix[50:].astype(np.float64) @ matrix[:50].astype(np.float64).T, 10)
    wanted = {
        i: (int(scores[:, i].argmax()), round(float(scores[:, i].max()), 6))
        for i in range(50)
        if scores[:, i].max() >= 0.9
    }
    for tile_rows in (None, 11):
        found = nearest_between(asking, offered, both, 0.9, tile_rows=tile_rows).collect()
        assert {r.duplicate_index: (r.matched_index, round(r.similarity, 6)) for r in found} == wanted


def test_copies_per_vector_follow_the_root_of_the_cells(spark):
    vectors = materialize(frame(spark, unit(np.random.default_rng(1).normal(size=(4000, 16)))), "v")
    tiling = plan_tiling(4000, 16, spark.sparkContext.defaultParallelism)
    flagged = vectors.select(
        F.col("row_index").alias("id"), F.col("embedding").alias("vec"),
        F.lit(True).alias("asks"), F.lit(True).alias("offered"),
    )
    copies = shipped(flagged, tiling, 0.1).groupBy("id").count().agg(F.max("count")).first()[0]
    tasks = 4 * spark.sparkContext.defaultParallelism
    assert copies <= 2 * tasks**0.5


def test_tiles_are_bounded():
    for rows in (1, 10**4, 10**7, 10**11):
        for cores in (8, 8000):
            tiling = plan_tiling(rows, 768, cores)
            assert tiling.tile_rows * 768 * 4 <= 32 << 20
            assert 1 <= tiling.pivots <= 2048 and tiling.pivots * 768 * 4 <= 16 << 20
            assert rows * 768 * 4 / tiling.groups <= 2 * (128 << 20)


def test_every_close_pair_meets_in_a_cell():
    rng = np.random.default_rng(0)
    for trial in range(60):
        dimension, rows = int(rng.integers(2, 12)), int(rng.integers(20, 120))
        matrix = rng.normal(size=(rows, dimension)) + rng.normal(size=dimension) * (trial % 4)
        matrix = unit(matrix).astype(np.float64) * rng.uniform(0.9995, 1.0005, (rows, 1))
        threshold = float(rng.choice([0.05, 0.3, 0.7, 0.92, 0.99, 0.9999, 1.0]))
        sample = matrix[rng.choice(rows, int(rng.integers(2, 20)), replace=False)]
        centres = centres_of(sample, int(rng.integers(1, 6)))
        leaves, leans = centres.nearest_leaf(matrix)
        longest = float(np.linalg.norm(matrix, axis=1).max())
        cosine = min(1.0, threshold / longest**2) - 1e-6
        homes = rings_of(leaves, leans, cosine)
        # Some rings hold several tiles, some groups several rings.
        sizes = [
            (int(ring), int(mine.sum()), float(leans[mine].min()), float(leans[mine].max()))
            for ring in np.unique(homes)
            for mine in [homes == ring]
        ]
        places = places_of(centres, sizes, int(rng.integers(1, 30)), int(rng.integers(1, 40)))
        groups = places.group(places.tile(homes, np.arange(rows)))
        assert groups.min() >= 0 and groups.max() < places.groups
        reach = places.reach(matrix, cosine)
        assert reach[np.arange(rows), groups].all()
        for i, j in zip(*np.nonzero(matrix @ matrix.T >= threshold)):
            assert reach[i, groups[j]]


def test_the_plan_of_a_billion_rows_is_as_long_as_the_tree():
    tiling = plan_tiling(10**9, 512, 4000)
    assert tiling.leaves * 512 * 4 <= similar.LEAF_BYTES and tiling.groups >= 15_000
    rng = np.random.default_rng(5)
    centres = centres_of(rng.normal(size=(2000, 16)), 45)
    sizes = [(leaf * similar.RINGS, 500_000, 0.7, 1.0) for leaf in range(2000)]
    places = places_of(centres, sizes, tiling.tile_rows, tiling.groups)
    lengths = [len(part) for part in (places.nearest, places.spans, places.first)]
    assert lengths == [8000, 45, 8001] and places.groups == tiling.groups


def test_rows_in_clusters_are_sent_to_few_cells(spark):
    """Copies of a row follow the clusters in its reach, not the number of groups."""
    rng = np.random.default_rng(6)
    centres = unit(rng.normal(size=(30, 24)))
    most = {}
    for rows in (1500, 6000):
        matrix = unit(centres[rng.integers(0, 30, rows)] + 0.01 * rng.normal(size=(rows, 24)))
        vectors = materialize(frame(spark, matrix), "v")
        flagged = vectors.select(
            F.col("row_index").alias("id"), F.col("embedding").alias("vec"),
            F.lit(True).alias("asks"), F.lit(True).alias("offered"),
        )
        tiling = plan_tiling(rows, 24, 2000, requested_rows=rows // 100)
        assert tiling.groups >= 40
        copies = shipped(flagged, tiling, 0.92).groupBy("id").count()
        most[rows] = copies.agg(F.avg("count")).first()[0]
    assert most[6000] <= 1.5 * most[1500] and most[6000] < 12


def counted_products(monkeypatch, dealt, threshold):
    """How many pairs of rows are multiplied, by side."""
    products = []
    meet = similar._meet

    def counting(one, two, *rest):
        products.append((bool(one.asks.any()), bool(two.asks.any()), len(one.ids) * len(two.ids)))
        return meet(one, two, *rest)

    monkeypatch.setattr(similar, "_meet", counting)
    for row in dealt.select("low", "high").distinct().collect():
        cell = dealt.where((F.col("low") == row.low) & (F.col("high") == row.high))
        ordered = cell.orderBy("low", "high", "right", "tile", "id").toArrow()
        list(similar._compare(iter(ordered.to_batches()), threshold, threshold - 1e-6, False, 64))
    return products


def test_two_sets_are_multiplied_once_and_nothing_else(spark, monkeypatch):
    matrix = clustered(700, dimension=6, seed=8)
    sides = [
        frame(spark, part, range(start, start + len(part))).select(
            F.col("row_index").alias("id"), F.col("embedding").alias("vec"),
            F.lit(asks).alias("asks"), F.lit(not asks).alias("offered"),
        )
        for part, start, asks in ((matrix[:100], 0, True), (matrix[100:], 100, False))
    ]
    both = materialize(sides[0].unionByName(sides[1]), "both")
    tiling = plan_tiling(600, 6, 4, 40, asking=100)
    assert tiling.groups > 1 and tiling.parts > 1
    # Nothing can be ruled out at this cosine, so each pair is multiplied exactly once.
    every = counted_products(monkeypatch, shipped(both, tiling, -1.0, False).cache(), 0.9)
    assert all(one != two for one, two, _ in every)
    assert sum(size for *_, size in every) <= 100 * 600
    monkeypatch.undo()
    wide = counted_products(monkeypatch, shipped(both, tiling, -1.0, False).cache(), -1.0)
    assert sum(size for *_, size in wide) == 100 * 600
    monkeypatch.undo()
    close = counted_products(monkeypatch, shipped(both, tiling, 0.99, False).cache(), 0.99)
    assert sum(size for *_, size in close) < 0.6 * 100 * 600


@pytest.mark.parametrize("asking, offered", [(0, 30), (30, 0), (1, 30), (30, 1), (3, 197)])
def test_sets_of_unequal_size(spark, asking, offered):
    matrix = clustered(asking + offered, seed=9)
    sides = frame(spark, matrix[:asking].reshape(-1, 8)), frame(spark, matrix[asking:].reshape(-1, 8))
    profile = profile_vectors(sides[0].unionByName(sides[1]))
    scores = np.round(matrix[asking:].astype(np.float64) @ matrix[:asking].astype(np.float64).T, 10)
    wanted = {
        i: int(scores[:, i].argmax())
        for i in range(asking)
        if offered and scores[:, i].max() >= 0.8
    }
    for tile_rows in (None, 2):
        found = nearest_between(*sides, profile, 0.8, tile_rows=tile_rows).collect()
        assert {r.duplicate_index: r.matched_index for r in found} == wanted


def cell_of(matrix, tile_rows):
    """One cell of a group with itself, in tiles of some rows."""
    rows = len(matrix)
    flat = pa.array(matrix.astype(np.float32).ravel())
    columns = [
        np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=bool),
        np.arange(rows) // tile_rows, np.random.default_rng(1).permutation(rows),
        np.ones(rows, dtype=bool), np.ones(rows, dtype=bool),
    ]
    vectors = pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * matrix.shape[1], flat)
    batch = pa.RecordBatch.from_arrays([*map(pa.array, columns), vectors], similar.DEALT_NAMES)
    return columns[4], batch


def test_small_tiles_cost_no_product_of_their_own(monkeypatch):
    """products follow the rows of a cell, not the square of its tiles."""
    matrix = unit(np.random.default_rng(12).normal(size=(960, 8)))
    ids, batch = cell_of(matrix, 4)
    calls = []
    meet = similar._meet
    monkeypatch.setattr(similar, "_meet", lambda *rest: calls.append(1) or meet(*rest))
    found = pa.Table.from_batches(
        similar._compare(iter([batch.slice(0, 333), batch.slice(333)]), 0.6, 0.6, True, 64)
    ).to_pylist()
    assert len(calls) <= 960 / 64 + 1
    wanted, _ = expected(matrix, 0.6, ids)
    assert {r["duplicate_index"]: (r["matched_index"], round(r["similarity"], 6)) for r in found} == wanted


def test_copies_take_part_once(spark, monkeypatch):
    """rows with the vector of an earlier one are sent to no cell."""
    base = unit(np.random.default_rng(13).normal(size=(60, 6)))
    matrix = base[np.random.default_rng(14).integers(0, 60, 400)]
    sent = []
    ship = similar.shipped

    def counting(flagged, *rest):
        sent.append(flagged.count())
        return ship(flagged, *rest)

    monkeypatch.setattr(similar, "shipped", counting)
    assert computed(frame(spark, matrix), 0.7, tile_rows=5) == expected(matrix, 0.7)
    assert sent == [len(np.unique(matrix, axis=0))]


@pytest.mark.parametrize("threshold", [0.5, 0.9995, 1.0])
def test_copies_with_rivals(spark, threshold):
    """Another row may score more with a copy than its own first one: it is a little longer."""
    rng = np.random.default_rng(15)
    base = unit(rng.normal(size=(25, 5)))
    lengths = np.array([0.9995, 1.0, 1.0004], dtype=np.float32)
    matrix = base[rng.integers(0, 25, 300)] * lengths[rng.integers(0, 3, 300)][:, None]
    matrix[::7] = base[rng.integers(0, 25, len(matrix[::7]))]
    assert not profile_vectors(frame(spark, matrix)).off_unit
    assert computed(frame(spark, matrix), threshold, tile_rows=4) == expected(matrix, threshold)


def test_long_vectors_are_ruled_out_by_a_part(monkeypatch):
    """far pairs are told by a product of fewer columns, with the same matches."""
    rng = np.random.default_rng(16)
    matrix = unit(np.sign(rng.normal(size=(900, 256))))
    matrix[500:520] = unit(matrix[500:520] + 0.01 * rng.normal(size=(20, 256)))
    matrix[100:120] = unit(matrix[500:520] + 0.01 * rng.normal(size=(20, 256)))
    basis = similar.basis_of(matrix.astype(np.float64), 0.92)
    assert basis.shape[1] <= 96
    assert similar.basis_of(matrix.astype(np.float64), 0.05) is None
    ids, batch = cell_of(matrix, 50)
    wanted, _ = expected(matrix, 0.92, ids)
    assert len(wanted) == 20
    # All pairs of two rows of a dense cluster pass: they are multiplied as a block.
    close = unit(matrix[0] + 0.02 * rng.normal(size=(300, 256)))
    close_ids, close_batch = cell_of(close, 50)
    for some, right in ((batch, wanted), (close_batch, expected(close, 0.92, close_ids)[0])):
        rows = pa.Table.from_batches(
            similar._compare(iter([some]), 0.92, 0.92 - 1e-6, True, 64, basis)
        ).to_pylist()
        assert {r["duplicate_index"]: (r["matched_index"], round(r["similarity"], 6)) for r in rows} == right


@pytest.mark.parametrize("threshold", [0.05, 0.9])
def test_cells_in_rounds(spark, monkeypatch, threshold):
    """where nothing can be ruled out, a round sends each row to a few of its cells."""
    monkeypatch.setattr(similar, "ROUND_BYTES", 1)
    monkeypatch.setattr(similar, "ROUND_COPIES", 3)
    sent = []
    ship = similar.shipped

    def counting(flagged, *rest):
        rounds = ship(flagged, *rest)
        whole = ship(flagged, *rest[:4]).select("low", "high", "id", "right").collect()
        parts = [part.select("low", "high", "id", "right").collect() for part in rounds]
        assert sorted(sum(parts, [])) == sorted(whole)
        cells = [{(row.low, row.high) for row in part} for part in parts]
        assert sum(map(len, cells)) == len(set().union(*cells))
        sent.append((flagged.count(), [len(part) for part in parts]))
        return rounds

    monkeypatch.setattr(similar, "shipped", counting)
    rng = np.random.default_rng(21)
    matrix = unit(np.sign(rng.normal(size=(300, 48))))
    matrix[200:240] = unit(matrix[:40] + 0.01 * rng.normal(size=(40, 48)))
    # Copies with rivals: a second comparison, in rounds as well.
    matrix[250:260] = matrix[20:30]
    matrix[260:270] = matrix[20:30] * np.float32(1.0004)
    assert computed(frame(spark, matrix), threshold, tile_rows=10) == expected(matrix, threshold)
    assert len(sent) == 2
    for rows, copies in sent:
        assert len(copies) >= 2 and max(copies) <= 1.5 * 3 * rows
