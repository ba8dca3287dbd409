"""The operators with Python tasks against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import gzip
import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatloom.llm import (
    op1_warc,
    op2_token_counts,
    op3_jaccard_join,
    op5_neighbours,
    op6_toxicity,
    op7_packing,
    op8_resharding,
    queries,
)
from chatloom.llm.components import connected_components
from chatloom.llm.word_pieces import encoder

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# Tokens


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t.,'aÉß")), max_size=60))
def test_ids_equal_the_tokenizers(text):
    plain = encoder()._tokenizer.encode(text, add_special_tokens=False).ids
    assert cached([text]) == [plain]


def cached(texts):
    found = []
    for ids, ends in encoder().ids(pa.array(texts, pa.string())):
        found += [part.tolist() for part in np.split(ids, ends)[:-1]]
    return found


def test_ids_of_special_texts():
    texts = ["<|endoftext|> a<|startoftext|>b", "it's We'LL", "Σ ΑΣ İ ﬁ e\u0301 é", "x\x1cy z", "", None]
    texts += ["word word", "a\x0bb\x0cc\r\nd"]
    plain = [encoder()._tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert cached(texts) == plain


# 1 WARC


def pages(spark):
    big, small = "x" * 150, "y" * 20
    rows = [
        (5, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (9, None, big), (3, "u", small),
        (4, "u", small), (7, "u", None), (8, "u", ""), (None, "u", big), (6, "ü", "é" * 60),
        (1, "u", "é" * 60 + "!"), (2, "http://a/2\r\nX: y", big),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return frame.withColumn("part", F.lit("clash")), rows


def test_warc_round_trip(spark, tmp_path):
    frame, rows = pages(spark)
    op1_warc.write_warc(frame, str(tmp_path / "w"), roll_bytes=600)
    read = op1_warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert len(read) == len(rows)
    assert len({row.record_id for row in read}) == len(rows)
    payloads = {row.page_id: row.payload for row in read if row.record_type == "response"}
    for page_id, _, html in rows:
        data = (html or "").encode()
        mine = [r for r in read if r.page_id == page_id and r.payload_digest == hashlib.sha256(data).hexdigest()]
        assert mine and all(r.payload_bytes == len(data) for r in mine)
        first = 2 if html == "x" * 150 else page_id
        assert payloads[first] == data
    repeats = [r for r in read if r.payload_digest == hashlib.sha256(b"x" * 150).hexdigest()]
    assert Counter(r.record_type for r in repeats) == {"response": 1, "revisit": 4}
    assert {r.refers_to for r in repeats if r.record_type == "revisit"} == {2}
    assert not (tmp_path / "w" / "_temporary").exists()


def test_warc_files_are_deterministic(spark, tmp_path):
    frame, _ = pages(spark)
    for name, source in (("a", frame), ("b", frame.repartition(5))):
        op1_warc.write_warc(source, str(tmp_path / name), roll_bytes=600)
    read = lambda name: {p.name: p.read_bytes() for p in (tmp_path / name).glob("*.warc.gz")}
    assert read("a") == read("b")
    assert len(read("a")) > 1
    assert all(gzip.decompress(data).startswith(b"WARC/1.1\r\n") for data in read("a").values())


def test_warc_needs_its_manifest(spark, tmp_path):
    frame, _ = pages(spark)
    op1_warc.write_warc(frame, str(tmp_path / "w"))
    with pytest.raises(FileExistsError):
        op1_warc.write_warc(frame, str(tmp_path / "w"))
    listed = [row.name for row in op1_warc.read_manifest(spark, str(tmp_path / "w")).collect()]
    assert sorted(listed) == sorted(p.name for p in (tmp_path / "w").glob("*.warc.gz"))
    (tmp_path / "w" / "stray.warc.gz").write_bytes(b"not listed")
    assert op1_warc.read_warc(spark, str(tmp_path / "w")).count() == frame.count()


def test_a_second_archive_leaves_the_first_as_it_is(spark, tmp_path):
    frame, _ = pages(spark)
    folder = tmp_path / "w"
    op1_warc.write_warc(frame, str(folder), roll_bytes=600)
    before = {p.relative_to(folder): p.read_bytes() for p in folder.rglob("*") if p.is_file()}
    others = frame.withColumn("page_id", F.col("page_id") + 100).withColumn("html", F.lit("other " * 60))
    with pytest.raises(FileExistsError):
        op1_warc.write_warc(others, str(folder), roll_bytes=600)
    assert before == {p.relative_to(folder): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


@pytest.mark.parametrize("crash", ["before renames", "between renames", "before the manifest"])
def test_archive_after_a_crash(spark, tmp_path, monkeypatch, crash):
    frame, _ = pages(spark)
    folder = tmp_path / "w"
    others = frame.withColumn("html", F.lit("an earlier attempt " * 30))

    def stopped(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(op1_warc, "rename_path", stopped)
    with pytest.raises(RuntimeError):
        op1_warc.write_warc(others, str(folder), roll_bytes=600)
    monkeypatch.undo()
    if crash != "before the manifest":
        files = sorted(folder.glob("*.warc.gz"))
        (folder / "_temporary").mkdir(exist_ok=True)
        for file in files if crash == "before renames" else files[::2]:
            file.rename(folder / "_temporary" / f"0-{file.name}")
    op1_warc.write_warc(frame, str(folder), roll_bytes=600)
    assert op1_warc.read_warc(spark, str(folder)).count() == frame.count()
    op1_warc.write_warc(frame, str(tmp_path / "clean"), roll_bytes=600)
    listed = [row.name for row in op1_warc.read_manifest(spark, str(folder)).collect()]
    for name in listed:
        assert (folder / name).read_bytes() == (tmp_path / "clean" / name).read_bytes()


@pytest.mark.parametrize("harm", ["longer", "other"])
def test_files_are_checked_against_the_manifest(spark, tmp_path, harm):
    frame, _ = pages(spark)
    folder = tmp_path / "w"
    op1_warc.write_warc(frame, str(folder))
    op1_warc.write_warc(frame.where("page_id = 3"), str(tmp_path / "o"))
    file = min(folder.glob("*.warc.gz"))
    other = min((tmp_path / "o").glob("*.warc.gz"))
    whole = other.read_bytes()
    file.write_bytes(whole if harm == "other" else file.read_bytes() + whole)
    with pytest.raises(Exception, match="not the file that the manifest lists"):
        op1_warc.read_warc(spark, str(folder)).collect()


def test_warc_of_no_pages(spark, tmp_path):
    frame, _ = pages(spark)
    op1_warc.write_warc(frame.limit(0), str(tmp_path / "w"))
    assert op1_warc.read_warc(spark, str(tmp_path / "w")).count() == 0


# 2 Token counts


def test_rollup_against_a_recount(spark, awkward):
    got = {(r.source, r.lang): (r.documents, r.tokens) for r in op2_token_counts.rollup(awkward).collect()}
    expected: dict = defaultdict(lambda: [0, 0])
    for row in awkward.collect():
        text = row.text or ""
        ids = encoder()._tokenizer.encode(text, add_special_tokens=False).ids
        expected[row.source, row.lang][0] += 1
        expected[row.source, row.lang][1] += len(ids) + 1
    assert got == {key: tuple(value) for key, value in expected.items()}


def test_two_writers_of_one_batch_count_once(spark, tmp_path, monkeypatch):
    schema = "op string, source string, lang string, tokenizer string, tokens bigint"
    load = spark.createDataFrame([("insert", "a", "en", "t1", 10)], schema)
    store = op2_token_counts.TokenStore(spark, str(tmp_path / "s"))
    # Neither sees the other's batch before it commits.
    monkeypatch.setattr(store, "committed", lambda: set())
    assert [store.apply("1", load), store.apply("1", load)].count(True) == 1
    monkeypatch.undo()
    for _ in range(2):
        assert [(r.documents, r.tokens) for r in store.totals().collect()] == [(1, 10)]
        store.compact()
    assert not store.apply("1", load)


def test_store_commits_batches_once(spark, tmp_path):
    schema = "op string, source string, lang string, tokenizer string, tokens bigint, old_tokens bigint, old_source string"
    load = spark.createDataFrame(
        [("insert", "a", "en", "t1", 10, None, None), ("insert", None, None, "t1", None, None, None),
         ("insert", "b", "en", "t1", 7, None, None)], schema)
    change = spark.createDataFrame(
        [("revise", "a", "en", "t1", 12, 7, "b"), ("delete", "a", "en", "t1", 10, None, "a")], schema)
    store = op2_token_counts.TokenStore(spark, str(tmp_path / "s"))
    assert store.totals().count() == 0
    assert store.apply("1", load) and not store.apply("1", load)
    assert store.apply("2", change)
    expected = {("a", "en", 1, 12), (None, None, 1, 0)}
    totals = lambda: {(r.source, r.lang, r.documents, r.tokens) for r in store.totals().collect()}
    assert totals() == expected
    store.compact()
    assert totals() == expected
    assert not store.apply("2", change)
    assert store.apply("3", load.limit(0)) and totals() == expected
    store.compact()
    assert totals() == expected and store.committed() == {"1", "2", "3"}
    with pytest.raises(ValueError):
        store.apply("../x", load)


# 3 Jaccard join


def shingles(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def brute_links(rows, threshold=0.8):
    """Per row number its links and its class (the smallest row number)."""
    sets = [shingles(row.text) for row in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(place):
        while parent[place] != place:
            place = parent[place]
        return place

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] | sets[b])
        same = (rows[a].text or "") == (rows[b].text or "")
        if same or (both and len(sets[a] & sets[b]) / both >= threshold):
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    return links, [find(place) for place in range(len(rows))]


@pytest.mark.parametrize("options", [{}, {"tile_texts": 2, "broadcast_nodes": 0}])
def test_join_against_all_pairs(spark, awkward, options):
    near = spark.createDataFrame(
        [(5000 + i, " ".join(f"z{j}" if j != 3 * i else f"q{i}" for j in range(70)), "en", "a", 1) for i in range(9)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = table(spark, "documents").unionByName(awkward.select(*near.columns).where("doc_id < 9").withColumn("doc_id", F.col("doc_id") + 10_000)).unionByName(near)
    rows = docs.collect()
    links, classes = brute_links(rows)
    got = {row.doc_id: row for row in op3_jaccard_join.jaccard_join(docs, **options).collect()}
    members = defaultdict(list)
    for row, name in zip(rows, classes, strict=True):
        members[name].append(row.doc_id)
    for row, count, name in zip(rows, links, classes, strict=True):
        assert (got[row.doc_id].links, got[row.doc_id].class_id) == (count, min(members[name]))
    kept = op3_jaccard_join.representatives(docs, **options).collect()
    assert sorted(row.doc_id for row in kept) == sorted(min(ids) for ids in members.values())


def test_join_takes_awkward_rows(awkward, no_documents):
    rows = op3_jaccard_join.jaccard_join(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {row.doc_id: row for row in rows}
    assert by_id[3].class_id == by_id[2].class_id == 1
    assert by_id[5].links == 2 and by_id[7].links == 0 and by_id[12].links == 1
    kept = op3_jaccard_join.representatives(awkward)
    assert kept.columns == awkward.columns
    assert sorted(row.doc_id or 0 for row in kept.collect()) == [0, 1, 4, 5, 7, 8, 9, 10, 12]
    assert op3_jaccard_join.jaccard_join(no_documents).count() == 0
    assert op3_jaccard_join.representatives(no_documents).count() == 0


def test_prefixes_are_shortened_to_the_target():
    assert op3_jaccard_join.forest_depth(0.8, 32, 6, 0.99999) == 5
    assert op3_jaccard_join.forest_depth(0.8, 32, 6, 0.9) == 6
    assert op3_jaccard_join.forest_depth(0.5, 4, 8, 0.999999) == 1


def test_components(spark):
    random.seed(5)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(170)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    got = connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {row.node: row.root for row in got} == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# 5 Nearest neighbours


@pytest.mark.parametrize("options", [{}, {"segment_rows": 100, "query_rows": 7}])
def test_nearest_recall_and_scores(spark, options):
    vectors = table(spark, "embeddings")
    rows = vectors.select("vec_id", "embedding").collect()
    ids = np.array([row.vec_id for row in rows])
    matrix = np.array([row.embedding for row in rows], dtype=np.float64)
    got = defaultdict(list)
    for row in op5_neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, **options).collect():
        got[row.query_id].append(row)
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for query, found in got.items():
        place = int(np.flatnonzero(ids == query)[0])
        scores = matrix @ matrix[place]
        scores[place] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        found.sort(key=lambda row: row["rank"])
        assert [row["rank"] for row in found] == list(range(1, 21))
        assert all(row.score == pytest.approx(scores[ids == row.vec_id][0], abs=1e-12) for row in found)
        hits += len(best & {row.vec_id for row in found})
    assert hits / (20 * len(got)) >= 0.9


def test_nearest_of_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (None, [1.0, 1.0]),
        (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 1.0, 1.0]), (4, [None, 1.0]), (2, [2.0, 0.0]),
        (80, [-3.0, 1.0]), (5, []), (6, [float("inf"), 1.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit(1))
    got = op5_neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 80, -3.0),
        (80, 1, 0, -3.0), (80, 2, 1, -6.0), (80, 3, 2, -6.0),
    ]
    assert op5_neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("options", [{}, {"segment_rows": 100, "query_rows": 7}])
def test_nearest_of_a_table_of_repeated_rows(spark, options):
    """Every row 25 times, and one row as often as a third of all."""
    rows = [(row.vec_id, row.embedding) for row in table(spark, "embeddings").where("vec_id < 300").collect()]
    ids, matrix = np.array([row[0] for row in rows]), np.array([row[1] for row in rows], dtype=np.float64)
    repeated = [row for row in rows for _ in range(25)] + [rows[1]] * (len(rows) * 12)
    random.Random(4).shuffle(repeated)
    frame = spark.createDataFrame(repeated, "vec_id bigint, embedding array<float>").repartition(5)
    got = defaultdict(list)
    for row in op5_neighbours.nearest(frame, F.col("vec_id") % 20 == 0, **options).collect():
        got[row.query_id].append(row)
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for query, found in got.items():
        scores = matrix @ matrix[np.flatnonzero(ids == query)[0]]
        scores[ids == query] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        found.sort(key=lambda row: row["rank"])
        assert [row["rank"] for row in found] == list(range(1, 21))
        assert len({row.vec_id for row in found}) == 20
        assert all(row.score == pytest.approx(scores[ids == row.vec_id][0], abs=1e-12) for row in found)
        hits += len(best & {row.vec_id for row in found})
    assert hits / (20 * len(got)) >= 0.9


# 6 Toxicity


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    rows = op6_toxicity.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [row for row in rows if row.toxic]
    clean = [row for row in rows if not row.toxic]
    assert sum(row.predicted for row in toxic) / len(toxic) > 0.75
    assert sum(row.predicted for row in clean) / len(clean) < 0.01
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)


def test_scores_of_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame(
        [(1, 0), (3, 1), (3, 0), (4, None), (None, 1), (77, 1)], "doc_id bigint, toxic int")
    rows = op6_toxicity.score_documents(awkward, labels).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= row.score <= 1 for row in rows)
    none = op6_toxicity.score_documents(awkward, labels.limit(0)).collect()
    assert {round(row.score, 6) for row in none} == {0.1} and not any(row.predicted for row in none)
    assert op6_toxicity.score_documents(no_documents, labels).count() == 0
    assert op6_toxicity.without_toxic(awkward, labels.limit(0)).columns == awkward.columns


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    docs = table(spark, "documents")
    labels = table(spark, "labels")
    flipped = labels.withColumn(
        "toxic", F.when(op6_toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (
        {r.doc_id: r.score for r in op6_toxicity.score_documents(docs, l).collect()} for l in (labels, flipped))
    assert first == second


def test_fitting_does_not_hold_the_rows():
    def rows(long):
        for number in range(400):
            toxic = number % 3 == 0
            places = np.arange(long) * 10 + (1 << 20) + number % 10
            yield np.append([5 if toxic else 7, 9], places).astype(np.int32), int(toxic)

    tracemalloc.start()
    places, weights, _ = op6_toxicity.fit(rows(100_000))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert places.dtype == np.int32 and len(places) == len(weights)
    assert most < 100e6  # the rows have 160 MB
    places, weights, _ = op6_toxicity.fit(rows(0))
    assert weights[places == 5] > 0 and not np.isin(9, places)


# 7 Packing


def test_pieces_hold_every_id_once(spark, awkward, no_documents):
    docs = table(spark, "documents").select("doc_id", "text").unionByName(
        awkward.select((F.col("doc_id") + 10_000).alias("doc_id"), "text").where("doc_id <> 10012"))
    pieces = op7_packing.pack_documents(docs.coalesce(2), buffer_tokens=30_000).collect()
    texts = {row.doc_id: row.text for row in docs.collect()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for piece in pieces:
        by_doc[piece.doc_id].append(piece)
        by_sequence[piece.sequence_id].append(piece)
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        ids = encoder()._tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        own.sort(key=lambda piece: piece.start)
        assert own[0].start == 0 and own[-1].start + own[-1].length == len(ids) == own[0].doc_tokens
        assert all(a.start + a.length == b.start for a, b in itertools.pairwise(own))
        for piece in own:
            data = np.array(ids[piece.start : piece.start + piece.length], "<u4").tobytes()
            assert piece.ids_crc32 == zlib.crc32(data)
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda piece: piece.offset)
        total = sum(piece.length for piece in own)
        assert own[0].offset == 0 and total <= own[0].tier
        assert all(a.offset + a.length == b.offset for a, b in itertools.pairwise(own))
        padding += 0 if total in op7_packing.TIERS else 4096 - total
    assert padding <= 2 * 4096
    assert op7_packing.pack_documents(no_documents).count() == 0


def test_step_groups_are_balanced():
    random.seed(2)
    windows, _ = op7_packing.pack([(i, random.randint(1, 3000)) for i in range(3000)])
    groups = defaultdict(list)
    for number, window in zip(op7_packing.step_groups(windows, 32 * 4096), windows, strict=True):
        groups[window[0], number].append(window)
    for tier in {tier for tier, _ in groups}:
        own = [group for (t, _), group in groups.items() if t == tier]
        sizes = [len(group) for group in own]
        costs = [sum(p[2] ** 2 for _, pieces in group for p in pieces) / len(group) for group in own]
        assert max(sizes) - min(sizes) <= 1
        assert max(costs) < 1.1 * min(costs)


# 8 Resharding


def cheapest(sizes, capacities, price):
    best = [float("inf")]

    def place(old, room, total):
        if total >= best[0]:
            return
        if old == len(sizes):
            best[0] = total
            return

        def split(new, left, room, total):
            if new == len(room):
                if left == 0:
                    place(old + 1, room, total)
                return
            for amount in range(min(left, room[new]) + 1):
                rest = [r - amount if at == new else r for at, r in enumerate(room)]
                split(new + 1, left - amount, rest, total + amount * price[old][new])

        split(0, sizes[old], room, total)

    place(0, list(capacities), 0)
    return best[0]


def test_flow_is_the_cheapest():
    random.seed(3)
    for _ in range(60):
        olds, news = random.randint(1, 3), random.randint(1, 3)
        sizes = [random.randint(0, 5) for _ in range(olds)]
        capacities = [random.randint(0, 6) for _ in range(news)]
        price = [[random.randint(0, 4) for _ in range(news)] for _ in range(olds)]
        if sum(sizes) > sum(capacities):
            with pytest.raises(ValueError):
                op8_resharding.min_cost_flow(sizes, capacities)
            continue
        flow = op8_resharding.min_cost_flow(sizes, capacities, lambda i, j: price[i][j])
        assert [sum(v for (i, _), v in flow.items() if i == old) for old in range(olds)] == sizes
        assert all(sum(v for (_, j), v in flow.items() if j == new) <= capacities[new] for new in range(news))
        assert sum(v * price[i][j] for (i, j), v in flow.items()) == cheapest(sizes, capacities, price)


def test_resharded_rows(spark, awkward, tmp_path):
    source = str(tmp_path / "docs")
    docs = table(spark, "documents").select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    docs.repartition(5).write.parquet(source)
    rows, plan = op8_resharding.reshard(spark.read.parquet(source), shards=6)
    got = op8_resharding.digests(rows).collect()
    size = lambda text: len((text or "").encode()) + 8
    expected = Counter((r.doc_id, size(r.text), zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == expected
    shards = defaultdict(list)
    for row in got:
        shards[row.shard].append(row)
    assert sorted(shards) == list(range(6))
    for own in shards.values():
        assert sorted(row.slot for row in own) == list(range(len(own)))
    sizes = [sum(row["size"] for row in own) for _, own in sorted(shards.items())]
    assert sizes == plan["sizes"]
    ordinary = [s for s in sizes if s < 150_000]  # one text of awkward is larger than a shard
    assert max(ordinary) - min(ordinary) < 0.2 * max(ordinary)


def test_untouched_shards_keep_their_files(spark, tmp_path):
    source = str(tmp_path / "docs")
    table(spark, "documents").repartition(3).write.parquet(source)
    docs = spark.read.parquet(source)
    _, first = op8_resharding.reshard(docs, capacities=[10**9] * 3)
    assert first["moved"] == 0 and first["kept"] == [0, 1, 2]
    limits = [first["old_sizes"][0] // 2, 10**9, first["old_sizes"][2]]
    rows, plan = op8_resharding.reshard(docs, capacities=limits)
    assert plan["kept"] == [2] and plan["flow"][0, 1] == first["old_sizes"][0] - limits[0]
    assert rows.count() == docs.count()
    written = {p.parent.name for p in Path(plan["folder"].removeprefix("file:")).rglob("*.parquet")}
    assert written == {"shard=0", "shard=1"}


def test_an_id_with_half_of_all_rows(spark, tmp_path):
    source = str(tmp_path / "docs")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars < 4000")
    docs = docs.select(F.when(F.col("doc_id") % 2 == 0, F.lit(7)).otherwise(F.col("doc_id")).alias("doc_id"), "text")
    docs.unionByName(docs).unionByName(docs).repartition(4).write.parquet(source)
    for old, olds in ((None, 1), (op8_resharding.uneven_shard(5), 5)):
        rows, plan = op8_resharding.reshard(spark.read.parquet(source), shards=8, old=old, old_shards=olds)
        sizes = [row[1] for row in op8_resharding.digests(rows).groupBy("shard").agg(F.sum("size")).collect()]
        assert len(sizes) == 8 and max(sizes) <= 1.01 * min(sizes)
        assert plan["moved"] < sum(sizes)


def test_resharding_nothing(spark, no_documents, tmp_path):
    no_documents.write.parquet(str(tmp_path / "none"))
    rows, _ = op8_resharding.reshard(spark.read.parquet(str(tmp_path / "none")))
    assert op8_resharding.digests(rows).count() == 0


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
