"""Mixing, fingerprints and surrogates against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from compare import duckdb_bag, spark_bag
from pyspark.sql import functions as F

from chatloom.llm import op4_fingerprint as fp
from chatloom.llm import op9_mixing as mixing
from chatloom.llm import op10_pii as pii
from chatloom.llm import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert spark_bag(queries.QUERIES[name](spark, SF)) == duckdb_bag(SF, queries.ORACLES[name])


def water(sizes: list[int], weights: list[float], epochs: float) -> list[float]:
    """Clamp and share again until nothing is above its cap."""
    targets, open_at, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_at:
        level = rest / sum(weights[i] for i in open_at)
        over = {i for i in open_at if level * weights[i] >= epochs * sizes[i]}
        if not over:
            for i in open_at:
                targets[i] = level * weights[i]
            break
        for i in over:
            targets[i] = epochs * sizes[i]
            rest -= targets[i]
        open_at -= over
    return targets


def test_mix_meets_targets(awkward):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    sizes = defaultdict(int)
    for row in rows:
        sizes[row.source] += row.size
        assert 0 <= row.taken <= 3 * row.size
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    expected = water(
        [sizes[n] for n in names], [mixing.CYCLE[i % 3] for i in range(len(names))], 3
    )
    for name, target in zip(names, expected, strict=True):
        own = [row for row in rows if row.source == name]
        assert own[0].target == pytest.approx(target)
        assert sum(row.taken for row in own) == round(own[0].target)


def test_mix_is_repeatable_and_takes_empty_tables(awkward, no_documents):
    first = Counter(map(tuple, mixing.mix(awkward).collect()))
    assert first == Counter(map(tuple, mixing.mix(awkward.repartition(7)).collect()))
    assert mixing.mix(no_documents).count() == 0
    assert mixing.mixed_documents(no_documents).count() == 0


def test_mixed_documents_hold_the_words_taken(awkward):
    taken = Counter()
    for row in mixing.mix(awkward).collect():
        taken[row.source] += row.taken
    docs = mixing.mixed_documents(awkward).collect()
    words = Counter()
    for row in docs:
        words[row.source] += len(WORD.findall(row.text or ""))
        assert row.n_chars == len(row.text)
    assert words == +taken


def test_broadcast_and_shuffle_of_the_plan_agree(awkward, monkeypatch):
    broadcast = Counter(map(tuple, mixing.mix(awkward).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert Counter(map(tuple, mixing.mix(awkward).collect())) == broadcast


def shingles(text: str) -> set:
    words = WORD.findall(text or "")
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_sets(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 7)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    local = docs.orderBy(F.col("doc_id").desc()).collect()
    found = {row.doc_id: row for row in fp.fingerprint_documents(docs).collect()}
    assert len(found) == len(local)
    for row, after in zip(local, [*local[1:], local[0]], strict=True):
        half = len(row.text) // 2
        edited = row.text[: len(row.text) - half] + after.text[:half]
        got = found[row.doc_id]
        assert got.n_chars == len(row.text)
        assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other = shingles(row.text), shingles(edited)
        assert abs(got.near_edited - jaccard(own, other)) < 0.13
        assert abs(got.near_next - jaccard(own, shingles(after.text))) < 0.13
        if len(own | other) <= fp.SKETCH_SIZE:
            assert got.near_edited == pytest.approx(jaccard(own, other))


def test_fingerprints_of_awkward_rows(awkward, no_documents):
    rows = fp.fingerprint_documents(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = defaultdict(list)
    for row in rows:
        by_id[row.doc_id].append(row)
    assert by_id[1][0].fingerprint == by_id[2][0].fingerprint != by_id[3][0].fingerprint
    assert by_id[5][0].fingerprint == by_id[7][0].fingerprint == ""
    assert by_id[12][0].fingerprint == by_id[12][1].fingerprint
    assert fp.fingerprint_documents(no_documents).count() == 0


def test_sketches_merge_and_estimate(spark):
    parts = spark.createDataFrame(
        [("k", " ".join(f"p{part}w{i}" for i in range(40))) for part in range(90)]
        + [("n", None)],
        "key string, text string",
    ).withColumn("sketch", fp.sketch(F.col("text"), 64))
    merged = {r.key: r.sketch for r in fp.merge(parts, ["key"], size=64, fan_in=4).collect()}
    hashes = parts.select("key", F.explode(fp.shingle_hashes(F.col("text"))).alias("h"))
    whole = sorted({row.h for row in hashes.collect()})
    assert merged == {"k": whole[:64], "n": []}
    row = spark.createDataFrame([(whole[:64], whole[:32])], "a array<bigint>, b array<bigint>")
    count, inside = row.select(
        fp.distinct_shingles(F.col("a"), 64), fp.containment(F.col("b"), F.col("a"), 64)
    ).first()
    assert count == pytest.approx(len(whole), rel=0.4)
    assert 0 < inside <= 1


ENTITIES = [
    "bob.Smith12@mail3.example.com", "BOB.smith12@mail3.example.com", "ana@mail1.example.com",
    "+1 (578) 555-6437", "578-555-6437", "+34 612 345 678", "50.234.85.130", "50.234.85.131",
    "4111111111111111", "4111 1111 1111 1111", "4118187128635271", "123-45-6789",
    "Mr. John Miller", "Maria Lopez", "Г-н Иван Петров", "Frau Ingrid Krüger",
]


def luhn(number: str) -> bool:
    digits = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_surrogates_keep_format_type_and_identity(spark):
    df = spark.createDataFrame([(e,) for e in ENTITIES], "entity string")
    got = {
        r.entity: r
        for r in df.select(
            "entity",
            pii.entity_kind(F.col("entity")).alias("kind"),
            pii.surrogate(F.col("entity")).alias("new"),
            pii.detected(F.concat(F.lit("x "), "entity", F.lit(", y"))).alias("found"),
        ).collect()
    }
    for entity, row in got.items():
        assert row.found == [entity]
        assert row.new != entity
        if row.kind in ("phone", "card", "ssn"):
            assert re.sub(r"\d", "9", row.new) == re.sub(r"\d", "9", entity)
        if row.kind == "card":
            assert luhn(row.new) == luhn(entity)
            assert row.new[0] == entity[0]
        if row.kind == "ipv4":
            assert all(0 <= int(part) <= 255 for part in row.new.split("."))
    digits = lambda text: re.sub(r"\D", "", text)
    assert got[ENTITIES[0]].new.lower() == got[ENTITIES[1]].new.lower()
    assert digits(got["+1 (578) 555-6437"].new)[1:] == digits(got["578-555-6437"].new)
    assert digits(got["4111111111111111"].new) == digits(got["4111 1111 1111 1111"].new)
    male = pii.GIVEN["latin", "m"]
    assert got["Mr. John Miller"].new.split()[1] in male
    assert got["Maria Lopez"].new.split()[0] in pii.GIVEN["latin", "f"]
    assert got["Г-н Иван Петров"].new.split()[1] in pii.GIVEN["cyrillic", "m"]
    assert re.fullmatch(r"[А-я]+", got["Г-н Иван Петров"].new.split()[2])


def test_digit_surrogates_are_a_permutation(spark):
    """Every value of a small format has an image of its own, and none stays as it was."""
    rows = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    new = rows.select("d", pii._permute_digits(F.col("d"), "k", F.lit("t")).alias("n")).collect()
    assert len({row.n for row in new}) == 10_000
    assert all(row.n != row.d and len(row.n) == 4 for row in new)


def test_surrogates_do_not_depend_on_how_a_query_is_built(spark):
    df = spark.createDataFrame([(e,) for e in ENTITIES], "entity string")
    runs = [
        [tuple(row) for row in df.select("entity", pii.surrogate(F.col("entity")).alias("n")).collect()]
        for _ in range(2)
    ]
    assert runs[0] == runs[1]


def test_letter_surrogates_are_distinct(spark):
    letters = "aeioubcdl"
    rows = spark.createDataFrame([(a + b + c + "n",) for a in letters for b in letters for c in letters], "t string")
    new = rows.select(pii._name(F.concat(F.lit("Mr "), F.initcap("t")), "k").alias("n"))
    assert new.distinct().count() == rows.count()


def test_collisions_are_reported(spark):
    same = spark.createDataFrame([("1.2.3.4",), ("1.2.3.4",), ("1.2.3.5",)], "entity string")
    assert pii.surrogate_collisions(same).isEmpty()
    assert pii.collision_free_key(same.withColumnRenamed("entity", "text")) == pii.KEY


def test_clean_and_awkward_texts_stay(awkward, no_documents, spark):
    clean = ["Andre. Reed went out 12345", "v1.2.3", "0.0.0.0 256.1.1.1", "a@b", "12-34 5678", "The End"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(clean)], "doc_id bigint, text string")
    assert [r.text for r in pii.replace_entities(df).orderBy("doc_id").collect()] == clean
    before = Counter((r.doc_id, r.text) for r in awkward.collect())
    assert Counter((r.doc_id, r.text) for r in pii.replace_entities(awkward).collect()) == before
    assert pii.replace_entities(no_documents).count() == 0


def test_replaced_text_keeps_everything_around(spark):
    text = "a@x.com start 1.2.3.4 mid\n+1 (578) 555-6437 end a@x.com"
    df = spark.createDataFrame([(1, text, len(text))], "doc_id bigint, text string, n_chars bigint")
    row = pii.replace_entities(df).first()
    assert re.fullmatch(r"\S+ start \S+ mid\n\+1 \(\d{3}\) \d{3}-\d{4} end \S+", row.text)
    assert row.text.split()[0] == row.text.split()[-1] != "a@x.com"
    assert row.n_chars == len(row.text)
    assert row.entity_kinds == ["email", "ipv4", "phone", "email"]


def test_addresses_of_every_first_byte(spark):
    """First bytes 1 to 255, the upper ones too, have surrogates of their own."""
    texts = [f"at {first}.254.104.120, {first}.0.0.{first % 2}" for first in range(1, 256)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = pii.replace_entities(df).collect()
    assert all(row.entity_kinds == ["ipv4", "ipv4"] for row in rows)
    new = [address for row in rows for address in re.findall(r"[\d.]+", row.text)]
    assert len(set(new)) == len(new) == 510
    assert all(1 <= int(a.split(".")[0]) and all(int(b) <= 255 for b in a.split(".")) for a in new)
    assert max(int(a.split(".")[0]) for a in new) > 223
    assert not set(new) & {address for text in texts for address in re.findall(r"\d[\d.]+\d", text)}


OTHER_FORMS = {
    "card": ["2221000000000009", "2720 9999 9999 9996", "2223-0031-2200-3222", "30569309025904",
             "3852 000002 3237", "3782 822463 10005", "3714-496353-98431", "4222222222222", "6304000000000000000"],
    "phone": ["1-555-123-4567", "1 (555) 123-4567", "(555)-123-4567", "(555)1234567", "5551234567", "15551234567"],
}
NO_CARDS = ["2221000000000008", "2720 9999 9999 9997", "30569309025905", "2721000000000004", "4222222222223"]


def test_other_forms_of_cards_and_phones(spark):
    forms = [(kind, e, f"x {e}, y") for kind, own in OTHER_FORMS.items() for e in own]
    rows = pii.replace_entities(spark.createDataFrame(forms, "kind string, entity string, text string")).collect()
    digits = lambda text: re.sub(r"\D", "", text)
    new = {}
    for row in rows:
        new[row.entity] = row.text[2:-3]
        assert row.entity_kinds == [row.kind], row
        assert new[row.entity] != row.entity
        assert re.sub(r"\d", "9", new[row.entity]) == re.sub(r"\d", "9", row.entity)
        if row.kind == "card":
            assert luhn(new[row.entity]) and luhn(row.entity)
            assert row.entity[0] != "2" or 2221 <= int(digits(new[row.entity])[:4]) <= 2720
    assert {digits(v)[-10:] for k, v in new.items() if k in OTHER_FORMS["phone"]} == {digits(new["5551234567"])}
    again = spark.createDataFrame([(f"x {e}, y",) for e in new.values()], "text string")
    kinds = [row.kind for row in rows]
    assert [k for r in pii.replace_entities(again).collect() for k in r.entity_kinds] == kinds
    kept = " | ".join(NO_CARDS)
    row = pii.replace_entities(spark.createDataFrame([(f"{kept} | 1.2.3.4 {kept}",)], "text string")).first()
    assert row.entity_kinds == ["ipv4"] and row.text.startswith(f"{kept} | ") and row.text.endswith(f" {kept}")
    entities = spark.createDataFrame([(e,) for own in OTHER_FORMS.values() for e in own], "entity string")
    assert pii.surrogate_collisions(entities).isEmpty()
