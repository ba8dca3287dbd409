"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its runs of five words (all its words, if it has fewer), each hashed to 64
bits; the sketch is the sorted array of the ``k`` smallest different hashes. Sketches of parts merge
into the sketch of the whole, and two sketches estimate resemblance (Jaccard), containment and the
number of distinct shingles; with ``k`` hashes the error of a resemblance is about
``0.5 / sqrt(k)`` at worst. A text with at most ``k`` different shingles is represented exactly.

Everything is DataFrame functions. Edge cases: a null text counts as empty and a text without words
has the empty sketch, which resembles another empty one fully (1) and any other not at all (0);
equal texts have equal sketches; very long texts are sketched whole; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import WORD_PATTERN, materialize

SHINGLE_WORDS = 5
SKETCH_SIZE = 256

# Hashes are spread over this many values.
_HASH_SPACE = 2.0**64


def shingle_hashes(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """64-bit hashes of the shingles in order, with repeats."""
    # Word hashes first: a shingle then hashes five numbers instead of copying five strings.
    tokens = F.transform(
        F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN), F.lit(0)),
        lambda word: F.xxhash64(word),
    )
    return F.element_at(F.transform(F.array(tokens), lambda hashes: _runs(hashes, width)), 1)


def _runs(hashes: Column, width: int) -> Column:
    count = F.size(hashes)
    starts = F.sequence(F.lit(1), F.greatest(count - (width - 1), F.lit(1)))
    return F.when(
        count > 0, F.transform(starts, lambda start: F.xxhash64(F.slice(hashes, start, width)))
    ).otherwise(F.array().cast("array<bigint>"))


def sketch(text: Column, size: int = SKETCH_SIZE, width: int = SHINGLE_WORDS) -> Column:
    return bottom(shingle_hashes(text, width), size)


def bottom(hashes: Column, size: int = SKETCH_SIZE) -> Column:
    """The sorted smallest different hashes."""
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, size)


def resemblance(left: Column, right: Column, size: int = SKETCH_SIZE) -> Column:
    """The share of the smallest hashes of both that both hold: an estimate of the Jaccard index."""

    def share(both: Column) -> Column:
        common = F.filter(F.array_intersect(left, right), lambda h: h <= F.element_at(both, -1))
        return F.size(common) / F.size(both)

    merged = F.element_at(F.transform(F.array(bottom(F.concat(left, right), size)), share), 1)
    return (
        F.when(left.isNull() | right.isNull(), F.lit(None))
        .when(left == right, F.lit(1.0))
        .when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0))
        .otherwise(merged)
        .cast("double")
    )


def distinct_shingles(hashes: Column, size: int = SKETCH_SIZE) -> Column:
    """How many different shingles: exact below ``size``, else estimated from the largest hash kept."""
    highest = (F.element_at(hashes, -1).cast("double") + F.lit(_HASH_SPACE / 2)) / F.lit(_HASH_SPACE)
    return F.when(F.size(hashes) < size, F.size(hashes).cast("double")).otherwise(
        (size - 1) / highest
    )


def containment(part: Column, whole: Column, size: int = SKETCH_SIZE) -> Column:
    """The share of ``part``'s shingles that ``whole`` has too: J (|A| + |B|) / ((1 + J) |A|)."""
    alike = resemblance(part, whole, size)
    both = distinct_shingles(part, size) + distinct_shingles(whole, size)
    estimate = alike * both / ((1 + alike) * distinct_shingles(part, size))
    return F.when(F.size(part) == 0, F.lit(1.0)).otherwise(F.least(estimate, F.lit(1.0)))


def fingerprint_text(hashes: Column) -> Column:
    """A sketch as text: 16 hex digits for each hash, smallest first."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge(
    parts: DataFrame, keys: Sequence[str], column: str = "sketch", size: int = SKETCH_SIZE,
    fan_in: int = 64,
) -> DataFrame:
    """One sketch for each key from the sketches of its parts.

    Parts are merged about ``fan_in`` at a time in rounds, so a key with a large share of all parts
    never gathers many sketches in one place. Null sketches count as empty.
    """
    empty = F.array().cast("array<bigint>")
    level = materialize(
        parts.select(
            *keys,
            F.coalesce(F.col(column), empty).alias("_sketch"),
            F.xxhash64(F.monotonically_increasing_id()).alias("_at"),
        ),
        "sketch-parts",
    )
    groups = -(-max(level.count(), 1) // fan_in)
    level = level.withColumn("_at", F.pmod("_at", F.lit(groups)))
    while True:
        level = level.groupBy(*keys, "_at").agg(
            bottom(F.flatten(F.collect_list("_sketch")), size).alias("_sketch")
        )
        if groups == 1:
            return level.select(*keys, F.col("_sketch").alias(column))
        groups = -(-groups // fan_in)
        level = level.withColumn("_at", F.pmod("_at", F.lit(groups)))


# Documents are cut into ranges of this many by id, up to a number of ranges that the driver and
# every row's lookup can afford; beyond it the ranges grow and are sorted with spilling.
RANGE_ROWS = 64
MAX_RANGES = 16_384
_FAN = 128


def _ranges(docs: DataFrame) -> Column:
    """Number of the id range of a row: higher ids in higher ranges, null ids in negative ones."""
    ids = docs.agg(F.count("doc_id")).first()[0]
    count = min(MAX_RANGES, ids // RANGE_ROWS)
    cuts = []
    if count > 1:
        shares = [place / count for place in range(1, count)]
        found = docs.agg(F.percentile_approx("doc_id", shares, 10 * count)).first()[0]
        cuts = sorted(set(found))
    chunks = [cuts[at : at + _FAN] for at in range(0, len(cuts), _FAN)]
    heads = [chunk[0] for chunk in chunks]
    row_id = F.col("doc_id")
    spread_nulls = -1 - F.pmod(F.xxhash64("text"), F.lit(MAX_RANGES))
    if not cuts:
        return F.when(row_id.isNull(), spread_nulls).otherwise(F.lit(0)).cast("bigint")

    def literal(value, kind: str) -> Column:
        return F.from_json(F.lit(str(value)), kind)

    chunk = F.size(F.filter(literal(heads, "array<bigint>"), lambda cut: cut <= row_id))
    inside = F.filter(
        F.element_at(literal(chunks, "array<array<bigint>>"), chunk), lambda cut: cut <= row_id
    )
    number = F.when(chunk == 0, F.lit(0)).otherwise((chunk - 1) * _FAN + F.size(inside))
    return F.when(row_id.isNull(), spread_nulls).otherwise(number).cast("bigint")


def with_next(docs: DataFrame, add) -> DataFrame:
    """``doc_id`` and ``text`` with those columns of ``add(text)`` and all of it for the next row.

    The next row is the one with the next smaller id; the last row is followed by the first. Rows
    that share an id follow each other by text; null ids come last, by hash and text. ``add`` maps
    a text column to named columns; ``next_text`` and ``next_<name>`` are the next row's.

    The texts are shuffled once, by id range. The row that follows a range is copied into it, so
    no sort or window sees more than one range.
    """
    rows = docs.select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).withColumn("_range", _ranges(docs))
    tops = rows.groupBy("_range").agg(F.max("doc_id").alias("_top"))
    # At most two rows for each possible range: bounded by MAX_RANGES.
    tops = sorted(((row[0], row[1]) for row in tops.collect()), reverse=True)
    spark = docs.sparkSession
    before = [tops[place - 1][0] for place in range(len(tops))]
    follows = spark.createDataFrame(
        [(at, top, target) for (at, top), target in zip(tops, before, strict=True)],
        "_at bigint, _top bigint, _before bigint",
    )
    firsts = (
        rows.join(
            F.broadcast(follows),
            (F.col("_range") == F.col("_at")) & F.col("doc_id").eqNullSafe(F.col("_top")),
        )
        .groupBy("_before")
        .agg(F.min("text").alias("text"))
    )
    guests = firsts.select(
        F.lit(None).cast("bigint").alias("doc_id"),
        "text",
        F.col("_before").alias("_range"),
        F.lit(1).alias("_guest"),
    )
    dealt = (
        rows.select(F.col("doc_id").cast("bigint"), "text", "_range", F.lit(0).alias("_guest"))
        .unionByName(guests)
        .repartition("_range")
    )
    added = add(F.col("text"))
    dealt = dealt.select("*", *(column.alias(name) for name, column in added.items()))
    order = Window.partitionBy("_range").orderBy(
        "_guest", F.col("doc_id").desc_nulls_last(), "text"
    )
    following = {name: F.lead(name).over(order) for name in ("text", *added)}
    return (
        dealt.withColumns({f"next_{name}": column for name, column in following.items()})
        .where(F.col("_guest") == 0)
        .drop("_range", "_guest")
    )


def fingerprint_documents(docs: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per row its fingerprint, and those of its text with the second half taken from the next."""
    rows = with_next(docs, lambda text: {"sketch": sketch(text, size)})
    rows = rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring("next_text", F.lit(1), half),
    )
    rows = rows.withColumn("edited", edited)
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), size))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("sketch")).alias("fingerprint"),
        fingerprint_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), size).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), size).alias("near_next"),
    )
