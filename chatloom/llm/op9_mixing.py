"""Mixing sources to target weights: capped water-filling and seeded whole and fractional epochs.

Targets. Source ``s`` asks for ``level * weight_s`` words and may give at most
``max_epochs * size_s``. Clamping the sources that ask for more and sharing what they leave among
the others in proportion to weight, until no source is above its cap, ends at one water level: with
sources in order of ``cap / weight``, the first ``k`` are clamped and the level is the rest of the
budget over the rest of the weights. That is computed from prefix sums over one row per source.

Sampling. A source's documents are put into an order by a seeded hash. Whole epochs take every
document; the last, partial epoch takes documents in hash order until the target is met, and of the
document in which the target falls only a first part, so the words taken equal the target rounded to
a whole word. Sums per hash bucket decide all but one bucket of each source; only the rows of that
bucket are ordered, so no source, however large, is sorted in one task.

Everything is DataFrame functions. Edge cases: a null text has size 0 and is never taken; a null
source is a source of its own, in the order after all others; empty tables give empty results;
rows that repeat count each; other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import WORD_PATTERN
from chatloom.scratch import materialize, materialize_and_measure

CYCLE = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"

# Hash buckets a source; only one of them is ordered row by row.
BUCKET_DIGITS = 3

# A plan of at most this many rows (some 20 MB) is broadcast; a longer one is shuffled.
BROADCAST_ROWS = 200_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = CYCLE,
    max_epochs: float = MAX_EPOCHS,
    share: float = 1.0,
) -> DataFrame:
    """From one row per source (``source``, ``source_size``) to its ``weight`` and ``target``.

    Weights repeat over the sources in code point order, null last. Its windows see one row per
    source, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(weight)) for weight in weights))
    weighed = sizes.withColumn("_place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("_place") % len(weights) + 1).cast("int"))
    )
    weighed = weighed.withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    everything = Window.partitionBy()
    by_fill = Window.orderBy((F.col("_cap") / F.col("weight")).asc(), F.col("_place").asc())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = weighed.withColumn("_level", level)
    # The level is the one of the first source in this order that stays below its cap.
    below = F.col("_level") * F.col("weight") < F.col("_cap")
    filled = levels.withColumn(
        "_water",
        F.min(F.when(below, F.struct(F.col("_cap") / F.col("weight"), "_place", "_level"))).over(
            everything
        )["_level"],
    )
    target = F.least(
        F.col("_cap"), F.coalesce(F.col("_water") * F.col("weight"), F.col("_cap"))
    )
    return filled.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = CYCLE,
    max_epochs: float = MAX_EPOCHS,
    share: float = 1.0,
    seed: str = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``docs``: its words ``size``, its source's size and target, and ``taken``.

    ``epochs`` is the number of whole takes and ``part`` the words of a last, partial take (0 if
    none); ``taken = epochs * size + part``. Reads ``doc_id``, ``text``, ``source`` and the columns
    of ``keep``, which it returns as ``keep_<name>``.
    """
    placed = docs.select(
        F.col("doc_id").alias("_doc_id"),
        F.col("source").alias("_source"),
        F.col("text").alias("_text"),
        F.md5(F.concat_ws("\x1f", F.lit(seed), F.col("doc_id").cast("string"))).alias("_order"),
        *(F.col(name).alias(f"keep_{name}") for name in keep),
    ).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    narrow = materialize(
        placed.select(
            "_doc_id", "_source", "_order", "_bucket", word_count(F.col("_text")).alias("_size")
        ),
        "mix-sizes",
    )
    plan, edges = _plan(narrow, weights, max_epochs, share)
    # Without other columns the narrow rows are all that is needed; the texts are not read again.
    rows = placed if keep else narrow
    size = word_count(F.col("_text")) if keep else F.col("_size")

    def with_plan(part: DataFrame) -> DataFrame:
        return (
            rows.alias("r")
            .join(
                part.alias("p"),
                F.col("r._source").eqNullSafe(F.col("p._source"))
                & (F.col("r._bucket") == F.col("p._bucket")),
            )
            .select(
                "r._doc_id",
                "r._source",
                "r._order",
                size.alias("_size"),
                *(f"r.keep_{name}" for name in keep),
                *(f"p.{name}" for name in PLAN_COLUMNS),
            )
        )

    inside = with_plan(plan).withColumn(
        "_part", F.when(F.col("_start") < F.col("_rest"), F.col("_size")).otherwise(F.lit(0))
    )
    by_hash = (
        Window.partitionBy("_source")
        .orderBy("_order", F.col("_doc_id").asc_nulls_last(), "_size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.col("_start") + F.coalesce(F.sum("_size").over(by_hash), F.lit(0))
    split = with_plan(edges).withColumn(
        "_part", F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_rest") - ahead))
    )
    mixed = inside.unionByName(split)
    whole = (F.col("_part") == F.col("_size")) & (F.col("_size") > 0)
    return mixed.select(
        F.col("_doc_id").alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_epochs") * F.col("_size") + F.col("_part")).alias("taken"),
        # A last take of all words is a whole one.
        (F.col("_epochs") + whole.cast("bigint")).alias("epochs"),
        F.when(whole, F.lit(0)).otherwise(F.col("_part")).cast("bigint").alias("part"),
        *(f"keep_{name}" for name in keep),
    )


PLAN_COLUMNS = ("_start", "source_size", "target", "_epochs", "_rest")


def _plan(narrow, weights, max_epochs, share) -> tuple[DataFrame, DataFrame]:
    """Per source and bucket what is taken of it; the buckets in which a target falls come apart."""
    buckets = narrow.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_bucket_size"))
    sizes = buckets.groupBy(F.col("_source").alias("source")).agg(
        F.sum("_bucket_size").alias("source_size")
    )
    targets = source_targets(sizes, weights, max_epochs, share)
    rounded = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(rounded / F.col("source_size"))).otherwise(0)
    targets = (
        targets.withColumn("_epochs", epochs.cast("bigint"))
        .withColumn("_rest", rounded - F.col("_epochs") * F.col("source_size"))
        .withColumnRenamed("source", "_named")
    )
    before = (
        Window.partitionBy("_source")
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    plan, seen = materialize_and_measure(
        buckets.withColumn("_start", F.coalesce(F.sum("_bucket_size").over(before), F.lit(0)))
        .join(targets, F.col("_source").eqNullSafe(F.col("_named")))
        .withColumn(
            "_edge",
            (F.col("_start") < F.col("_rest"))
            & (F.col("_start") + F.col("_bucket_size") > F.col("_rest")),
        )
        .select("_source", "_bucket", "_edge", *PLAN_COLUMNS),
        "mix-plan",
        rows=F.count(F.lit(1)),
        edges=F.count_if("_edge"),
    )

    def sized(part: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(part) if rows <= BROADCAST_ROWS else part

    return (
        sized(plan.where(~F.col("_edge")), seen["rows"]),
        sized(plan.where("_edge"), seen["edges"]),
    )


def first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its word number ``count``, white space as it was."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD_PATTERN}"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), "")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of a mix: one row per whole take, and the partial take cut to its words.

    Returns the columns of documents; ``n_chars`` is that of the text kept.
    """
    mixed = mix(docs, keep=("text", "lang"), **settings).where(F.col("taken") > 0)
    takes = F.concat(
        F.array_repeat(F.lit(False), F.col("epochs").cast("int")),
        F.when(F.col("part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")),
    )
    text = F.when(
        F.col("_cut"), first_words(F.col("keep_text"), F.col("part"))
    ).otherwise(F.col("keep_text"))
    return mixed.withColumn("_cut", F.explode(takes)).select(
        "doc_id",
        text.alias("text"),
        F.col("keep_lang").alias("lang"),
        "source",
        F.char_length(text).cast("bigint").alias("n_chars"),
    )


MIX_SQL_TEMPLATE = """
WITH sized AS (
  SELECT doc_id, source, md5('{seed}' || chr(31) || CAST(doc_id AS VARCHAR)) AS ord,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 3.0::DOUBLE AS cap, place,
         CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM sources)),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
  FROM weighed),
water AS (
  SELECT lev AS water FROM levels WHERE lev * w < cap ORDER BY cap / w, place LIMIT 1),
targets AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT water FROM water) * w, cap)) AS target FROM levels),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT)
                 ELSE 0 END AS epochs FROM targets),
ahead AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.epochs,
         CAST(round(p.target) AS BIGINT) - p.epochs * p.source_size AS rest,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ord, s.doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       epochs * size + greatest(0, least(size, rest - ahead)) AS taken
FROM ahead
"""

MIX_SQL = MIX_SQL_TEMPLATE.replace("{seed}", SEED)
