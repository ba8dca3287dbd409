"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import delete_path
from chatloom.scratch import materialize_and_measure

MAX_ROUNDS = 100


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of ``u``, ``v``.

    Each star step is an aggregation with partial sums and a join of the edges to one row per node,
    which adaptive execution splits where a node has very many edges. Every round is written to the
    shared folder, which also cuts the lineage.
    """
    previous = None
    stars, seen = _written(edges.where(F.col("u") != F.col("v")))
    for _ in range(MAX_ROUNDS):
        state = (seen["edges"], seen["digest"])
        if state == previous or seen["edges"] == 0:
            roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).distinct()
        previous = state
        done = stars
        stars, seen = _written(_small_star(_large_star(stars)))
        for path in done.inputFiles()[:1]:
            delete_path(done.sparkSession, path.rsplit("/", 1)[0])
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _written(edges: DataFrame):
    """Edges from the greater to the lesser node."""
    ordered = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    return materialize_and_measure(
        ordered,
        "stars",
        edges=F.count(F.lit(1)),
        digest=F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)),
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(
        F.col("u") != F.col("v")
    )
    least = ordered.groupBy("u").agg(F.min("v").alias("m"))
    joined = ordered.join(least, "u")
    hung = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (
        hung.unionByName(least.select("u", F.col("m").alias("v")))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )
