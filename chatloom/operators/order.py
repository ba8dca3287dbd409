"""Dense 0-based positions without a global sort.

Rows come in groups whose order is known and that have consecutive positions inside. Counting the
groups and adding up the counts gives every group its first index; the records themselves are not
moved. Up to ``BROADCAST_GROUPS`` groups are summed in one task, more of them range by range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.scratch import materialize, materialize_and_measure

# A table of group offsets up to this many rows is broadcast; a longer one is joined by shuffle.
BROADCAST_GROUPS = 100_000


def _with_offsets(
    df: DataFrame, groups: Sequence[str], sizes: DataFrame, few: int = BROADCAST_GROUPS
) -> DataFrame:
    """Add ``_offset``, the rows of all earlier groups, to each row; ``sizes`` has ``_rows``."""
    sizes, seen = materialize_and_measure(sizes, "group-sizes", groups=F.count(F.lit(1)))
    if seen["groups"] <= few:
        earlier = Window.orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)
        offset = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).cast("long")
        offsets = sizes.withColumn("_offset", offset).drop("_rows")
        return df.join(F.broadcast(offsets), list(groups))
    return df.join(ranged_offsets(sizes, groups), list(groups))


def ranged_offsets(sizes: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The same offsets in two levels: inside ranges of groups, and over the sums of the ranges."""
    ranged = materialize(
        sizes.repartitionByRange(*groups).withColumn("_range", F.spark_partition_id()),
        "group-ranges",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each range.
    starts = (
        ranged.groupBy("_range")
        .agg(F.sum("_rows").alias("_sum"))
        .select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    )
    inside = (
        Window.partitionBy("_range").orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.col("_start") + F.coalesce(F.sum("_rows").over(inside), F.lit(0))
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn("_offset", offset.cast("long"))
        .drop("_rows", "_range", "_start")
    )


def index_by_split(
    df: DataFrame, groups: Sequence[str], position: str, name: str, few: int = BROADCAST_GROUPS
) -> DataFrame:
    """Dense index from (file, split) groups in which ``position`` counts up by one.

    ``df`` must be materialized: positions taken from a scan may differ between two scans. More
    than ``few`` groups are added up in ranges.
    """
    sizes = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(position).alias("_first")
    )
    placed = _with_offsets(df, groups, sizes, few)
    return placed.withColumn(name, F.col("_offset") + F.col(position) - F.col("_first")).drop(
        "_offset", "_first"
    )


def index_by_order(df: DataFrame, order: str, name: str) -> DataFrame:
    """Dense index along ``order``, a unique column that may have gaps of any size.

    Rows are dealt into ranges of about equal numbers and numbered inside them, so there are as many
    groups as ranges, whatever the values are.
    """
    ranged = materialize(
        df.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("_range", F.spark_partition_id())
        # Counts up by one inside a partition.
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranges",
    )
    return index_by_split(ranged, ["_range"], "_at", name).drop("_range", "_at")
