"""Minimum-cost-flow resharding: from the files a table lies in to shards of given capacities.

Old shards are the table's files in the order of their paths (beyond ``MAX_OLD`` files, runs of
files), or what the caller's column says. Old shard ``i`` and new shard ``i`` are
the same place, so bytes that stay cost nothing and bytes that move cost their number (or a given
cost for each pair of places). The flow from old sizes to new capacities of least cost says how many
bytes go from where to where. It is realized by blocks: the rows of an old shard whose place in
their file hashes to one of ``BLOCKS`` values, moved whole. Ids and texts do not matter for that, so
an id or text with very many rows is spread like any other rows. Largest blocks go first, each to the
target with the most of its flow left, and blocks are so small that shards come out near their
capacities. Then the affected shards are written anew, rows ordered by block, with gapless slots; a
shard that no transfer touches keeps its file.

The driver sees block sizes (at most ``BLOCKS`` for each old shard, ``MAX_BLOCKS`` in all) and shard
sizes, never rows. The texts are shuffled once, by block, and written once.

Edge cases: a null text has no bytes besides the fixed ones and a crc of the empty text; rows that
repeat, null ids and ids with very many rows are spread row by row; a text larger than a shard's
share makes its shard larger; an empty table gives no rows; only ``doc_id`` and ``text`` are read
and written.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import delete_path, rename_path, scratch_path
from chatloom.operators.order import index_by_order

SHARDS = 24
ROW_BYTES = 8
BLOCKS = 2_048
MAX_BLOCKS = 100_000
MAX_OLD = 1_024

# Files whose numbers are broadcast; more are joined by shuffle.
BROADCAST_FILES = 100_000

# Bytes of one written file of a shard.
FILE_BYTES = 128 << 20


def min_cost_flow(
    sizes: Sequence[int], capacities: Sequence[int], cost: Callable[[int, int], int] | None = None
) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard, moving all of ``sizes`` at the least total cost.

    Successive shortest paths with potentials on the bipartite graph of shards. The default cost is
    0 for staying and 1 for moving. Raises if the capacities are too small.
    """
    if cost is None:
        cost = lambda old, new: 0 if old == new else 1
    if sum(sizes) > sum(capacities):
        raise ValueError("the new shards are too small for the old ones")
    olds, news = range(len(sizes)), range(len(capacities))
    supply, room = list(sizes), list(capacities)
    price = {(i, j): cost(i, j) for i in olds for j in news}
    flow: dict[tuple[int, int], int] = {}
    up, down = [0] * len(sizes), [0] * len(capacities)
    while any(supply):
        # Distances over residual edges from every old shard with bytes left, in reduced costs.
        far = {("o", i): 0 for i in olds if supply[i]}
        heap = [(0, node) for node in far]
        came: dict = {}
        settled = set()
        end = None
        while heap:
            distance, node = heapq.heappop(heap)
            if node in settled:
                continue
            settled.add(node)
            side, at = node
            if side == "n" and room[at]:
                end = node
                break
            if side == "o":
                steps = (
                    (("n", j), price[at, j] + up[at] - down[j]) for j in news
                )
            else:
                steps = (
                    (("o", i), down[at] - price[i, at] - up[i]) for i in olds if flow.get((i, at))
                )
            for other, length in steps:
                if distance + length < far.get(other, float("inf")):
                    far[other] = distance + length
                    came[other] = node
                    heapq.heappush(heap, (distance + length, other))
        limit = far[end]
        for side, at in settled:
            (up if side == "o" else down)[at] += far[side, at] - limit
        path = [end]
        while path[-1] in came:
            path.append(came[path[-1]])
        path.reverse()
        steps = list(zip(path, path[1:], strict=False))
        amount = min(
            supply[path[0][1]],
            room[end[1]],
            *(flow[b[1], a[1]] for a, b in steps if a[0] == "n"),
        )
        for a, b in steps:
            key, sign = ((a[1], b[1]), 1) if a[0] == "o" else ((b[1], a[1]), -1)
            flow[key] = flow.get(key, 0) + sign * amount
        supply[path[0][1]] -= amount
        room[end[1]] -= amount
    return {pair: amount for pair, amount in flow.items() if amount}


def equal_capacities(blocks: Sequence[tuple[int, int, int]], shards: int) -> list[int]:
    """Equal bytes for all shards, but for those that one very large block fills alone."""
    capacities: dict[int, int] = {}
    rest = sum(size for _, _, size in blocks)
    for old, _, size in sorted(blocks, key=lambda block: -block[2]):
        left = shards - len(capacities)
        if left <= 1 or size * left <= rest:
            break
        place = old if old < shards and old not in capacities else next(
            shard for shard in range(shards) if shard not in capacities
        )
        capacities[place] = size
        rest -= size
    open_shards = [shard for shard in range(shards) if shard not in capacities]
    for at, shard in enumerate(open_shards):
        capacities[shard] = rest // len(open_shards) + (at < rest % len(open_shards))
    return [capacities[shard] for shard in range(shards)]


def assign_blocks(
    blocks: Sequence[tuple[int, int, int]], flow: dict[tuple[int, int], int],
    capacities: Sequence[int],
) -> dict[tuple[int, int], int]:
    """The new shard of each block ``(old shard, number, bytes)``, whole blocks along the flow."""
    left = dict(flow)
    room = list(capacities)
    targets: dict[int, list[int]] = {}
    for old, new in sorted(flow):
        targets.setdefault(old, []).append(new)
    fullest = [(-space, shard) for shard, space in enumerate(room)]
    heapq.heapify(fullest)
    placed = {}
    for old, number, size in sorted(blocks, key=lambda block: (-block[2], block[0], block[1])):
        new = max(targets.get(old, []), key=lambda j: (min(left[old, j], room[j]), -j), default=-1)
        if new < 0 or min(left[old, new], room[new]) < size:
            # The rest of every flow is smaller than the block: the emptiest shard takes it.
            while -fullest[0][0] != room[fullest[0][1]]:
                heapq.heapreplace(fullest, (-room[fullest[0][1]], fullest[0][1]))
            new = fullest[0][1]
        if (old, new) in left:
            left[old, new] -= size
        room[new] -= size
        placed[old, number] = new
    return placed


def _rows(docs: DataFrame, olds: int, old: Column | None, blocks: int) -> DataFrame:
    """``doc_id``, ``text``, ``size``, ``text_crc32`` with old shard and block of every row."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        (F.octet_length(data) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        (F.lit(0) if old is None else old).cast("int").alias("_old"),
        F.pmod(F.xxhash64(file, row), F.lit(blocks)).cast("int").alias("_block"),
        file.alias("_file_path"),
    )
    if old is not None or olds == 1:
        return rows.drop("_file_path")
    # The number of a file among all is joined; the driver does not list paths.
    files = docs.select(file.alias("_file_path")).distinct()
    numbered = index_by_order(files, "_file_path", "_number")
    count = numbered.count()
    shard = F.floor(F.col("_number") * olds / count).cast("int")
    if count <= BROADCAST_FILES:
        numbered = F.broadcast(numbered)
    return (
        rows.drop("_old").join(numbered, "_file_path").withColumn("_old", shard)
    ).drop("_file_path", "_number")


def uneven_shard(shards: int) -> Column:
    """An old shard for each row of a table's files: shard sizes grow in even steps."""
    at = F.pmod(
        F.xxhash64(F.lit("old"), F.col("_metadata.file_path"), F.col("_metadata.row_index")),
        F.lit(1 << 30),
    )
    return F.floor(F.sqrt(at / float(1 << 30)) * shards)


def reshard(
    docs: DataFrame, shards: int = SHARDS, capacities: Sequence[int] | None = None,
    cost: Callable[[int, int], int] | None = None, target: str | None = None,
    file_bytes: int = FILE_BYTES, old: Column | None = None, old_shards: int = 1,
) -> tuple[DataFrame, dict]:
    """Put ``docs``, read from Parquet files, into ``shards`` shards; return the rows and the plan.

    Rows lie in the shards that ``old`` says (0 to ``old_shards`` - 1, at most ``MAX_OLD`` shards;
    an expression over a row's columns and file place), without it in those of their files.
    Without ``capacities`` all shards get equal bytes. Affected shards are written as Parquet files
    below ``shard=<n>`` of a folder that appears in one step when all is written, and read back;
    rows of kept shards come from the files where they are. The plan has that folder, old sizes,
    capacities, flow, moved bytes, kept shards and resulting sizes.
    """
    spark = docs.sparkSession
    if old is None:
        files = docs.select(F.col("_metadata.file_path")).distinct().count()
        olds = max(1, min(files, MAX_OLD))
    elif not 0 < old_shards <= MAX_OLD:
        raise ValueError(f"1 to {MAX_OLD} old shards")
    else:
        olds = old_shards
    rows = _rows(docs, olds, old, max(1, min(BLOCKS, MAX_BLOCKS // olds)))
    counted = rows.groupBy("_old", "_block").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    found = [tuple(row) for row in counted.collect()]  # at most MAX_BLOCKS
    old_sizes = [0] * olds
    for old, _, size, _ in found:
        old_sizes[old] += size
    if capacities is None:
        capacities = equal_capacities([block[:3] for block in found], shards)
    flow = min_cost_flow(old_sizes, capacities, cost)
    placed = assign_blocks([block[:3] for block in found], flow, capacities)

    sizes, slots = [0] * len(capacities), [0] * len(capacities)
    plan_rows = []
    for place, (old, number, size, count) in enumerate(sorted(found)):
        shard = placed[old, number]
        plan_rows.append((old, number, shard, slots[shard], sizes[shard] // file_bytes, place))
        sizes[shard] += size
        slots[shard] += count
    moves = {(old, new) for (old, _), new in placed.items() if old != new}
    touched = {shard for move in moves for shard in move}
    kept = sorted({old for old, _ in placed} - touched)
    # Bounded by MAX_BLOCKS rows of six numbers.
    plan_frame = spark.createDataFrame(
        plan_rows, "_old int, _block int, shard int, _first bigint, _file bigint, _place int"
    )
    # The rows of a file come together once; blocks are numbered and sorted inside it.
    in_block = Window.partitionBy("shard", "_file", "_place").orderBy("doc_id", "text_crc32", "size")
    dealt = (
        rows.join(F.broadcast(plan_frame), ["_old", "_block"])
        .repartition("shard", "_file")
        .withColumn("slot", F.col("_first") + F.row_number().over(in_block) - 1)
        .select("doc_id", "text", "slot", "shard")
    )
    final = target or scratch_path(spark, "shards")
    folder = f"{final}.writing"
    dealt.where(~F.col("shard").isin(kept)).write.partitionBy("shard").mode("overwrite").parquet(
        folder
    )
    if not rename_path(spark, folder, final):
        delete_path(spark, folder)
        raise FileExistsError(final)
    written = spark.read.schema(dealt.schema).parquet(final)
    if kept:
        written = written.unionByName(dealt.where(F.col("shard").isin(kept)))
    return written, {
        "folder": final,
        "old_sizes": old_sizes,
        "capacities": list(capacities),
        "flow": flow,
        "moved": sum(size for old, number, size, _ in found if placed[old, number] != old),
        "kept": kept,
        "sizes": sizes,
    }


def digests(rows: DataFrame) -> DataFrame:
    """Sizes and checksums of resharded rows; the layout's law is equal bytes."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return rows.select(
        "doc_id",
        (F.octet_length(data) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
