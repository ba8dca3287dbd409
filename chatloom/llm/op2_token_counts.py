"""Token counts kept up to date by deltas.

A store holds additive totals by source, language and tokenizer version. Changes come in batches:
``insert`` adds a document's tokens, ``delete`` takes them off, and ``revise`` replaces an earlier
count by a new one. A batch becomes signed sums, one row per group, which are written below a
temporary name and moved to ``batches/<id>`` in one step. A batch id that is there already changes
nothing, so batches can be sent again after a failure. Totals are the sum over the batches and the
latest snapshot; ``compact`` folds batches into a new snapshot that names what it holds.

Sums are aggregated before any shuffle, so a group with a third of all rows is one row per task.
Edge cases: null source, language or version are groups of their own; a null count is 0; counts may
repeat; an empty batch is committed and changes nothing; totals that come to no documents and no
tokens are not listed; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import delete_path, materialize, rename_path, scratch_path
from chatloom.llm.word_pieces import TOKENIZER_FILE, encoder
from chatloom.operators.skew import SALTS, lookup

GROUP = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, documents bigint, tokens bigint"
_BATCH_ID = re.compile(r"[A-Za-z0-9._-]+\Z")


def count_tokens(docs: DataFrame, vocabulary: str = TOKENIZER_FILE) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, the text's 128-bit ``key`` and its number of ``tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            counts = [np.diff(ends, prepend=0) for _, ends in encode(batch.column(4))]
            counts = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(counts, pa.int64())],
                ["doc_id", "source", "lang", "key", "tokens"],
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("source").cast("string"),
        F.col("lang").cast("string"),
        F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32)).alias("key"),
        text.alias("text"),
    ).mapInArrow(
        run, "doc_id bigint, source string, lang string, key binary, tokens bigint"
    )


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of a batch of changes: ``op``, the group, ``tokens`` and, to revise,
    ``old_tokens`` (and ``old_source``, ``old_lang``, ``old_tokenizer`` where the group changed)."""
    columns = changes.columns
    tokens = F.coalesce(F.col("tokens"), F.lit(0)).cast("bigint")

    def old(name: str):
        return F.col(f"old_{name}") if f"old_{name}" in columns else F.col(name)

    def part(sign: int, count, group: dict):
        return F.struct(
            *(column.cast("string").alias(name) for name, column in group.items()),
            F.lit(sign).cast("bigint").alias("documents"),
            (F.lit(sign) * count).cast("bigint").alias("tokens"),
        )

    now = {name: F.col(name) for name in GROUP}
    before = {name: old(name) for name in GROUP}
    was = F.coalesce(old("tokens"), F.lit(0)).cast("bigint")
    signed = (
        F.when(F.col("op") == "insert", F.array(part(1, tokens, now)))
        .when(F.col("op") == "delete", F.array(part(-1, tokens, now)))
        .when(F.col("op") == "revise", F.array(part(-1, was, before), part(1, tokens, now)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))))
    )
    return (
        changes.select(F.explode(signed).alias("d"))
        .groupBy(*(F.col(f"d.{name}").alias(name) for name in GROUP))
        .agg(F.sum("d.documents").alias("documents"), F.sum("d.tokens").alias("tokens"))
    )


class TokenStore:
    """Totals below ``folder``: ``batches/<id>/<attempt>`` and ``snapshots/<number>``.

    A batch is written below the store and moved to a name of its own, so writers of the same batch
    never meet; of several attempts that arrived, the first by time and name counts, for all readers.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _list(self, name: str) -> list[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        found = [(s.getModificationTime(), s.getPath().getName()) for s in files.listStatus(path)]
        return [name for _, name in sorted(found)]

    def _attempt(self, batch_id: str) -> str:
        """The attempt of a committed batch that counts."""
        return f"{self.folder}/batches/{batch_id}/{self._list(f'batches/{batch_id}')[0]}"

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """The newest snapshot and the batches that it holds."""
        numbers = [name for name in self._list("snapshots") if not name.startswith("_")]
        if not numbers:
            return None, set()
        newest = max(numbers, key=int)
        names = self.spark.read.text(f"{self.folder}/snapshots/{newest}/names").collect()
        return newest, {row[0] for row in names}

    def committed(self) -> set[str]:
        return set(self._list("batches")) | self._snapshot()[1]

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit a batch once; False if this id has been committed before."""
        if not _BATCH_ID.match(batch_id):
            raise ValueError(f"a batch id of letters, digits, '.', '_' and '-': {batch_id!r}")
        if batch_id in self.committed():
            return False
        attempt = uuid4().hex
        writing = f"{self.folder}/_writing/{attempt}"
        deltas(changes).write.parquet(writing)
        final = f"{self.folder}/batches/{batch_id}/{attempt}"
        if not rename_path(self.spark, writing, final):
            raise OSError(f"{writing} could not be moved to {final}")
        return self._attempt(batch_id) == final

    def totals(self) -> DataFrame:
        """The additive totals of all committed batches."""
        newest, held = self._snapshot()
        paths = [self._attempt(name) for name in self._list("batches") if name not in held]
        if newest is not None:
            paths.append(f"{self.folder}/snapshots/{newest}/totals")
        if not paths:
            return self.spark.createDataFrame([], TOTALS)
        sums = (
            self.spark.read.schema(TOTALS)
            .parquet(*paths)
            .groupBy(*GROUP)
            .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        )
        return sums.where((F.col("documents") != 0) | (F.col("tokens") != 0))

    def compact(self) -> None:
        """Fold all committed batches into a new snapshot, then remove them and the old one."""
        newest, _ = self._snapshot()
        names = sorted(self.committed())
        number = str(int(newest or 0) + 1)
        writing = f"{self.folder}/_writing/{uuid4().hex}"
        self.totals().write.parquet(f"{writing}/totals")
        self.spark.createDataFrame([(name,) for name in names], "value string").write.text(
            f"{writing}/names"
        )
        if not rename_path(self.spark, writing, f"{self.folder}/snapshots/{number}"):
            raise FileExistsError(f"snapshot {number}")
        for name in names:
            delete_path(self.spark, f"{self.folder}/batches/{name}")
        if newest is not None:
            delete_path(self.spark, f"{self.folder}/snapshots/{newest}")


def corpus_changes(counted: DataFrame) -> dict[str, DataFrame]:
    """The life of a corpus as batches: all documents are loaded, copies of a text but the one with
    the least id are deleted, they come back, and all are recounted with an end id. So the totals in
    the end are those of all documents.

    ``counted`` is a written table of ``count_tokens`` with a unique number ``row``.
    """
    rows = counted.withColumn("tokenizer", F.lit("word_bpe_49k"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    firsts = rows.groupBy("key").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    # A text with more than 1/128 of all rows is dealt to many tasks; there are fewer than 128.
    limit = rows.count() // SALTS + 1
    hot = [row[0] for row in firsts.where(F.col("copies") > limit).select("key").collect()]
    marked = lookup(rows, firsts.select("key", "first"), "key", F.col("row"), hot)
    stays = F.col("first.row") == F.col("row")
    return {
        "load": rows.withColumn("op", F.lit("insert")),
        "copies": marked.where(~stays).withColumn("op", F.lit("delete")),
        "copies-again": marked.where(~stays).withColumn("op", F.lit("insert")),
        "end-ids": rows.withColumn("op", F.lit("revise"))
        .withColumn("old_tokens", F.col("tokens"))
        .withColumn("tokens", F.col("tokens") + 1),
    }


def rollup(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Totals of a corpus after its batches; each is sent twice, as after a failure."""
    spark = docs.sparkSession
    counted = materialize(
        count_tokens(docs).withColumn("row", F.monotonically_increasing_id()), "token-counts"
    )
    store = TokenStore(spark, folder or scratch_path(spark, "token-store"))
    for _ in range(2):
        for batch_id, changes in corpus_changes(counted).items():
            store.apply(batch_id, changes)
    return store.totals()
