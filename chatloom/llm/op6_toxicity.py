"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its lower-cased words, pairs of neighbours, and pairs with one or two words
between, each present or not, hashed to 2**22 places. Training goes through a sample of labelled rows in hash order with a
learning rate for each coordinate; L1 keeps a weight at exactly zero until enough evidence has
gathered, and a feature counts only from its third row on, so the model is some hundreds to
thousands of (place, weight) pairs, which is what is broadcast to score every text.

The sample is bounded by ``SAMPLE_ROWS`` labelled rows, chosen by a hash of the id, and is the only
thing that passes through one task, which keeps it in a file, however long its texts. Scores never
depend on anything but the text.

Edge cases: null and empty texts have no features and get the score of the intercept; ids without
a label are scored only; a label that is null is none, and of several labels of an id the highest
counts; rows that repeat are scored each; without any labelled row the score is 0.1 everywhere; long
texts count whole.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import fresh, hand_back_memory

# Labelled rows that the classifier is fitted on at most, give or take the chance of the hash.
SAMPLE_ROWS = 20_000
# Texts whose features a task makes at a time.
EXTRACT_ROWS = 64
FOLDS = 5
HASH_BITS = 22
MIN_ROWS = 3
EPOCHS = 4
ALPHA, BETA, L1, L2 = 3.0, 1.0, 5.0, 1.0

# Skips of word pairs: neighbours, then one and two words between.
GAPS = (1, 2, 3)
_WORD = re.compile(r"\w+")
# Fixed odd multipliers: one for each kind of feature.
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93],
    dtype=np.uint64,
)
_SHUFFLE_SPACE = 1_000_000


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def features(text: str | None) -> np.ndarray:
    """The sorted places of a text's features."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, dtype=np.int32)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(word.encode("utf-8", "surrogatepass")) for word in words), np.uint64, len(words)
    )
    kinds = [hashes * _MULTIPLIERS[0]]
    for gap in GAPS:
        if len(hashes) > gap:
            left, right = hashes[:-gap], hashes[gap:]
            kinds.append((left ^ (right >> np.uint64(7)) ^ (right << np.uint64(57))) * _MULTIPLIERS[gap])
    places = np.concatenate(kinds) >> np.uint64(64 - HASH_BITS)
    return np.unique(places.astype(np.int32))


def _stored(rows: Iterable[tuple[np.ndarray, int]], file: BinaryIO) -> tuple[np.ndarray, ...]:
    """The rows' places, in order, in ``file``, numbered among those of ``MIN_ROWS`` rows at least, which
    are returned, too, with the rows' ends and labels."""
    seen = np.zeros(1 << HASH_BITS, dtype=np.int32)
    sizes, labels = [], []
    for places, label in rows:
        seen[places] += 1
        file.write(places.tobytes())
        sizes.append(len(places))
        labels.append(label)
    file.flush()
    total = sum(sizes)
    if not total:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.zeros(len(sizes), np.int64), np.array(labels, np.int32)
    stored = np.asarray(np.memmap(file, dtype=np.int32, mode="r+", shape=(total,)))
    common = seen >= MIN_ROWS
    number = np.cumsum(common, dtype=np.int32) - np.int32(1)
    # Rows lose the places that are too rare, so what is written never gets ahead of what is read.
    start = end = 0
    for at, size in enumerate(sizes):
        places = stored[start : start + size]
        start += size
        kept = number[places[common[places]]]
        stored[end : end + len(kept)] = kept
        end += len(kept)
        sizes[at] = len(kept)
    return np.flatnonzero(common), stored[:end], np.cumsum(sizes), np.array(labels, np.int32)


def fit(rows: Iterable[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and weights that are not zero, and the intercept, from (places, label) in order.

    The rows are read once and lie in a file of the task's folder, which is mapped: memory depends on the
    number of places that are in use, not on the length of the texts.
    """
    with tempfile.TemporaryFile() as file:
        return _fit(*_stored(rows, file))


def _fit(
    common: np.ndarray, stored: np.ndarray, ends: np.ndarray, labels: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    positive = int(labels.sum())
    intercept = float(np.log((positive + 1) / (len(labels) - positive + 9)))
    z, n = np.zeros(len(common)), np.zeros(len(common))
    bias_z, bias_n = 0.0, 0.0
    bias = intercept
    for _ in range(EPOCHS):
        start = 0
        for end, label in zip(ends.tolist(), labels.tolist(), strict=True):
            places = stored[start:end]
            start = end
            zs, ns = z[places], n[places]
            roots = np.sqrt(ns)
            weights = np.where(
                np.abs(zs) > L1,
                (np.sign(zs) * L1 - zs) / ((BETA + roots) / ALPHA + L2),
                0.0,
            )
            score = 1.0 / (1.0 + np.exp(-np.clip(weights.sum() + bias, -35, 35)))
            slope = score - label
            z[places] = zs + slope - (np.sqrt(ns + slope * slope) - roots) / ALPHA * weights
            n[places] = ns + slope * slope
            step = (np.sqrt(bias_n + slope * slope) - np.sqrt(bias_n)) / ALPHA
            bias_z += slope - step * (bias - intercept)
            bias_n += slope * slope
            bias = intercept - bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA + L2)
    active = np.flatnonzero(np.abs(z) > L1)
    weights = (np.sign(z[active]) * L1 - z[active]) / ((BETA + np.sqrt(n[active])) / ALPHA + L2)
    return common[active].astype(np.int32), weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple:
    """The model of ``fit`` for the labelled rows outside the held-out fold."""
    usable = (
        labels.where((fold(F.col("doc_id")) != 0) & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("_label"))
    )
    share = min(1.0, SAMPLE_ROWS / max(1, usable.count()))
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity"))
    sampled = usable.withColumn("_order", order).where(
        F.pmod("_order", F.lit(_SHUFFLE_SPACE)) < int(share * _SHUFFLE_SPACE)
    )

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), EXTRACT_ROWS):
                part = frame.iloc[start : start + EXTRACT_ROWS]
                yield pd.DataFrame(
                    {
                        "order": part["_order"],
                        "label": part["_label"],
                        "places": [features(text).tobytes() for text in part["text"]],
                    }
                )
        hand_back_memory()

    # The sampled ids are bounded by SAMPLE_ROWS, so they are broadcast to the scan of the texts.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sampled), "doc_id")
        .select("_order", "_label", "text")
        .mapInPandas(extract, "order bigint, label int, places binary")
        .repartition(1)
        .sortWithinPartitions("order", "label", "places")
    )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = (
            (np.frombuffer(places.as_buffer(), dtype=np.int32), label.as_py())
            for batch in batches
            for label, places in zip(batch.column(0), batch.column(1), strict=True)
        )
        places, weights, bias = fit(data)
        hand_back_memory()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(places, -1), pa.int32()), pa.array(np.append(weights, bias))],
            ["place", "weight"],
        )

    model = rows.select("label", "places").mapInArrow(fitted, "place int, weight double").toPandas()
    inside = model[model["place"] >= 0]
    bias = float(model.loc[model["place"] < 0, "weight"].iloc[0]) if len(model) else np.log(1 / 9)
    return inside["place"].to_numpy(np.int32), inside["weight"].to_numpy(), bias


def score(docs: DataFrame, model: tuple, keep: tuple[str, ...], name: str) -> DataFrame:
    """The columns ``keep`` of every row and its score as column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(*keep, F.col("text").alias(fresh("scored_text", keep)))
    fields = ", ".join(f"`{column}` {kind}" for column, kind in narrow.dtypes[:-1])
    names = [*keep, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, bias = shared.value
        dense = np.zeros(1 << HASH_BITS, dtype=np.float64)
        dense[places] = weights
        for batch in batches:
            *kept, texts = batch.columns
            sums = np.array([dense[features(text.as_py())].sum() for text in texts], dtype=float)
            scores = 1.0 / (1.0 + np.exp(-np.clip(sums + bias, -35, 35)))
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names)
        del dense
        hand_back_memory()

    return narrow.mapInArrow(run, f"{fields}, `{name}` double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, train(docs, labels), ("doc_id",), "score")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold."""
    name = fresh("score", docs.columns)
    scored = score(docs, train(docs, labels), tuple(docs.columns), name)
    return scored.where(F.col(name) < threshold).select(*docs.columns)
