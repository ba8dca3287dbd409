"""A training corpus from documents: what is toxic goes, then near copies, then personal data; the
rest is mixed to target weights and packed. ``run`` chains the stages; a driver may write each
stage's rows and read them as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import op3_jaccard_join, op6_toxicity, op7_packing, op9_mixing, op10_pii
from chatloom.llm.common import materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    labels = table(spark, sf_dir, "labels")
    return op6_toxicity.without_toxic(docs.select(*COLUMNS), labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id."""
    return op3_jaccard_join.representatives(docs.select(*COLUMNS))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, detected entities replaced by surrogates."""
    chosen = docs.select(*COLUMNS)
    key = op10_pii.collision_free_key(chosen)
    return op10_pii.replace_entities(chosen, key).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document."""
    return op9_mixing.mixed_documents(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return op7_packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Toxicity, the forest and tokenization are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
