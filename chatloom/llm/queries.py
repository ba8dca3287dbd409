"""One query for each operator of this subpackage over its whole table, and SQL where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import (
    op1_warc,
    op2_token_counts,
    op3_jaccard_join,
    op4_fingerprint,
    op5_neighbours,
    op6_toxicity,
    op7_packing,
    op8_resharding,
    op9_mixing,
    op10_pii,
    op11_best_fit,
    op12_alignment,
    op13_collocations,
)
from chatloom.llm.common import table


OLD_SHARDS = 16


def op1_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = op1_warc.archive(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_token_counts.rollup(table(spark, sf_dir, "documents"))


def op3_jaccard_join_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op7_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_resharded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The rows as if they lay in shards of very unequal size, so that the flow has work to do.
    rows, _ = op8_resharding.reshard(
        table(spark, sf_dir, "documents"),
        old=op8_resharding.uneven_shard(OLD_SHARDS),
        old_shards=OLD_SHARDS,
    )
    return op8_resharding.digests(rows)


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op9_mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    key = op10_pii.collision_free_key(docs)
    replaced = op10_pii.replace_entities(docs, key)
    return replaced.select("doc_id", "text", "n_chars", "entity_kinds")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_best_fit.pack_documents(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_alignment.link_counts(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc_archives": op1_warc_archives,
    "op2_token_rollup": op2_token_rollup,
    "op3_jaccard_join_documents": op3_jaccard_join_documents,
    "op4_fingerprints": op4_fingerprints,
    "op5_nearest_vectors": op5_nearest_vectors,
    "op6_toxicity_scores": op6_toxicity_scores,
    "op7_packed_sequences": op7_packed_sequences,
    "op8_resharded_documents": op8_resharded_documents,
    "op9_mix_sources": op9_mix_sources,
    "op10_surrogates": op10_surrogates,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_token_alignment": op12_token_alignment,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLES = {
    "op1_warc_archives": op1_warc.WARC_SQL,
    "op9_mix_sources": op9_mixing.MIX_SQL,
    "op13_phrase_collocations": op13_collocations.COLLOCATION_SQL,
}
