"""From raw records to train and eval sets as one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.convert import convert_records, error_sample
from chatloom.operators.embed import Encoder, require_encoder
from chatloom.operators.exact import conversation_key, drop_rows, exact_copies
from chatloom.operators.report import EXACT, INVALID, RETAINED, SEMANTIC, dataset_stats
from chatloom.operators.split import eval_size, seeded_order, train_eval_split
from chatloom.operators.texts import text_of_conversations
from chatloom.params import PrepareParams
from chatloom.plans.dedup import DedupResult, deduplicate, write_log
from chatloom.scratch import materialize, materialize_and_measure
from chatloom.sources.outputs import Outputs
from chatloom.sources.records import (
    number_records,
    require_clean,
    scan_records,
    source_checks,
)
from chatloom.sources.sinks import write_jsonl, write_report


@dataclass(frozen=True)
class PrepareResult:
    """``prepared`` has ``source_index, conversations, split``; ``quarantine`` the rejected rows."""

    prepared: DataFrame
    quarantine: DataFrame
    errors: DataFrame
    stats: DataFrame
    dedup: DedupResult | None


def prepare(
    converted: DataFrame,
    params: PrepareParams,
    *,
    vectors: DataFrame | None = None,
    vector_key: str = "row_index",
    encoder: Encoder | None = None,
) -> PrepareResult:
    """Deduplicate and split materialized ``source_index, conversations, error`` rows."""
    params.validate()
    is_valid = F.col("error").isNull()
    valid = converted.where(is_valid)
    keyed, seen = materialize_and_measure(
        valid.select("source_index", conversation_key(F.col("conversations")).alias("key")),
        "conversation-keys",
        rows=F.count(F.lit(1)),
    )
    copies, n_copies = exact_copies(keyed, "source_index")
    unique, kept = valid.select("source_index", "conversations"), seen["rows"] - n_copies
    if n_copies:
        copies = materialize(copies.select("source_index"), "copies")
        unique = drop_rows(unique, copies, "source_index")
    dedup = None
    if params.dedup is not None:
        dedup = _near_copies(unique, params, vectors, vector_key, encoder)
        kept -= dedup.semantic_removed
        unique = unique.join(dedup.retained.select("source_index"), "source_index", "left_semi")
    # All guards come before the first output is written.
    eval_size(kept, params.eval_ratio)
    unique = materialize(unique, "retained")
    prepared = train_eval_split(unique, kept, params.eval_ratio, params.seed)
    quarantine = converted.where(~is_valid).select(
        (F.col("source_index") + 1).alias("record_no"),
        *(["raw"] if "raw" in converted.columns else []),
        "error",
    )
    labelled = prepared.select("source_index", "split", F.lit(RETAINED).alias("status"))
    for rows, status in (
        (quarantine.select((F.col("record_no") - 1).alias("source_index")), INVALID),
        (copies if n_copies else None, EXACT),
        (dedup and dedup.labels.where(F.col("status") == SEMANTIC), SEMANTIC),
    ):
        if rows is not None:
            labelled = labelled.unionByName(
                rows.select("source_index", F.lit(status).alias("status")),
                allowMissingColumns=True,
            )
    return PrepareResult(
        prepared=prepared,
        quarantine=quarantine,
        errors=error_sample(quarantine, "record_no"),
        stats=dataset_stats(labelled, semantic_enabled=dedup is not None, seed=params.seed),
        dedup=dedup,
    )


def _near_copies(
    unique: DataFrame,
    params: PrepareParams,
    vectors: DataFrame | None,
    vector_key: str,
    encoder: Encoder | None,
) -> DedupResult:
    texts = text_of_conversations(unique, params.dedup.text_mode)
    # The job reads its records several times.
    records = materialize(
        texts.select(
            "source_index",
            F.to_json(F.struct("conversations")).alias("record"),
            "text",
            "text_error",
        ),
        "dedup-records",
    )
    return deduplicate(
        records, params.dedup, vectors=vectors, vector_key=vector_key, encoder=encoder, exact=False
    )


def prepare_file(
    spark: SparkSession,
    path: str,
    output_dir: str,
    params: PrepareParams,
    *,
    encoder: Encoder | None = None,
    layout: str = "auto",
    bad_records: str = "fail",
) -> PrepareResult:
    """Read, convert, deduplicate, split, and write both sets with the reports.

    Records that cannot be converted are always set aside; text that is no JSON object fails the
    job unless ``bad_records`` is ``quarantine``. All outputs appear together, or none.
    """
    params.validate()
    names = ["train/train.jsonl", "eval/eval.jsonl", "dataset_stats.json"]
    if params.dedup is not None:
        require_encoder(params.dedup, encoder)
        names += ["semantic_dedup_report.json", "semantic_duplicates_removed.jsonl"]
    outputs = Outputs(spark, output_dir, names)
    outputs.require_free()
    scanned = convert_records(scan_records(spark, path, layout=layout), params.record_format)
    read, checks = materialize_and_measure(scanned.drop("v"), "converted", **source_checks())
    require_clean(spark, path, checks, layout=layout, bad_records=bad_records)
    records = number_records(read).withColumn("error", F.coalesce("parse_error", "error"))
    result = prepare(records, params, encoder=encoder)
    with outputs:
        if result.dedup is not None:
            write_report(result.dedup.report, outputs.path("semantic_dedup_report.json"))
            write_log(result.dedup.removed, outputs.path("semantic_duplicates_removed.jsonl"))
        line = F.to_json(F.struct("conversations"))
        for split in ("train", "eval"):
            rows = seeded_order(result.prepared.where(F.col("split") == split), params.seed)
            write_jsonl(rows, outputs.path(f"{split}/{split}.jsonl"), line)
        write_report(result.stats, outputs.path("dataset_stats.json"))
    return result
