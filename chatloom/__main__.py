"""Command line: ``python -m chatloom prepare|dedup``, also as a spark-submit application."""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession

from chatloom.operators.embed import Encoder
from chatloom.params import (
    BAD_RECORD_MODES,
    DEDUP_FIELDS,
    MATCHING_MODES,
    RECORD_FORMATS,
    TEXT_MODES,
    DedupParams,
    PrepareParams,
    config_object,
)
from chatloom.plans.dedup import deduplicate_file
from chatloom.plans.prepare import prepare_file
from chatloom.scratch import discard


def main(arguments: list[str] | None = None) -> int:
    options = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"chatloom-{options.job}").getOrCreate()
    try:
        options.run(spark, options)
    finally:
        discard(spark)
    return 0


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="chatloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    prepare = jobs.add_parser("prepare", help="convert, deduplicate and split records")
    _common(prepare)
    prepare.add_argument("--format", required=True, choices=RECORD_FORMATS)
    prepare.add_argument("--eval-ratio", type=float, default=0.1)
    prepare.add_argument("--seed", type=int, default=42)
    prepare.add_argument("--semantic-dedup", action="store_true")
    prepare.add_argument("--dedup-model", dest="model_name_or_path")
    prepare.add_argument("--dedup-threshold", dest="similarity_threshold", type=float)
    prepare.add_argument("--dedup-text-mode", dest="text_mode", choices=TEXT_MODES)
    prepare.add_argument("--dedup-batch-size", dest="batch_size", type=int)
    prepare.add_argument("--dedup-compare-chunk-size", dest="compare_chunk_size", type=int)
    prepare.add_argument("--dedup-device", dest="device")
    prepare.add_argument("--dedup-max-seq-length", dest="max_seq_length", type=int)
    prepare.add_argument("--dedup-matching", dest="matching", choices=MATCHING_MODES)
    prepare.add_argument("--dedup-recall", dest="recall", type=float)
    prepare.set_defaults(run=_prepare)

    dedup = jobs.add_parser("dedup", help="remove copies and near copies")
    _common(dedup)
    dedup.add_argument("--config", help="JSON file with any of the settings below")
    dedup.add_argument("--model-name-or-path")
    dedup.add_argument("--similarity-threshold", type=float)
    dedup.add_argument("--text-mode", choices=TEXT_MODES)
    dedup.add_argument("--batch-size", type=int)
    dedup.add_argument("--compare-chunk-size", type=int)
    dedup.add_argument("--device")
    dedup.add_argument("--max-seq-length", type=int)
    dedup.add_argument("--trust-remote-code", action=argparse.BooleanOptionalAction, default=None)
    dedup.add_argument("--matching", choices=MATCHING_MODES)
    dedup.add_argument("--recall", type=float)
    dedup.add_argument("--compression", help="codec of the records that are written, such as gzip")
    dedup.set_defaults(run=_dedup)
    return parser


def _common(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--input", required=True, help="file or folder of records")
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--layout", default="auto", choices=("auto", "lines", "document"))
    parser.add_argument("--bad-records", default="fail", choices=BAD_RECORD_MODES)
    parser.add_argument("--encoder", help="module:function that returns an embedding function")


def _encoder(options: argparse.Namespace) -> Encoder | None:
    if not options.encoder:
        return None
    module, _, function = options.encoder.partition(":")
    return getattr(importlib.import_module(module), function)


def _dedup_params(options: argparse.Namespace, config: dict | None = None) -> DedupParams:
    given = {name: getattr(options, name, None) for name in DEDUP_FIELDS}
    return DedupParams.resolve(config, given)


def _prepare(spark: SparkSession, options: argparse.Namespace) -> None:
    dedup = _dedup_params(options) if options.semantic_dedup else None
    params = PrepareParams(options.format, options.eval_ratio, options.seed, dedup)
    result = prepare_file(
        spark,
        options.input,
        options.output_dir,
        params,
        encoder=_encoder(options),
        layout=options.layout,
        bad_records=options.bad_records,
    )
    _show(result.stats.first().asDict(recursive=True))
    errors = result.errors.collect()
    if errors:
        print("Records that were left out, with their first error:")
    for row in errors:
        print(f"- {row.message}")


def _dedup(spark: SparkSession, options: argparse.Namespace) -> None:
    config = None
    if options.config:
        text = spark.read.text(options.config, wholetext=True).first()
        config = config_object(text.value)
    result = deduplicate_file(
        spark,
        options.input,
        options.output_dir,
        _dedup_params(options, config),
        encoder=_encoder(options),
        layout=options.layout,
        bad_records=options.bad_records,
        compression=options.compression,
    )
    _show(result.report.first().asDict(recursive=True))


def _show(report: dict) -> None:
    print(json.dumps(report, ensure_ascii=False, indent=2))


if __name__ == "__main__":
    raise SystemExit(main())
