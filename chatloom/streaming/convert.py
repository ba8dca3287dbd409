"""Conversion of JSONL files as they arrive.

Conversion and validation look at one record only, so the batch expressions run unchanged and need
no state. Copies and splits need the whole data set and stay with the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatloom.functions.variant import DUPLICATE_KEYS_CONF
from chatloom.operators.convert import convert_records
from chatloom.sources.records import parse_lines


def converted_stream(spark: SparkSession, folder: str, record_format: str) -> DataFrame:
    """``raw, conversations, error`` of every line that is not blank."""
    spark.conf.set(DUPLICATE_KEYS_CONF, "true")
    lines = spark.readStream.text(folder).withColumnRenamed("value", "raw")
    converted = convert_records(parse_lines(lines), record_format)
    return converted.select(
        "raw", "conversations", F.coalesce("parse_error", "error").alias("error")
    )


def write_stream(converted: DataFrame, output_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Process all files that are there: valid records and rejected ones in a folder each."""
    valid = F.col("error").isNull()
    line = F.when(valid, F.to_json(F.struct("conversations"))).otherwise(
        F.to_json(F.struct("raw", "error"))
    )
    outcome = F.when(valid, "valid").otherwise("rejected")
    return (
        converted.select(line.alias("value"), outcome.alias("outcome"))
        .writeStream.format("text")
        .partitionBy("outcome")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(output_dir)
    )
