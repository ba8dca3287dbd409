"""Every operator as a query over whole tables.

The tables hold clean text, so error paths are reached by writing some records in another way,
depending on the length of their text: with a key absent, null, blank or of another type, with
another role, or as malformed JSON. No row is left out for that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions import chat
from chatloom.functions.variant import DUPLICATE_KEYS_CONF, field, parse_strict
from chatloom.operators.anchors import resolve_anchors
from chatloom.operators.approximate import nearest_earlier_approximate as approximate_matches
from chatloom.operators.audit import exact_leakage, leakage_rate as rate_of_leaks, semantic_leakage
from chatloom.operators.convert import convert_messages, convert_records, error_sample
from chatloom.operators.embed import embed
from chatloom.operators.exact import (
    conversation_key,
    drop_rows,
    exact_copies,
    exact_log,
    record_key,
)
from chatloom.operators.order import index_by_order
from chatloom.operators.removal import match_log, removal_details
from chatloom.operators.similar import nearest_earlier
from chatloom.operators.split import eval_size, sample_cap, train_eval_split
from chatloom.operators.texts import text_of_conversations, text_of_records
from chatloom.operators.turn_ranges import normalized_turns, validate_turns
from chatloom.operators.vectors import (
    attach_vectors,
    normalize,
    profile_columns,
    profile_vectors,
    require_vectors,
)
from chatloom.params import HASHED_MODEL, DedupParams, PrepareParams
from chatloom.plans.dedup import DedupResult, deduplicate, deduplicate_file
from chatloom.plans.prepare import PrepareResult, prepare, prepare_file
from chatloom.scratch import materialize, materialize_and_measure, scratch_path
from chatloom.sources.records import (
    number_records,
    parse_documents,
    parse_lines,
    require_clean,
    scan_records,
    source_checks,
)
from chatloom.sources.outputs import output_path
from chatloom.sources.sinks import write_jsonl
from chatloom.sources.turns import conversations_from_turns, turns_from_conversations

# The highest similarity in the tables is about 0.6, so the default threshold would remove nothing.
THRESHOLD = 0.4
CONVERSATION_THRESHOLD = 0.3
EVAL_RATIO = 0.1
SEED = 42
SAMPLE_CAP = 100
TURN_RANGES = 40
DOCUMENTS_PER_ARRAY = 16

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Records may repeat a key; the last one counts.
    spark.conf.set(DUPLICATE_KEYS_CONF, "true")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _object(**values: Column | str) -> Column:
    fields = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in values.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _cases(selector: Column, *cases: Column) -> Column:
    chosen = F.when(selector == 0, cases[0])
    for number, case in enumerate(cases[1:-1], start=1):
        chosen = chosen.when(selector == number, case)
    return chosen.otherwise(cases[-1])


def _joined(messages: str, first: str, second: str) -> Column:
    lines = F.transform(messages, lambda m: F.concat(m[first], F.lit(": "), m[second]))
    return F.array_join(lines, "\n")


# -- reading ------------------------------------------------------------------------------------


@_query
def jsonl_parse_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    good = _object(doc_id="doc_id", text="text")
    line = _cases(
        F.col("n_chars") % 8,
        good,
        F.concat(F.lit('{"text": '), F.to_json(F.struct("text"))),
        F.concat(F.lit("["), good, F.lit("]")),
        F.concat(good, F.lit(" {}")),
        F.concat(F.lit("\t"), good, F.lit(" ")),
        good,
    )
    # Every line is followed by a blank one, which the reader has to drop.
    with_blanks = F.explode(F.array(line, F.lit(" \u3000")))
    parsed = parse_lines(documents.select("doc_id", with_blanks.alias("raw")))
    return parsed.select(
        "doc_id",
        F.coalesce("parse_error", F.lit("ok")).alias("status"),
        F.try_variant_get("v", "$.text", "string").alias("text"),
    )


@_query
def jsonl_source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents") + ".jsonl"
    write_jsonl(documents.orderBy("doc_id"), path, _object(doc_id="doc_id", text="text"))
    read, checks = materialize_and_measure(
        scan_records(spark, path).drop("v"), "records", **source_checks()
    )
    require_clean(spark, path, checks)
    parsed = number_records(read).withColumn("v", parse_strict(F.col("raw")))
    return parsed.select(
        "source_index",
        F.try_variant_get("v", "$.doc_id", "bigint").alias("doc_id"),
        F.try_variant_get("v", "$.text", "string").alias("text"),
    )


@_query
def json_document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    listed = F.sort_array(F.collect_list(F.struct("doc_id", "text")))
    arrays = (
        documents.withColumn("part", F.floor(F.col("doc_id") / DOCUMENTS_PER_ARRAY))
        .groupBy("part")
        .agg(F.to_json(listed).alias("raw"))
    )
    return parse_documents(arrays).select(
        "part",
        F.col("_position").cast("long").alias("position"),
        F.try_variant_get("v", "$.doc_id", "bigint").alias("doc_id"),
        F.try_variant_get("v", "$.text", "string").alias("text"),
    )


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's lines and the end of their array."""
    rows = 0
    for batch in batches:
        rows += batch.num_rows
        yield batch
    yield pa.RecordBatch.from_arrays([pa.array(["]"] if rows else [], pa.string())], ["value"])


@_query
def exact_dedup_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among the records of JSON files with numbers in two spellings that stay different.

    Every document stands there twice, so that there are copies of both spellings.
    """
    documents = _table(spark, sf_dir, "documents")
    number = (F.col("n_chars") % 50).cast("string")
    again = documents.withColumn("doc_id", F.col("doc_id") + 10_000_000_000)
    documents = documents.unionByName(again)
    spelled = F.when(F.col("doc_id") % 2 == 0, number).otherwise(F.concat(number, F.lit(".0")))
    kinds = F.to_json(F.struct(F.array("lang").alias("langs"), "text"))
    record = F.concat(F.lit('{"n": '), spelled, F.lit(', "rest": '), kinds, F.lit("}"))
    path = scratch_path(spark, "numbers")
    # A file of one array for each range of ids; names of files follow the ranges.
    ranged = documents.select("doc_id", record.alias("value")).repartitionByRange("doc_id")
    opened = F.when(F.monotonically_increasing_id() % (1 << 33) == 0, "[").otherwise(",")
    ordered = ranged.sortWithinPartitions("doc_id").select(F.concat(opened, "value").alias("value"))
    ordered.mapInArrow(_closed, "value string").write.text(path)
    scanned = scan_records(spark, path, layout="document")
    keyed = scanned.withColumn("key", record_key(F.col("v"), F.col("raw")))
    read, checks = materialize_and_measure(keyed.drop("v"), "records", **source_checks())
    require_clean(spark, path, checks, layout="document")
    records = materialize(number_records(read).select("source_index", "key"), "keys")
    copies, _ = exact_copies(records, "source_index")
    return copies.select("source_index", "retained")


@_query
def turns_to_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = conversations_from_turns(_table(spark, sf_dir, "conversations"))
    return conversations.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_turns"),
        _joined("messages", "role", "content").alias("dialogue"),
    )


@_query
def conversations_to_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = conversations_from_turns(_table(spark, sf_dir, "conversations"))
    return turns_from_conversations(conversations)


# -- conversion and validation ------------------------------------------------------------------


def _varied_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with some other roles and blank texts, by the length of the text."""
    size = F.length("text")
    role = (
        F.when(size % 31 == 0, "tool")
        .when(size % 7 == 0, F.concat(F.lit(" "), F.upper("role"), F.lit(" ")))
        .otherwise(F.col("role"))
    )
    text = F.when(size % 37 == 0, "\u3000\n").otherwise(F.concat(F.lit("\t"), "text"))
    return _table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", role.alias("role"), text.alias("text")
    )


def _varied_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same conversations as JSON, with one or the other set of keys."""
    varied = conversations_from_turns(_varied_turns(spark, sf_dir))
    renamed = F.transform(
        "messages", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value"))
    )
    raw = F.when(F.size("messages") % 2 == 0, _object(conversations=renamed)).otherwise(
        _object(messages="messages")
    )
    return varied.select("conv_id", parse_strict(raw).alias("v"))


def _validity(converted: DataFrame) -> DataFrame:
    return converted.select(
        "conv_id", "error", _joined("conversations", "from", "value").alias("dialogue")
    )


@_query
def conversation_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validity(convert_messages(conversations_from_turns(_varied_turns(spark, sf_dir))))


@_query
def turn_range_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity from summaries of ranges of turns; most conversations lie in several ranges."""
    return validate_turns(_varied_turns(spark, sf_dir), ranges=TURN_RANGES)


@_query
def valid_turn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _varied_turns(spark, sf_dir)
    validity = materialize(validate_turns(turns), "validity")
    found = normalized_turns(turns, validity, hot_rows=1)
    return found.select("conv_id", "turn", F.col("from").alias("role"), "value")


@_query
def sharegpt_to_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validity(convert_records(_varied_records(spark, sf_dir), "sharegpt"))


@_query
def invalid_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = convert_messages(conversations_from_turns(_varied_turns(spark, sf_dir)))
    return converted.groupBy(F.coalesce("error", F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_conversations")
    )


@_query
def invalid_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = convert_messages(conversations_from_turns(_varied_turns(spark, sf_dir)))
    numbered = index_by_order(
        materialize(converted.select("conv_id", "error"), "converted"), "conv_id", "source_index"
    )
    return error_sample(numbered.withColumn("record_no", F.col("source_index") + 1), "record_no")


@_query
def message_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that are absent, empty, no list, with an entry that is no object, or repeated."""
    conversations = conversations_from_turns(_table(spark, sf_dir, "conversations"))
    listed = F.to_json("messages")
    without_end = F.substring(listed, F.lit(1), F.length(listed) - 1)
    twice = F.to_json(F.flatten(F.transform("messages", lambda m: F.array(m, m))))
    raw = _cases(
        F.col("conv_id") % 7,
        F.concat(F.lit('{"messages": '), listed, F.lit("}")),
        F.lit('{"other": 1}'),
        F.lit('{"messages": []}'),
        F.lit('{"messages": "text"}'),
        F.concat(F.lit('{"messages": '), without_end, F.lit(', "text"]}')),
        F.concat(F.lit('{"messages": '), twice, F.lit("}")),
        F.lit('{"conversations": null, "messages": []}'),
    )
    records = conversations.select("conv_id", parse_strict(raw).alias("v"))
    return convert_records(records, "sharegpt").select("conv_id", "error")


def _two_turns(converted: DataFrame) -> DataFrame:
    return converted.select(
        "doc_id",
        F.get("conversations", F.lit(0))["value"].alias("human"),
        F.get("conversations", F.lit(1))["value"].alias("gpt"),
        "error",
    )


@_query
def qa_to_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    raw = _cases(
        F.col("n_chars") % 7,
        _object(question="text", answer="source"),
        _object(input="text", output="source"),
        _object(question=F.lit(None).cast("string"), input="text", answer="source"),
        _object(question=F.lit("  "), input="text", answer="source"),
        _object(question="text", answer="n_chars"),
        _object(question="text"),
        _object(
            question=F.concat(F.lit("\u3000"), "text", F.lit("\n")),
            answer=F.concat(F.lit(" "), "lang", F.lit(" ")),
            input="lang",
        ),
    )
    records = documents.select("doc_id", parse_strict(raw).alias("v"))
    return _two_turns(convert_records(records, "qa"))


@_query
def alpaca_to_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    raw = _cases(
        F.col("n_chars") % 6,
        _object(instruction="lang", output="text"),
        _object(instruction="lang", input=F.concat("source", F.lit(" ")), output="text"),
        _object(instruction="lang", input=F.lit(" \t"), output="text"),
        _object(instruction="lang", input="n_chars", output="text"),
        _object(instruction=F.lit(" "), input="source", output="text"),
        _object(instruction="lang", input="source"),
    )
    records = documents.select("doc_id", parse_strict(raw).alias("v"))
    return _two_turns(convert_records(records, "alpaca"))


@_query
def key_fallback_absent_vs_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    raw = _cases(
        F.col("n_chars") % 4,
        _object(a="lang", b="source"),
        _object(b="source"),
        _object(a=F.lit(None).cast("string"), b="source"),
        _object(c="source"),
    )
    found = field(parse_strict(raw), "a", "b")
    return documents.select(
        "doc_id",
        F.coalesce(F.to_json(found), F.lit("absent")).alias("picked"),
    )


# -- exact copies -------------------------------------------------------------------------------


@_query
def exact_dedup_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    messages = F.array(
        F.struct(F.lit("user").alias("role"), F.col("text").alias("content")),
        F.struct(F.lit("gpt").alias("role"), F.col("lang").alias("content")),
    )
    converted = convert_messages(documents.select("doc_id", messages.alias("messages")))
    valid = converted.where(F.col("error").isNull())
    keyed = materialize(
        valid.select("doc_id", conversation_key(F.col("conversations")).alias("key")), "keys"
    )
    copies, _ = exact_copies(keyed, "doc_id")
    return drop_rows(keyed, copies, "doc_id").select("doc_id")


def _document_records(documents: DataFrame, index: str) -> DataFrame:
    """JSON records in two spellings, so that copies are seen only after key sorting."""
    raw = F.when(F.col("source") < "src5", _object(text="text", lang="lang")).otherwise(
        _object(lang="lang", text="text")
    )
    return documents.select(F.col(index), "text", raw.alias("record"))


@_query
def exact_dedup_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _document_records(_table(spark, sf_dir, "documents"), "doc_id")
    key = record_key(parse_strict(F.col("record")), F.col("record"))
    keyed = materialize(records.select("doc_id", key.alias("key")), "keys")
    copies, _ = exact_copies(keyed, "doc_id")
    log = exact_log(copies, records, "doc_id")
    text = F.try_variant_get(F.try_parse_json("record"), "$.text", "string")
    return log.withColumn("text", text).drop("record")


# -- texts for comparison -----------------------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    extracted = text_of_records(_varied_records(spark, sf_dir), mode)
    return extracted.select("conv_id", "text", "text_error")


@_query
def text_first_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, "first_user")


@_query
def text_all_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, "all_user")


@_query
def text_full_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, "full_dialogue")


# -- vectors ------------------------------------------------------------------------------------


@_query
def embedding_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [column.alias(name) for name, column in profile_columns().items()]
    return _table(spark, sf_dir, "embeddings").agg(*columns).select(
        "n_rows",
        F.col("min_dimension").cast("long").alias("min_dimension"),
        F.col("max_dimension").cast("long").alias("max_dimension"),
        "zero_vectors",
        "bad_vectors",
        F.round("min_norm", 5).alias("min_norm"),
        F.round("max_norm", 5).alias("max_norm"),
    )


@_query
def embedding_checks_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over vectors of which some are NULL, zero, not a number, infinite or longer."""
    spoiled = _cases(
        F.col("vec_id") % 11,
        F.lit(None).cast("array<float>"),
        F.transform("embedding", lambda x: (x * 0).cast("float")),
        F.transform("embedding", lambda x: F.lit(float("nan")).cast("float")),
        F.transform("embedding", lambda x: F.lit(float("inf")).cast("float")),
        F.concat("embedding", F.array(F.lit(1.0).cast("float"))),
        F.col("embedding"),
    )
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", spoiled.alias("embedding"))
    columns = [column.alias(name) for name, column in profile_columns().items()]
    return vectors.agg(*columns).select(
        "n_rows",
        F.col("max_dimension").cast("long").alias("max_dimension"),
        "zero_vectors",
        "bad_vectors",
    )


def _weighted_sum(vector: str) -> Column:
    weighted = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return F.aggregate(weighted, F.lit(0.0), lambda total, x: total + x)


@_query
def renormalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    stretched = F.transform("embedding", lambda x: (x * (F.col("label") + 1)).cast("float"))
    scaled = vectors.select("vec_id", stretched.alias("embedding"))
    unit = normalize(scaled, profile_vectors(scaled))
    return unit.select("vec_id", F.round(_weighted_sum("embedding"), 4).alias("weighted_sum"))


@_query
def renormalize_always(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors within the tolerance are divided by their norms, too, when that is asked for."""
    vectors = _table(spark, sf_dir, "embeddings")
    stretched = F.transform("embedding", lambda x: (x * F.lit(1.0005)).cast("float"))
    scaled = vectors.select("vec_id", stretched.alias("embedding"))
    unit = normalize(scaled, profile_vectors(scaled), mode="always")
    return unit.select("vec_id", F.round(_weighted_sum("embedding"), 4).alias("weighted_sum"))


def _vectors_of(spark: SparkSession, sf_dir: str, rows: DataFrame, index: str) -> DataFrame:
    """A vector for every row: the table's vectors in order, again and again."""
    table = materialize(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "table")
    placed = index_by_order(table, "vec_id", "place")
    turn = F.pmod(F.col(index), F.lit(table.count())).alias("place")
    found = rows.select(index, turn).join(placed.select("place", "embedding"), "place")
    return found.select(index, "embedding")


@_query
def precomputed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    vectors = _vectors_of(spark, sf_dir, documents, "doc_id")
    joined = attach_vectors(documents.select("doc_id", "lang"), vectors, "doc_id")
    return joined.select("doc_id", "lang", F.size("embedding").cast("long").alias("dimension"))


@_query
def hash_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hashing encoder; each vector is shown by two numbers that any change would move."""
    # Encoding costs more than moving the texts, and a small table lies in one split.
    parts = spark.sparkContext.defaultParallelism
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text").repartition(parts)
    return embed(documents, DedupParams(model_name_or_path=HASHED_MODEL)).select(
        "doc_id",
        F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("n_used"),
        F.round(_weighted_sum("embedding"), 4).alias("weighted_sum"),
    )


# -- near copies --------------------------------------------------------------------------------


def _matches(embeddings: DataFrame, threshold: float = THRESHOLD, **spread) -> DataFrame:
    vectors = embeddings.select(F.col("vec_id").alias("row_index"), "embedding")
    profile = profile_vectors(vectors)
    require_vectors(profile)
    unit = normalize(vectors, profile)
    return nearest_earlier(unit, profile.after_normalization(), threshold, **spread)


@_query
def nearest_earlier_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(_table(spark, sf_dir, "embeddings")).select(
        "duplicate_index", "matched_index", F.round("similarity", 6).alias("similarity")
    )


@_query
def nearest_earlier_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with so small tiles that pivots, groups and cells are many, as in large tables."""
    found = _matches(_table(spark, sf_dir, "embeddings"), tile_rows=16)
    return found.select(
        "duplicate_index", "matched_index", F.round("similarity", 6).alias("similarity")
    )


@_query
def nearest_earlier_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector again, half of them a little longer: twins of equal and unequal length."""
    embeddings = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    longer = F.transform("embedding", lambda x: (x * F.lit(1.0005)).cast("float"))
    again = embeddings.select(
        (F.col("vec_id") + 1_000_000).alias("vec_id"),
        F.when(F.col("vec_id") % 2 == 0, F.col("embedding")).otherwise(longer).alias("embedding"),
    )
    third = embeddings.select((F.col("vec_id") + 2_000_000).alias("vec_id"), "embedding")
    every = materialize(embeddings.unionByName(again).unionByName(third), "repeated")
    found = _matches(every, 0.9)
    return found.select(
        "duplicate_index", "matched_index", F.round("similarity", 6).alias("similarity")
    )


@_query
def nearest_earlier_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches by bands of sign projections, held against those of the exact join: how many there
    are, whether at least nine of ten are the same, and how many have no counterpart."""
    embeddings = _table(spark, sf_dir, "embeddings")
    vectors = materialize(
        embeddings.select(F.col("vec_id").alias("row_index"), "embedding"), "approximate"
    )
    profile = profile_vectors(vectors)
    found = approximate_matches(vectors, profile, THRESHOLD, recall=0.97)
    exact = nearest_earlier(vectors, profile, THRESHOLD)
    names = ("matched_index", "similarity")
    both = exact.join(
        found.select("duplicate_index", *(F.col(name).alias(f"_{name}") for name in names)),
        "duplicate_index",
        "full",
    )
    same = F.coalesce(
        (F.col("matched_index") == F.col("_matched_index"))
        & (F.round("similarity", 9) == F.round("_similarity", 9)),
        F.lit(False),
    )
    return both.agg(
        F.count("matched_index").alias("exact_matches"),
        (F.count_if(same) >= 0.9 * F.count("matched_index")).alias("recall_of_nine_tenths"),
        F.count_if(F.col("matched_index").isNull()).alias("without_counterpart"),
    )


def _leaked_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Leaked rows, and all rows with their side."""
    documents = _table(spark, sf_dir, "documents")
    split = train_eval_split(documents, documents.count(), EVAL_RATIO, SEED, "doc_id")
    keyed = materialize(split.select("doc_id", "split", F.sha2("text", 256).alias("key")), "keys")
    sides = [keyed.where(F.col("split") == side) for side in ("eval", "train")]
    return exact_leakage(sides[0], sides[1], "doc_id", "key"), keyed


@_query
def leakage_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation documents whose text the training documents hold as well."""
    return _leaked_documents(spark, sf_dir)[0]


@_query
def leakage_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaked, every = _leaked_documents(spark, sf_dir)
    return rate_of_leaks(leaked, every.where(F.col("split") == "eval").count())


@_query
def leakage_semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation vectors with a close one among the training vectors."""
    embeddings = _table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "row_index")
    profile = profile_vectors(embeddings)
    unit = normalize(embeddings, profile)
    split = materialize(
        train_eval_split(unit, profile.n_rows, EVAL_RATIO, SEED, "row_index"), "split-vectors"
    )
    sides = [split.where(F.col("split") == side) for side in ("eval", "train")]
    found = semantic_leakage(sides[0], sides[1], profile.after_normalization(), THRESHOLD)
    return found.withColumn("similarity", F.round("similarity", 6))


@_query
def semantic_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    removed = _matches(embeddings).withColumnRenamed("duplicate_index", "vec_id")
    return drop_rows(embeddings.select("vec_id"), removed, "vec_id")


@_query
def anchor_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = materialize(_matches(_table(spark, sf_dir, "embeddings")), "matches")
    return match_log(resolve_anchors(matches))


@_query
def semantic_removal_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    vectors = _vectors_of(spark, sf_dir, documents.withColumnRenamed("doc_id", "vec_id"), "vec_id")
    matches = materialize(_matches(materialize(vectors, "vectors")), "matches")
    log = match_log(resolve_anchors(matches))
    records = _document_records(documents.withColumnRenamed("doc_id", "row_index"), "row_index")
    return removal_details(log, log.count(), records).drop("record")


def _document_dedup(spark: SparkSession, sf_dir: str) -> DedupResult:
    """Both kinds of removal over all documents, each with a vector."""
    documents = _table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "source_index")
    with_key = _document_records(documents, "source_index").withColumn(
        "key", record_key(parse_strict(F.col("record")), F.col("record"))
    )
    return deduplicate(
        with_key.withColumn("text_error", F.lit(None).cast("string")),
        DedupParams(similarity_threshold=THRESHOLD),
        vectors=_vectors_of(spark, sf_dir, documents, "source_index"),
        vector_key="source_index",
        text_of=lambda rows: rows.withColumn("text", _record_text()),
    )


def _record_text() -> Column:
    return F.try_variant_get(F.try_parse_json("record"), "$.text", "string")


@_query
def removal_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = _document_dedup(spark, sf_dir).removed
    return removed.withColumn("record_text", _record_text()).drop("record")


@_query
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _document_dedup(spark, sf_dir).report
    return report.select(
        "input_records",
        "exact_unique_records",
        "exact_duplicates_removed",
        "semantic_duplicates_removed",
        "retained_records",
        "total_removed",
        "removal_rate",
        "semantic_removal_rate_after_exact",
        F.col("config.similarity_threshold").alias("similarity_threshold"),
        F.col("embedding_dimension").cast("long").alias("embedding_dimension"),
    )


def digest_encoder(params: DedupParams) -> Callable:
    """An encoder under which only equal texts are alike: signs of the bits of a digest."""

    def predict(texts: np.ndarray) -> np.ndarray:
        heads = b"".join(hashlib.sha256(str(text).encode()).digest() for text in texts)
        bits = np.unpackbits(np.frombuffer(heads, dtype=np.uint8)).reshape(len(texts), 256)
        return (bits.astype(np.float32) * 2 - 1) / 16

    return predict


def _deduplicated_files(spark: SparkSession, sf_dir: str) -> str:
    """The output folder of the removal job over the documents as JSONL records of one message."""
    message = F.struct(F.lit("user").alias("from"), F.col("text").alias("value"))
    documents = _table(spark, sf_dir, "documents").select("doc_id", F.array(message).alias("said"))
    path, output = scratch_path(spark, "records") + ".jsonl", scratch_path(spark, "deduplicated")
    write_jsonl(documents.orderBy("doc_id"), path, _object(conversations="said"), "gzip")
    deduplicate_file(
        spark, path, output, DedupParams(), encoder=digest_encoder, bad_records="quarantine",
        compression="gzip",
    )
    return output


@_query
def removal_log_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that the job writes, read back."""
    log = output_path(spark, _deduplicated_files(spark, sf_dir), "removed_duplicates.jsonl")
    schema = (
        "duplicate_source_index bigint, retained_source_index bigint, reason string, "
        "similarity double, record struct<conversations: array<struct<value: string>>>"
    )
    text = F.col("record.conversations")[0]["value"]
    return spark.read.schema(schema).json(log).withColumn("text", text).drop("record")


@_query
def dedup_report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report that the job writes, read back."""
    path = output_path(spark, _deduplicated_files(spark, sf_dir), "dedup_report.json")
    counts = (
        "input_records", "exact_unique_records", "exact_duplicates_removed",
        "semantic_duplicates_removed", "retained_records", "total_removed",
    )
    schema = ", ".join(f"{name} bigint" for name in counts) + ", removal_rate double"
    return spark.read.schema(schema).json(path, multiLine=True)


@_query
def strict_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the removal says about records of which some have no usable text."""
    documents = _table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "source_index")
    bad = F.length("text") % 11 == 3
    records = materialize(
        documents.select(
            "source_index",
            F.col("text").alias("record"),
            F.when(~bad, F.col("text")).alias("text"),
            F.when(bad, F.lit("no text")).alias("text_error"),
        ),
        "strict",
    )
    try:
        deduplicate(records, DedupParams(), encoder=digest_encoder, exact=False)
        said = "accepted"
    except ValueError as problem:
        said = str(problem)
    return spark.createDataFrame([(said,)], "said string")


@_query
def split_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a split of each source's documents says at three ratios."""
    counts = _table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    # One row for each source; the guards are checks of parameters and of one number.
    rows = []
    for source, n in counts.collect():
        for ratio in (0.5, 0.999, 1.0):
            try:
                said = str(eval_size(n, ratio))
            except ValueError as problem:
                said = str(problem)
            rows.append((source, ratio, said))
    return spark.createDataFrame(rows, "source string, ratio double, said string")


# -- the whole preparation ----------------------------------------------------------------------


COPY_OFFSET = 1_000_000


def _converted_conversations(
    spark: SparkSession, sf_dir: str, with_copies: bool = False
) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    if with_copies:
        copied = table.where(F.col("conv_id") % 2 == 0)
        table = table.unionByName(copied.withColumn("conv_id", F.col("conv_id") + COPY_OFFSET))
    turns = conversations_from_turns(table)
    converted = convert_messages(turns.withColumnRenamed("conv_id", "source_index"))
    return materialize(converted.drop("messages"), "converted")


def _prepared(spark: SparkSession, sf_dir: str) -> PrepareResult:
    converted = _converted_conversations(spark, sf_dir, with_copies=True)
    params = PrepareParams(
        "sharegpt",
        EVAL_RATIO,
        SEED,
        DedupParams(similarity_threshold=CONVERSATION_THRESHOLD),
    )
    return prepare(
        converted,
        params,
        vectors=_vectors_of(spark, sf_dir, converted, "source_index"),
        vector_key="source_index",
    )


@_query
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).stats


@_query
def prepared_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = _converted_conversations(spark, sf_dir)
    result = prepare(converted, PrepareParams("sharegpt", EVAL_RATIO, SEED))
    return result.prepared.select(
        F.col("source_index").alias("conv_id"),
        "split",
        _joined("conversations", "from", "value").alias("dialogue"),
    )


@_query
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on files: conversations written as JSONL, both sets read back."""
    conversations = conversations_from_turns(_table(spark, sf_dir, "conversations"))
    path = scratch_path(spark, "conversations") + ".jsonl"
    write_jsonl(conversations.orderBy("conv_id"), path, _object(messages="messages"))
    output = scratch_path(spark, "prepared")
    prepare_file(spark, path, output, PrepareParams("sharegpt", EVAL_RATIO, SEED))
    sets = [
        spark.read.text(f"{output}/{split}/{split}.jsonl").select(
            parse_strict(F.col("value")).alias("v"), F.lit(split).alias("split")
        )
        for split in ("train", "eval")
    ]
    messages = F.try_variant_get(
        "v", "$.conversations", "array<struct<`from`:string,value:string>>"
    )
    read = sets[0].unionByName(sets[1]).withColumn("conversations", messages)
    return read.select("split", _joined("conversations", "from", "value").alias("dialogue"))


@_query
def train_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    split = train_eval_split(documents, documents.count(), EVAL_RATIO, SEED, "doc_id")
    return split.select("doc_id", "lang", "split")


@_query
def capped_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    capped = sample_cap(documents, documents.count(), SAMPLE_CAP, SEED, "doc_id")
    return capped.select("doc_id", "text")


# -- chat histories -----------------------------------------------------------------------------


def _thinking_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with reasoning in front of, inside, behind or instead of the text, closed or not."""
    turns = _table(spark, sf_dir, "conversations")
    thought = F.concat(F.lit("<think>\n"), "text", F.lit("\n</think>"))
    text = _cases(
        F.length("text") % 5,
        F.concat(thought, F.lit("\n\n"), "text"),
        F.concat(F.lit(" "), "text", F.lit("\n"), thought, F.lit(" \u3000"), "text", thought),
        F.concat("text", F.lit("<think>"), "text"),
        thought,
        F.col("text"),
    )
    return turns.select("conv_id", "turn", "role", text.alias("text"))


def _thinking_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations_from_turns(_thinking_turns(spark, sf_dir))


def _chat(df: DataFrame, messages: Column) -> DataFrame:
    built = df.select("conv_id", messages.alias("built"))
    return built.select("conv_id", _joined("built", "role", "content").alias("dialogue"))


@_query
def strip_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _thinking_turns(spark, sf_dir)
    return turns.select("conv_id", "turn", chat.strip_reasoning(F.col("text")).alias("answer"))


@_query
def history_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    histories = _thinking_histories(spark, sf_dir)
    return _chat(histories, chat.history_from_roles(F.col("messages")))


@_query
def history_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each two neighbouring turns taken as one (user, assistant) pair; a missing side is empty."""
    histories = _thinking_histories(spark, sf_dir)
    numbered = F.transform("messages", lambda m, i: F.struct(i.alias("i"), m["content"].alias("c")))
    firsts = F.filter(numbered, lambda m: m["i"] % 2 == 0)
    pairs = F.transform(
        firsts,
        lambda m: F.struct(
            m["c"].alias("user"),
            F.get(F.col("messages"), m["i"] + 1)["content"].alias("assistant"),
        ),
    )
    with_pairs = histories.select("conv_id", pairs.alias("pairs"))
    return _chat(with_pairs, chat.history_from_pairs(F.col("pairs")))


SYSTEM_PROMPT = "Answer clearly and say what is uncertain."
QUESTION = "Please summarize."


def _request(histories: DataFrame) -> Column:
    cleaned = chat.history_from_roles(F.col("messages"))
    return chat.request_messages(F.lit(SYSTEM_PROMPT), cleaned, F.lit(QUESTION))


@_query
def request_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    histories = _thinking_histories(spark, sf_dir)
    return _chat(histories, _request(histories))


@_query
def no_think(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some conversations start with a system message, the others get one."""
    conversations = conversations_from_turns(_table(spark, sf_dir, "conversations"))
    return _chat(conversations, chat.suppress_thinking(F.col("messages")))


@_query
def turn_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return turns.select(
        "conv_id",
        "turn",
        chat.turn_prompt(F.col("text")).alias("prompt"),
        chat.turn_prompt(F.col("text"), thinking=True).alias("thinking_prompt"),
    )


@_query
def conversation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparison texts of converted conversations, as the preparation job uses them."""
    converted = _converted_conversations(spark, sf_dir).where(F.col("error").isNull())
    extracted = text_of_conversations(converted, "all_user")
    return extracted.select(F.col("source_index").alias("conv_id"), "text")
