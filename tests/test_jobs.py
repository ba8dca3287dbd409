from __future__ import annotations

import base64
import json
import random
import sys
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from chatloom.__main__ import main
from chatloom.operators.embed import embed, sentence_encoder
from chatloom.operators.similar import nearest_earlier
from chatloom.operators.vectors import profile_vectors
from chatloom.params import HASHED_MODEL, DedupParams, PrepareParams, config_object
from chatloom.plans.dedup import deduplicate, deduplicate_file
from chatloom.plans.prepare import prepare_file
from chatloom.scratch import _run_folder, materialize, temporary
from chatloom.sources.records import SourceError
from chatloom.streaming.convert import converted_stream, write_stream

# Workers cannot import this module, so its encoder travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def chat(question, answer):
    return {
        "conversations": [{"from": "human", "value": question}, {"from": "gpt", "value": answer}]
    }


def write_lines(path, records):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records))
    return str(path)


def read_lines(spark, path):
    return [json.loads(r.value) for r in spark.read.text(str(path)).collect()]


def read_report(spark, path):
    return json.loads(spark.read.text(str(path), wholetext=True).first().value)


def letter_encoder(params):
    """Counts of a, b and c as a direction."""

    def predict(texts):
        counts = np.array([[t.count(x) for x in "abc"] for t in texts], dtype=np.float32)
        return counts / np.linalg.norm(counts, axis=1, keepdims=True)

    return predict


RECORDS = [
    chat("aaab", "1"),
    chat("aaab", "1"),
    {**chat("aaab", "1"), "note": 1},
    chat("aaaab", "2"),
    chat("cc", "3"),
    chat(" cc ", "3"),
    chat("b", "4"),
]


def test_dedup_job(spark, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", RECORDS)
    params = DedupParams(similarity_threshold=0.99)
    deduplicate_file(spark, path, str(tmp_path / "out"), params, encoder=letter_encoder)
    kept = read_lines(spark, tmp_path / "out/deduplicated.jsonl")
    assert kept == [RECORDS[0], RECORDS[4], RECORDS[6]]
    removed = read_lines(spark, tmp_path / "out/removed_duplicates.jsonl")
    exact = [r for r in removed if r["reason"] == "exact_duplicate"]
    assert exact == [
        {
            "duplicate_source_index": 1,
            "retained_source_index": 0,
            "reason": "exact_duplicate",
            "similarity": 1.0,
            "record": RECORDS[1],
        }
    ]
    near = {r["duplicate_index"]: r for r in removed if r["reason"] == "semantic_duplicate"}
    # Positions among the exact-unique records: source rows 2, 3 and 5 are 1, 2 and 4 there.
    assert {i: (r["matched_index"], r["retained_index"]) for i, r in near.items()} == {
        1: (0, 0), 2: (0, 0), 4: (3, 3)
    }
    assert near[2]["duplicate_text"] == "aaaab" and near[2]["retained_text"] == "aaab"
    assert near[1]["record"] == RECORDS[2]
    report = read_report(spark, tmp_path / "out/dedup_report.json")
    assert report.pop("runtime_seconds") > 0
    assert report.pop("config")["similarity_threshold"] == 0.99
    assert report == {
        "input_records": 7,
        "exact_unique_records": 6,
        "exact_duplicates_removed": 1,
        "semantic_duplicates_removed": 3,
        "retained_records": 3,
        "total_removed": 4,
        "removal_rate": 0.571429,
        "semantic_removal_rate_after_exact": 0.5,
        "resolved_device": "cpu",
        "embedding_dimension": 3,
    }


def test_dedup_with_supplied_vectors(spark):
    records = spark.createDataFrame(
        [(i, json.dumps(chat(q, "x")), q, None, str(i)) for i, q in enumerate(["one", "uno", "two"])],
        "source_index long, record string, text string, text_error string, key string",
    )
    vectors = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [0.98, 0.199]), (2, [0.0, 1.0])],
        "row_index long, embedding array<float>",
    )
    result = deduplicate(records, DedupParams(similarity_threshold=0.95), vectors=vectors)
    assert sorted(r.row_index for r in result.retained.collect()) == [0, 2]
    assert result.removed.first().duplicate_text == "uno"
    assert result.report.first().retained_records == 2


def test_dedup_stops_at_a_record_without_text(spark, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", [chat("a", "b"), {"conversations": []}])
    params = DedupParams(model_name_or_path=HASHED_MODEL)
    with pytest.raises(ValueError, match="record 1 has no"):
        deduplicate_file(spark, path, str(tmp_path / "out"), params)
    assert not (tmp_path / "out").exists()


def test_bad_records_can_be_set_aside(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    good = [json.dumps(chat(q, "1")) for q in ("a", "b", "b")]
    path.write_text("\n".join([good[0], "{bad", good[1], '{"messages":[]}', good[2]]))
    deduplicate_file(
        spark,
        str(path),
        str(tmp_path / "d"),
        DedupParams(),
        encoder=letter_encoder,
        bad_records="quarantine",
    )
    assert len(read_lines(spark, tmp_path / "d/deduplicated.jsonl")) == 2
    rejected = read_lines(spark, tmp_path / "d/rejected.jsonl")
    assert [(r["source_index"], r["error"][:12]) for r in rejected] == [
        (1, "Invalid JSON"), (3, "Record is mi")
    ]
    params = PrepareParams("sharegpt", 0.5)
    with pytest.raises(SourceError):
        prepare_file(spark, str(path), str(tmp_path / "p"), params)
    prepare_file(spark, str(path), str(tmp_path / "p"), params, bad_records="quarantine")
    stats = read_report(spark, tmp_path / "p/dataset_stats.json")
    assert (stats["invalid_records"], stats["valid_unique_records"]) == (2, 2)


def test_dedup_of_nothing(spark):
    empty = spark.createDataFrame(
        [], "source_index long, record string, text string, text_error string, key string"
    )
    params = DedupParams(model_name_or_path=HASHED_MODEL)
    report = deduplicate(empty, params).report.first()
    assert (report.input_records, report.removal_rate, report.embedding_dimension) == (0, 0.0, 0)


def qa(question, answer):
    return {"question": question, "answer": answer}


def test_prepare_job(spark, tmp_path):
    rows = [qa(f"q{i}", "a") for i in range(20)] + [qa("q3", " a"), qa("", "a"), qa("q5", "a "), {}]
    path = write_lines(tmp_path / "in.jsonl", rows)
    out = tmp_path / "out"
    result = prepare_file(spark, path, str(out), PrepareParams("qa", eval_ratio=0.25, seed=1))
    train = read_lines(spark, out / "train/train.jsonl")
    held = read_lines(spark, out / "eval/eval.jsonl")
    assert (len(train), len(held)) == (15, 5)
    questions = [r["conversations"][0]["value"] for r in train + held]
    assert sorted(questions) == sorted(f"q{i}" for i in range(20))
    assert read_report(spark, out / "dataset_stats.json") == {
        "input_records": 24,
        "valid_unique_records": 20,
        "exact_duplicates_removed": 2,
        "semantic_dedup_enabled": False,
        "semantic_duplicates_removed": 0,
        "train_records": 15,
        "eval_records": 5,
        "invalid_records": 2,
        "seed": 1,
    }
    assert [r.message.split(":")[0] for r in result.errors.collect()] == ["record 22", "record 24"]


def test_prepare_with_near_copies(spark, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", RECORDS)
    out = tmp_path / "out"
    dedup = DedupParams(similarity_threshold=0.99)
    prepare_file(
        spark, path, str(out), PrepareParams("sharegpt", 0.34, 42, dedup), encoder=letter_encoder
    )
    report = read_report(spark, out / "semantic_dedup_report.json")
    # Exact copies are gone before, so this report starts from the unique conversations.
    assert (report["input_records"], report["exact_duplicates_removed"]) == (4, 0)
    assert report["semantic_duplicates_removed"] == 1
    (removed,) = read_lines(spark, out / "semantic_duplicates_removed.jsonl")
    assert removed["duplicate_text"] == "aaaab" and removed["record"] == RECORDS[3]
    stats = read_report(spark, out / "dataset_stats.json")
    assert (stats["valid_unique_records"], stats["train_records"], stats["eval_records"]) == (3, 2, 1)


def test_prepare_checks_before_it_writes(spark, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", [qa("q", "a"), qa(" q", "a")])
    with pytest.raises(ValueError, match="at least two"):
        prepare_file(spark, path, str(tmp_path / "out"), PrepareParams("qa"))
    with pytest.raises(ValueError, match="eval_ratio"):
        prepare_file(spark, path, str(tmp_path / "out"), PrepareParams("qa", eval_ratio=1.0))
    assert not (tmp_path / "out").exists()


def test_hashing_encoder(spark):
    long = " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(long,), (long + " end",), ("x",), ("完全不同的",), ("",)], "text string")
    hashed = DedupParams(model_name_or_path=HASHED_MODEL)
    vectors = [np.array(r.embedding) for r in embed(df, hashed).collect()]
    assert all(abs(np.linalg.norm(v) - 1) < 1e-6 for v in vectors)
    assert vectors[0] @ vectors[1] > 0.95 and abs(vectors[0] @ vectors[3]) < 0.2


def test_there_is_no_default_encoder(spark, tmp_path):
    path = write_lines(tmp_path / "in.jsonl", [qa("q", "a")])
    with pytest.raises(ValueError, match="encoder"):
        deduplicate_file(spark, path, str(tmp_path / "out"), DedupParams())
    with pytest.raises(ValueError, match="encoder"):
        prepare_file(spark, path, str(tmp_path / "out"), PrepareParams("qa", dedup=DedupParams()))
    assert not (tmp_path / "out").exists()


def test_unrelated_texts_are_retained(spark):
    """At the default threshold only texts that share most of their words go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"])
    hashed = DedupParams(model_name_or_path=HASHED_MODEL)
    vectors = materialize(embed(docs.select(F.col("doc_id").alias("row_index"), "text"), hashed), "v")
    matches = nearest_earlier(vectors.select("row_index", "embedding"), profile_vectors(vectors), 0.92)
    texts = {r.row_index: r.text.split() for r in vectors.select("row_index", "text").collect()}
    found = matches.collect()
    assert len(found) < 0.1 * len(texts)
    for r in found:
        a, b = ({tuple(t[i : i + 3]) for i in range(max(len(t) - 2, 1))} for t in (texts[r.duplicate_index], texts[r.matched_index]))
        assert len(a & b) / len(a | b) > 0.6


def test_named_model_needs_its_library():
    with pytest.raises(RuntimeError, match="sentence-transformers"):
        sentence_encoder(DedupParams(model_name_or_path="some-model"))


def test_parameters():
    assert DedupParams.resolve({"text_mode": "all_user", "batch_size": 8}, {"batch_size": 9}) == (
        DedupParams(text_mode="all_user", batch_size=9)
    )
    for bad in (
        {"similarity_threshold": 0.0},
        {"similarity_threshold": 1.1},
        {"text_mode": "none"},
        {"batch_size": 0},
        {"compare_chunk_size": -1},
        {"max_seq_length": 0},
    ):
        with pytest.raises(ValueError):
            DedupParams(**bad).validate()
    with pytest.raises(TypeError):
        DedupParams.resolve({"unknown": 1})
    with pytest.raises(ValueError):
        config_object("[1]")
    with pytest.raises(ValueError):
        PrepareParams("csv").validate()


def test_command_line(spark, tmp_path, capsys):
    path = write_lines(tmp_path / "in.jsonl", [qa("q1", "a"), qa("q2", "a"), qa("q3", 5)])
    main(["prepare", "--input", path, "--format", "qa", "--output-dir", str(tmp_path / "p")])
    printed = capsys.readouterr().out
    assert '"train_records": 1' in printed and "- record 3: " in printed
    config = tmp_path / "config.json"
    config.write_text('{"text_mode": "all_user", "similarity_threshold": 0.5}')
    lines = str(tmp_path / "p/train/train.jsonl")
    main(
        ["dedup", "--input", lines, "--output-dir", str(tmp_path / "d"), "--config", str(config)]
        + ["--similarity-threshold", "0.9", "--model-name-or-path", HASHED_MODEL]
    )
    report = json.loads(capsys.readouterr().out)
    assert report["config"]["text_mode"] == "all_user"
    assert report["config"]["similarity_threshold"] == 0.9
    assert report["retained_records"] == 1


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"question":"q","answer":"a"}\n\n{bad\n')
    (tmp_path / "in/b.jsonl").write_text('{"question":" ","answer":"a"}\n')
    stream = converted_stream(spark, str(tmp_path / "in"), "qa")
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert len(read_lines(spark, tmp_path / "out/outcome=valid")) == 1
    rejected = read_lines(spark, tmp_path / "out/outcome=rejected")
    assert sorted(r["error"][:12] for r in rejected) == ["Conversation", "Invalid JSON"]
    assert spark.read.text(str(tmp_path / "out")).where(F.col("outcome") == "valid").count() == 1


@pytest.mark.parametrize("fast", [True, False])
def test_named_model_sees_the_tail_of_a_text_without_blanks(monkeypatch, fast):
    """A stand-in for the library: a token for each character, texts cut at the model's window."""
    import sys
    import types

    seen = []

    class Tokenizer:
        is_fast = fast

        def num_special_tokens_to_add(self):
            return 2

        def __call__(self, text, return_offsets_mapping=False, **options):
            places = [place for place, char in enumerate(text) if not char.isspace()]
            found = {"input_ids": [ord(text[place]) for place in places]}
            return found | ({"offset_mapping": [(p, p + 1) for p in places]} if return_offsets_mapping else {})

    class SentenceTransformer:
        def __init__(self, name, **options):
            self.tokenizer = Tokenizer()

        def encode(self, texts, **options):
            vectors = np.zeros((len(texts), 512), dtype=np.float32)
            for row, text in enumerate(texts):
                ids = self.tokenizer(text)["input_ids"]
                seen.append(len(ids))
                for number in ids[: self.max_seq_length - 2]:
                    vectors[row, number % 512] += 1
            return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)

    library = types.SimpleNamespace(SentenceTransformer=SentenceTransformer)
    monkeypatch.setitem(sys.modules, "sentence_transformers", library)
    params = DedupParams(model_name_or_path="some-model")
    opening = "\u4e00\u4e8c\u4e09" * 170
    texts = [opening + "\u4eba" * 900, opening + "\u5927" * 900, "short text", opening + "\u4eba" * 900]
    first, second, short, again = sentence_encoder(params)(np.array(texts))
    assert max(seen) <= params.max_seq_length - 2
    assert first @ second < 0.5 and first @ again == pytest.approx(1, abs=1e-5)
    assert np.linalg.norm(short) == pytest.approx(1, abs=1e-5)
    # Windows count by their tokens: the tail has 900 of 1,410.
    assert first[ord("\u4eba") % 512] > first[ord("\u4e00") % 512]


def folder_bytes(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*") if f.is_file())


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_records_are_written_once(spark, tmp_path, compression):
    """one table holds the records, without their texts again."""
    rng = random.Random(5)
    said = [base64.b64encode(rng.randbytes(3000)).decode() for _ in range(300)]
    rows = [chat(text, "x") for text in said + said[:30]] + [{**chat(said[7], "x"), "note": 1}]
    path = write_lines(tmp_path / "in.jsonl", rows)
    before = folder_bytes(_run_folder(spark))
    result = deduplicate_file(
        spark, path, str(tmp_path / "out"), DedupParams(similarity_threshold=1.0),
        encoder=place_encoder, compression=compression,
    )
    assert folder_bytes(_run_folder(spark)) - before < 1.2 * Path(path).stat().st_size
    kept = read_lines(spark, tmp_path / "out/deduplicated.jsonl")
    assert kept == rows[:300]
    removed = read_lines(spark, tmp_path / "out/removed_duplicates.jsonl")
    assert [r.get("duplicate_source_index") for r in removed] == [*range(300, 330), None]
    assert removed[-1]["duplicate_index"] == 300 and removed[-1]["retained_text"] == said[7]
    assert removed[-1]["record"] == rows[330]
    assert sorted(r.row_index for r in result.retained.collect()) == list(range(300))
    suffixes = {f.suffix for f in (tmp_path / "out/deduplicated.jsonl").glob("part-*")}
    assert suffixes == {".gz" if compression else ".txt"}


def place_encoder(params):
    """Equal texts have equal vectors; others hardly ever."""

    def predict(texts):
        rows = np.array([[ord(c) - 64 for c in text[:16]] for text in texts], dtype=np.float32)
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    return predict


def test_removal_writes_no_texts(spark):
    """records and texts stay where they are read; what is written has indexes and vectors."""
    rows = [(3 * i, f"r{i}", f"t{i % 40}", None, f"k{i % 50}") for i in range(100)]
    records = spark.createDataFrame(
        rows, "source_index long, record string, text string, text_error string, key string"
    )
    vectors = spark.createDataFrame(
        [(3 * i, [float(np.cos(i % 40)), float(np.sin(i % 40))]) for i in range(100)],
        "source_index long, embedding array<float>",
    )
    folder = Path(_run_folder(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    params = DedupParams(similarity_threshold=0.99999)
    result = deduplicate(records, params, vectors=vectors, vector_key="source_index")
    for table in set(folder.iterdir()) - before:
        assert not {"text", "record"} & set(spark.read.parquet(str(table)).columns)
    assert {r.source_index: r.row_index for r in result.retained.collect()} == {
        3 * i: i for i in range(40)
    }
    removed = result.removed.collect()
    near = {r.duplicate_index: r for r in removed if r.reason == "semantic_duplicate"}
    assert {i: (r.matched_index, r.retained_index) for i, r in near.items()} == {
        i: (i - 40, i - 40) for i in range(40, 50)
    }
    assert all(
        (r.duplicate_text, r.retained_text, r.record) == (f"t{i - 40}", f"t{i - 40}", f"r{i}")
        for i, r in near.items()
    )
    exact = {r.duplicate_source_index: r for r in removed if r.reason == "exact_duplicate"}
    assert {i: (r.retained_source_index, r.record) for i, r in exact.items()} == {
        3 * i: (3 * i - 150, f"r{i}") for i in range(50, 100)
    }
    assert result.report.first().retained_records == 40


def test_shuffle_files_go_with_the_table_that_is_written(spark):
    """not when the driver happens to collect its garbage."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        names = (blocks.getAllFiles().apply(i).getName() for i in range(blocks.getAllFiles().size()))
        return {name for name in names if name.startswith("shuffle_")}

    before = files()
    table = materialize(spark.range(1000).repartition(3, "id"), "shuffled")
    waited = time.time()
    while files() - before and time.time() - waited < 20:
        time.sleep(0.2)
    assert not files() - before
    with temporary(spark) as keep:
        first = materialize(table, "first")
        second = keep(materialize(first, "second"))
        paths = [Path(t.inputFiles()[0].removeprefix("file://")) for t in (first, second)]
    assert [p.exists() for p in paths] == [False, True] and second.count() == 1000
