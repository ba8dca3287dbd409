"""WARC: a deterministic sharded writer, and a reader of what it wrote.

Records are range-sorted by (page id, tie) and cut into partitions at ids that depend on the data
alone (a hash sample of the ids, weighed by payload bytes), so the same pages give the same files on
any cluster. Each partition streams its sorted records into gzip members, a new file whenever the
compressed size reaches ``roll_bytes``. Headers and digests are regenerated from the payload: of
records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the least id keeps it as
a response, the others become revisit records that name it.

Commit: every attempt of a task writes under a temporary name of its own and reports its files; the
reports are written as a table, whose commit chooses one attempt of each task; those files get their
final names in a job that may run again after a loss; the manifest comes last, under a temporary
name first. A folder without a manifest holds nothing, and readers open only what it lists.

Files go through ``pyarrow.fs`` by the folder's URI, so the folder must be of a kind it knows.

Edge cases: a null payload is empty; payloads below ``MIN_REVISIT`` bytes are always responses; ids
that repeat keep one record each, and of identical records with one id the first is the response;
null ids sort last and are spread by a hash of the record; a null address is left out; an empty
table gives a manifest without files. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import delete_path, materialize, path_exists, rename_path, scratch_path

MIN_REVISIT = 100
ROLL_BYTES = 1 << 30
PARTITION_BYTES = 2 << 30
MIN_PARTITIONS = 16
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
SOFTWARE = "chatloom"

# Ids sampled for each partition, and partitions at most: what the driver holds for the cuts.
SAMPLE_PER_PARTITION = 40
MAX_PARTITIONS = 20_000
_SPACE = 1 << 30

_NAMESPACE = uuid.UUID("5d0cf1a4-6b1e-5a7e-9a55-0f5f2c1f7b11")


def _prepared(pages: DataFrame) -> DataFrame:
    """Narrow facts of every record: id, tie, payload size and digest."""
    data = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.xxhash64(F.lit("tie"), F.col("url"), F.col("html")).alias("tie"),
        F.octet_length(data).cast("bigint").alias("bytes"),
        F.sha2(data, 256).alias("digest"),
    )


def _cuts(facts: DataFrame, partition_bytes: int) -> list[tuple[int, int, int]]:
    """Where partitions begin, as (id is null, id, tie), from a hash sample of the records."""
    rows, total = facts.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))
    ).first()
    wanted = min(MAX_PARTITIONS, max(MIN_PARTITIONS, -(-total // partition_bytes)))
    share = min(1.0, wanted * SAMPLE_PER_PARTITION / max(1, rows))
    place = F.pmod(F.xxhash64(F.lit("cut"), "page_id", "tie"), F.lit(_SPACE))
    sample = sorted(
        (int(row[0] is None), row[0] or 0, row[1], row[2] + 512)
        for row in facts.where(place < int(share * _SPACE)).select("page_id", "tie", "bytes").collect()
    )
    weight = sum(row[3] for row in sample)
    cuts, seen = [], 0
    for null, page_id, tie, size in sample:
        if seen * wanted >= weight * (len(cuts) + 1):
            cuts.append((null, page_id, tie))
        seen += size
    return sorted(set(cuts))


def _originals(facts: DataFrame) -> DataFrame:
    """For payloads that repeat: the id and tie of the record that keeps the payload."""
    first = F.struct(
        F.col("page_id").isNull().alias("null"), F.col("page_id").alias("id"), F.col("tie")
    )
    return (
        facts.where(F.col("bytes") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("records"))
        .where(F.col("records") > 1)
        .select("digest", "records", F.col("first.id").alias("first_id"), F.col("first.tie").alias("first_tie"))
    )


def record_id(page_id: int | None, tie: int, repeat: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}|{tie}|{repeat}')}>"


def _head(first: str, fields: list[tuple[str, object]]) -> bytes:
    lines = [first, *(f"{name}: {value}" for name, value in fields), "", ""]
    return "\r\n".join(lines).encode("utf-8")


def _field(value: str) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in value)


def _block_digest(data: bytes) -> str:
    return f"sha256:{hashlib.sha256(data).hexdigest()}"


def warc_record(
    page_id: int | None, tie: int, repeat: int, url: str | None, payload: bytes,
    digest: str, original: tuple[int | None, int] | None,
) -> bytes:
    """A response, or a revisit of the record ``original``, as WARC bytes."""
    http = _head(
        "HTTP/1.1 200 OK",
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))],
    )
    block = http if original else http + payload
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if original else "response"),
        ("WARC-Record-ID", record_id(page_id, tie, repeat)),
        ("WARC-Date", DATE),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _field(url)))
    if page_id is not None:
        fields.append(("X-Page-Id", page_id))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    fields.append(("WARC-Block-Digest", _block_digest(block)))
    if original:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields += [("WARC-Profile", profile), ("WARC-Refers-To", record_id(*original, 0))]
        if original[0] is not None:
            fields.append(("X-Refers-To-Page-Id", original[0]))
        fields.append(("X-Payload-Length", len(payload)))
    fields += [
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return _head("WARC/1.1", fields) + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """One gzip member without a time or name, so equal data gives equal bytes."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """The files of one partition: opened under temporary names, rolled by compressed size."""

    def __init__(self, folder: str, attempt: str, part: int, roll_bytes: int) -> None:
        self._files, root = pafs.FileSystem.from_uri(folder)
        self._root, self._attempt, self._part, self._roll = root, attempt, part, roll_bytes
        self._stream = None
        self.done: list[tuple[str, str, int, int, str]] = []

    def write(self, member: bytes) -> None:
        if self._stream is not None and self._size + len(member) > self._roll:
            self.close()
        if self._stream is None:
            self._name = f"part-{self._part:05d}-{len(self.done):05d}.warc.gz"
            self._temporary = f"_temporary/{self._attempt}-{self._name}"
            self._files.create_dir(f"{self._root}/_temporary", recursive=True)
            self._stream = self._files.open_output_stream(f"{self._root}/{self._temporary}", compression=None)
            self._size = self._records = 0
            self._hash = hashlib.sha256()
            info = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
            fields = [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMESPACE, self._name)}>"),
                ("WARC-Date", DATE),
                ("WARC-Filename", self._name),
                ("WARC-Block-Digest", _block_digest(info)),
                ("Content-Type", "application/warc-fields"),
                ("Content-Length", len(info)),
            ]
            self._put(_member(_head("WARC/1.1", fields) + info + b"\r\n\r\n"))
        self._put(member)
        self._records += 1

    def _put(self, data: bytes) -> None:
        self._stream.write(data)
        self._hash.update(data)
        self._size += len(data)

    def close(self) -> None:
        if self._stream is not None:
            self._stream.close()
            self._stream = None
            self.done.append(
                (self._name, self._temporary, self._records, self._size, self._hash.hexdigest())
            )


MANIFEST = "name string, temporary string, records bigint, bytes bigint, sha256 string"


def write_warc(
    pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES,
    partition_bytes: int = PARTITION_BYTES,
) -> None:
    """Write ``page_id``, ``url`` and ``html`` as WARC files with a manifest below ``folder``.

    A folder with a manifest is refused before anything is written. Without one, what an earlier
    attempt left behind is replaced: equal pages make equal files, and only a manifest makes them
    count. One writer at a time is meant to use a folder.
    """
    spark = pages.sparkSession
    if path_exists(spark, f"{folder}/_manifest"):
        raise FileExistsError(f"{folder} holds an archive")
    facts = materialize(_prepared(pages), "warc-facts")
    cuts = _cuts(facts, partition_bytes)
    originals = _originals(facts)
    # Facts of the records whose payload repeats; AQE splits a digest that very many share. A
    # record finds its facts in its own row again, so pages are not shuffled for it.
    part = F.lit(0)
    if cuts:
        part = _partition_of(cuts)
    data = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.xxhash64(F.lit("tie"), F.col("url"), F.col("html")).alias("tie"),
        F.col("url").cast("string"),
        data.alias("payload"),
        F.sha2(data, 256).alias("digest"),
    )
    records = _with_originals(records, originals)
    placed = records.withColumn("part", part)
    dealt = placed.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(
        "part", F.col("page_id").asc_nulls_last(), "tie"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        attempt = f"{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        roller, last, repeat = None, None, 0
        done: list = []
        for batch in batches:
            for row in batch.to_pylist():
                if roller is None or roller._part != row["part"]:
                    if roller is not None:
                        roller.close()
                        done += roller.done
                    roller = _Roller(folder, attempt, row["part"], roll_bytes)
                here = (row["page_id"], row["tie"])
                repeat = repeat + 1 if here == last else 0
                last = here
                original = None
                if row["repeats"]:
                    first = (row["first_id"], row["first_tie"])
                    original = None if first == here and repeat == 0 else first
                roller.write(
                    _member(
                        warc_record(
                            *here, repeat, row["url"], row["payload"], row["digest"], original
                        )
                    )
                )
        if roller is not None:
            roller.close()
            done += roller.done
        columns = list(zip(*done, strict=True)) or [()] * 5
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
            ["name", "temporary", "records", "bytes", "sha256"],
        )

    manifest = materialize(dealt.mapInArrow(run, MANIFEST), "warc-manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{root}/{row['temporary']}", f"{root}/{row['name']}"
                # A task that runs again finds its file under the final name already.
                if files.get_file_info(source).type != pafs.FileType.NotFound:
                    if files.get_file_info(f"{root}/_manifest").type != pafs.FileType.NotFound:
                        raise FileExistsError(f"{folder} holds an archive")
                    if files.get_file_info(target).type != pafs.FileType.NotFound:
                        files.delete_file(target)  # of an attempt that was not committed
                    files.move(source, target)
                if files.get_file_info(target).size != row["bytes"]:
                    raise OSError(f"{target} is not the file that was written")
            yield batch

    committed = manifest.mapInArrow(rename, MANIFEST).drop("temporary")
    committed.write.mode("overwrite").json(f"{folder}/_manifest.writing")
    if not rename_path(spark, f"{folder}/_manifest.writing", f"{folder}/_manifest"):
        raise FileExistsError(f"{folder}/_manifest")
    delete_path(spark, f"{folder}/_temporary")


def _partition_of(cuts: list[tuple[int, int, int]]):
    """Number of the last cut at or before a record, found in two steps of at most 150."""
    width = 150

    def literal(some) -> object:
        rows = [{"n": null, "i": page_id, "t": tie} for null, page_id, tie in some]
        return F.from_json(F.lit(json.dumps(rows)), "array<struct<n:int,i:bigint,t:bigint>>")

    chunks = [cuts[at : at + width] for at in range(0, len(cuts), width)]
    heads = literal([chunk[0] for chunk in chunks])
    rows = [[{"n": n, "i": i, "t": t} for n, i, t in chunk] for chunk in chunks]
    body = F.from_json(F.lit(json.dumps(rows)), "array<array<struct<n:int,i:bigint,t:bigint>>>")
    here = F.struct(
        F.col("page_id").isNull().cast("int").alias("n"),
        F.coalesce("page_id", F.lit(0)).cast("bigint").alias("i"),
        F.col("tie").alias("t"),
    )
    chunk = F.size(F.filter(heads, lambda cut: cut <= here))
    inside = F.size(F.filter(F.element_at(body, chunk), lambda cut: cut <= here))
    return F.when(chunk == 0, F.lit(0)).otherwise((chunk - 1) * width + inside).cast("int")


# Payloads that repeat, up to which they are broadcast (some 120 bytes each).
BROADCAST_PAYLOADS = 100_000


def _with_originals(records: DataFrame, originals: DataFrame) -> DataFrame:
    originals = materialize(originals, "warc-originals")
    if originals.count() <= BROADCAST_PAYLOADS:
        joined = records.join(F.broadcast(originals), "digest", "left")
    else:
        joined = records.join(originals, "digest", "left")
    return joined.withColumn("repeats", F.col("records").isNotNull()).drop("records")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("name string, records bigint, bytes bigint, sha256 string").json(
        f"{folder}/_manifest"
    )


RECORD = (
    "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, record_id string"
)


# Bytes that are unpacked at a time; what follows a record in them is copied once for each record.
_UNPACK_BYTES = 16 << 10


def _records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records of a file, one gzip member at a time."""
    unpacker, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        at = 0
        while at < len(chunk):
            piece = chunk[at : at + _UNPACK_BYTES]
            parts.append(unpacker.decompress(piece))
            at += len(piece)
            if not unpacker.eof:
                continue
            at -= len(unpacker.unused_data)
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            unpacker, parts = zlib.decompressobj(31), []
            fields = dict(
                line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:]
            )
            block = rest[: int(fields["Content-Length"])]
            if rest[len(block) :] != b"\r\n\r\n":
                raise ValueError("a record does not have the length that it states")
            if fields["WARC-Block-Digest"] != _block_digest(block):
                raise ValueError("a record does not match its digest")
            yield fields, block
    if any(parts):
        raise ValueError("the file ends inside a record")


class _Counted:
    """A stream that counts and hashes what is read from it."""

    def __init__(self, stream) -> None:
        self._stream = stream
        self.size, self.hash = 0, hashlib.sha256()

    def read(self, size: int) -> bytes:
        data = self._stream.read(size)
        self.size += len(data)
        self.hash.update(data)
        return data


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files that the manifest lists, checked against their digests; the files
    are checked against the manifest's sizes and hashes.

    A revisit has no payload; its size and digest are those of the record it refers to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        schema = pa.schema(
            [
                ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
            ]
        )

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        rows, held = [], 0
        listed = (row for batch in batches for row in batch.to_pylist())
        for name, size_listed, hash_listed in (tuple(row.values()) for row in listed):
            with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                counted = _Counted(stream)
                for fields, block in _records_of(counted):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if payload is None:
                        size = int(fields["X-Payload-Length"])
                    else:
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"a payload in {name} does not match its digest")
                    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
                    rows.append(
                        {
                            "page_id": None if page is None else int(page),
                            "url": fields.get("WARC-Target-URI"),
                            "record_type": kind,
                            "payload": payload,
                            "payload_bytes": size,
                            "payload_digest": digest,
                            "refers_to": None if refers is None else int(refers),
                            "record_id": fields["WARC-Record-ID"],
                        }
                    )
                    held += len(block)
                    if held > 8 << 20 or len(rows) >= 2_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if (counted.size, counted.hash.hexdigest()) != (size_listed, hash_listed):
                    raise ValueError(f"{name} is not the file that the manifest lists")
        yield batch_of(rows)

    listed = read_manifest(spark, folder).select("name", "bytes", "sha256")
    # A task for each file: the names are a short list, not the data.
    return listed.repartition(max(1, listed.count())).mapInArrow(run, RECORD)


def archive(pages: DataFrame) -> tuple[str, DataFrame]:
    """Write ``pages`` to a new shared folder and read the archives back."""
    folder = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, folder)
    return folder, read_warc(pages.sparkSession, folder)


WARC_SQL = """
WITH facts AS (
  SELECT page_id, encode(coalesce(html, '')) AS data, sha256(coalesce(html, '')) AS digest FROM pages),
sized AS (SELECT page_id, octet_length(data) AS n, digest FROM facts),
firsts AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS f
  FROM sized)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f = page_id THEN NULL ELSE f END AS refers_to
FROM firsts
"""
