"""Deterministic sharded WARC archives from a table of pages, and the way back.

Records are range-sorted by their key: shards are cut at quantiles of the keys whose hash falls into a
fixed part, so the same table always gives the same shards. A task sorts its shard and writes files one
after the other, each closed once its compressed size reaches `file_bytes`. Every record is a gzip member
of its own. Headers and digests are made anew from the rows; record ids follow from key and digest.

A file is first written under a temporary name of the attempt and then renamed; when a shard is done,
its manifest (files, sizes, records, SHA-256) is renamed into place likewise. A repeated task writes the
same bytes under the same names, files show up only when they are complete, and `unsound_files` holds them
against the manifests. The archive folder is a URI; tasks reach it through pyarrow's file systems and
Spark reads it back.

Of records with equal payloads of at least `least_bytes`, the one with the smallest key is a response and
the others revisit it; shorter payloads are all responses. A revisit holds no payload but its digest,
its length (the extension field WARC-Payload-Length) and what it refers to.

Rules: NULL payloads are empty. A NULL key is written as an empty one, sorts first and is not
referred to unless no equal payload has a key; then all of these rows are responses. Rows repeated whole
are each a record of the same type. A NULL URL is `urn:page:` and the key.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import IntegerType

from riskmill.llm.store import shared_folder

#: The date of all records, since an archive made from a table has no time of its own.
DATE = "1970-01-01T00:00:00Z"


def record(kind: str, url: str, key: int | None, payload: bytes, length: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, compressed as a gzip member that is the same on every machine."""
    name = "" if key is None else str(key)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{digest}')}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Page-ID", name),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(length)),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if kind == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}/{digest}')}>"),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


class ShardWriter:
    """Files of one shard: rolled by compressed size, committed by renaming, listed in a manifest."""

    def __init__(self, folder: str, shard: int, file_bytes: int):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.shard, self.file_bytes, self.attempt = shard, file_bytes, uuid.uuid4().hex
        self.files: list[dict] = []
        self.out = None

    def _temporary(self, name: str) -> str:
        return f"{self.root}/_temporary/{self.attempt}-{name}"

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:05d}-{len(self.files):05d}.warc.gz"
            self.out = self.fs.open_output_stream(self._temporary(self.name), compression=None)
            self.size, self.records, self.sum = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.size, self.records = self.size + len(data), self.records + 1
        self.sum.update(data)
        if self.size >= self.file_bytes:
            self.roll()

    def roll(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self._temporary(self.name), f"{self.root}/{self.name}")
            self.files.append({"file": self.name, "bytes": self.size, "records": self.records, "sha256": self.sum.hexdigest()})
            self.out = None

    def commit(self) -> list[dict]:
        self.roll()
        name = f"shard-{self.shard:05d}.manifest.json"
        with self.fs.open_output_stream(self._temporary(name)) as out:
            out.write(json.dumps({"shard": self.shard, "files": self.files}, sort_keys=True).encode())
        self.fs.move(self._temporary(name), f"{self.root}/{name}")
        return self.files


def _written(folder: str, file_bytes: int):
    """Rows sorted by shard and key, decisions before records, to files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        decided: dict = {}

        def committed(w: ShardWriter) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"shard": w.shard, **f} for f in w.commit()],
                pa.schema([("shard", pa.int32()), ("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64()),
                           ("sha256", pa.string())]),
            )

        last_key = ()
        for batch in batches:
            names = batch.schema.names
            for values in zip(*(batch.column(c) for c in names)):
                row = {c: v.as_py() for c, v in zip(names, values)}
                if writer is None or writer.shard != row["shard"]:
                    if writer is not None:
                        yield committed(writer)
                    writer = ShardWriter(folder, row["shard"], file_bytes)
                if (row["shard"], row["key"]) != last_key:
                    last_key, decided = (row["shard"], row["key"]), {}
                if row["kind"] == 0:
                    decided[row["digest"]] = row["first"]
                    continue
                first = decided.get(row["digest"])
                again = first is not None and first != row["key"]
                payload = row["payload"] or b""
                url = row["url"] or f"urn:page:{'' if row['key'] is None else row['key']}"
                writer.add(record(
                    "revisit" if again else "response", url, row["key"], payload, len(payload), row["digest"],
                    first if again else None,
                ))
        if writer is not None:
            yield committed(writer)

    return write


def write_archive(
    pages: DataFrame, key: str, url: str, payload: str, folder: str, *, least_bytes: int = 100,
    file_bytes: int = 1 << 24, shard_bytes: int = 1 << 25, sample_rows: int = 20_000,
) -> DataFrame:
    """Writes the archive and returns its files, one row each: shard, file, bytes, records, sha256."""
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.regexp_replace(F.col(url), r"[\r\n]", " ").alias("url"),
        F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    narrow = rows.select("key", F.sha2("payload", 256).alias("digest"), F.length("payload").alias("length"))
    total = rows.agg(F.count("key"), F.coalesce(F.sum(F.length("payload")), F.lit(0))).first()
    every = max(1, total[0] // sample_rows)
    drawn = rows.filter(F.col("key").isNotNull() & (F.pmod(F.xxhash64("key"), F.lit(every)) == 0)).select("key")
    drawn = np.sort(np.array([r.key for r in drawn.limit(4 * sample_rows).collect()], np.int64))
    shards = max(1, -(-int(total[1]) // shard_bytes))
    bounds = np.unique(drawn[(np.arange(1, shards) * len(drawn)) // shards]) if len(drawn) else drawn

    @arrow_udf(IntegerType())
    def shard_of(keys: pa.Array) -> pa.Array:
        known = keys.fill_null(-(1 << 63))
        return pa.array(np.searchsorted(bounds, np.asarray(known), "right").astype(np.int32))

    # Equal payloads: only groups with a second record decide anything, and they are told to each key.
    large = narrow.filter(F.col("length") >= least_bytes)
    groups = large.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter(
        (F.col("n") > 1) & F.col("first").isNotNull()
    )
    decided = large.join(groups, "digest").select("key", "digest", "first").distinct().select(
        "key", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "first",
        F.lit(0).alias("kind"),
    )
    records = rows.select("key", "url", "payload", F.sha2("payload", 256).alias("digest"),
                          F.lit(None).cast("long").alias("first"), F.lit(1).alias("kind"))
    dealt = decided.unionByName(records).withColumn("shard", shard_of("key"))
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(f"{root}/_temporary", recursive=True)
    return dealt.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "key", "kind", "digest").mapInArrow(
        _written(folder, file_bytes), "shard int, file string, bytes long, records long, sha256 string"
    )


def _records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of each gzip member."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:  # in steps, since what a step leaves over is copied
            parts.append(unpack.decompress(view[at : at + 8192]))
            at += min(8192, len(view) - at)
        at -= len(unpack.unused_data)
        whole = b"".join(parts)
        head, _, rest = whole.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("sound", pa.bool_()),
    ])
    for batch in batches:
        for content in batch.column("content"):
            made = []
            for f, block in _records(content.as_py()):
                digest, key = f["WARC-Payload-Digest"].partition(":")[2], f.get("WARC-Page-ID", "")
                length, sound = int(f["WARC-Payload-Length"]), True
                if f["WARC-Type"] == "response":
                    body = block.partition(b"\r\n\r\n")[2]
                    sound = hashlib.sha256(body).hexdigest() == digest and len(body) == length
                made.append({
                    "page_id": int(key) if key else None, "payload_bytes": length, "payload_digest": digest,
                    "record_type": f["WARC-Type"], "url": f["WARC-Target-URI"], "sound": sound,
                    "refers_to": int(f["WARC-Refers-To-Page-ID"]) if "WARC-Refers-To-Page-ID" in f else None,
                })
                if len(made) == 1000:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made = []
            if made:
                yield pa.RecordBatch.from_pylist(made, schema)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url, sound."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.warc.gz").load(folder)
    columns = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, sound boolean"
    return files.select("content").mapInArrow(_parsed, columns)


def unsound_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that a manifest names and that are missing or of another size, and files that none names."""
    listed = spark.read.schema("files array<struct<file: string, bytes: long>>").json(
        f"{folder}/shard-*.manifest.json"
    ).select(F.explode("files").alias("f")).select("f.file", "f.bytes")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.warc.gz").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("found")
    )
    return listed.join(found, "file", "full").filter(~F.col("bytes").eqNullSafe(F.col("found")))


def archive_folder(spark: SparkSession, name: str) -> str:
    """A new folder for an archive in the shared one, as a URI."""
    shared = shared_folder(spark)
    return f"{shared if ':' in shared else 'file://' + shared}/{name}-{uuid.uuid4().hex}"
