"""WARC archives: a writer with revisit records, and a splittable reader.

Every record is a gzip member of its own. Reading tasks get byte ranges; each scans its range
for the gzip magic, accepts a candidate when its header decodes to a WARC record and the member
ends properly, and owns the records that start inside its range.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32decode, b32encode
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placaflow.llm.common import durable, keep_clear, new_folder, small

MAGIC = b"\x1f\x8b\x08"
#: Shorter payloads are always stored whole.
REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "record_id string, record_type string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a shared folder."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(folder)


def mark_revisits(df: DataFrame, key: str, payload: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Adds `_payload`, `_digest` (SHA-1, lower-case hex), `_bytes`, `_refers`.

    Of rows with equal payloads of `least` bytes or more, the one with the largest key is
    stored; the others refer to it. Rows repeating that largest key are all stored. Null keys
    are smaller than all others; a group without any key is stored whole.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.select("*", body.alias("_payload")).select(
        "*", F.sha1("_payload").alias("_digest"), F.octet_length("_payload").cast("long").alias("_bytes"),
        F.xxhash64("_payload").alias("_hash"),
    )
    same = ["_digest", "_bytes", "_hash"]
    groups = (
        rows.where(F.col("_bytes") >= least).groupBy(*same)
        .agg(F.max(key).alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 AND _last IS NOT NULL").drop("_n")
    )
    groups = durable(groups)
    refers = F.when(~F.col(key).eqNullSafe(F.col("_last")), F.col("_last"))
    joined = rows.join(small(groups, groups.count(), 120), same, "left")
    return joined.withColumn("_refers", refers).drop("_hash", "_last")


def _header(pairs: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs).encode()


def _urn(key: str | None) -> str:
    return f"<urn:record:{'' if key is None else key}>"


def encode_record(key, uri, payload: bytes, digest: str, refers) -> bytes:
    """One gzip member. A revisit keeps the HTTP header, which has the payload's length."""
    http = b"HTTP/1.1 200 OK\r\n" + _header(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    )
    block = http + b"\r\n" + (payload if refers is None else b"")
    head = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", _urn(key)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if uri is not None:
        head.append(("WARC-Target-URI", " ".join(uri.split())))
    if refers is not None:
        head += [("WARC-Refers-To", _urn(refers)), ("WARC-Profile", PROFILE)]
    record = b"WARC/1.1\r\n" + _header(head) + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_warc(df: DataFrame, key: str, uri: str, payload: str, folder: str | None = None) -> DataFrame:
    """Write one record per row; the manifest (path, bytes, records) of the archives.

    Null payloads are empty, null URIs have no header line. Every task attempt writes files of
    its own; only those of the attempt that ended are in the manifest, so a lost executor or a
    repeated task leaves at most files that nobody reads. An empty frame writes no archive.
    """
    folder = folder or new_folder(df.sparkSession, "warc")
    df = keep_clear(df, ["_payload", "_digest", "_bytes", "_refers", "_hash", "_last", "_n"])
    rows = mark_revisits(df, key, payload).select(
        F.col(key).cast("string").alias("key"), F.col(uri).cast("string").alias("uri"),
        F.col("_payload").alias("payload"), F.col("_digest").alias("digest"),
        F.col("_refers").cast("string").alias("refers"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        done: list[tuple[str, int, int]] = []
        out, name, size, count = None, "", 0, 0
        attempt = uuid.uuid4().hex
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():06d}-{len(done):04d}-{attempt}.warc.gz"
                    out, size, count = files.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                member = encode_record(*row)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= FILE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, count))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "bytes", "records"])

    return durable(rows.mapInArrow(write, "path string, bytes long, records long"))


class Damaged(ValueError):
    """An archive whose members do not follow one another up to its end."""


class _Window:
    """Bytes of a file from a start on, read on demand."""

    def __init__(self, file: pa.NativeFile, start: int, length: int, size: int) -> None:
        self.file, self.start, self.size = file, start, size
        self.data = bytearray(file.read_at(min(length, size - start), start))

    def more(self) -> bool:
        at = self.start + len(self.data)
        if at >= self.size:
            return False
        self.data += self.file.read_at(min(1 << 20, self.size - at), at)
        return True


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The record whose gzip member starts at a place and where the member ends, if it is one."""
    unpack = zlib.decompressobj(31)
    out: list[bytes] = []
    fed, checked = at, False
    try:
        while not unpack.eof:
            if fed >= len(window.data) and not window.more():
                return None
            chunk = bytes(window.data[fed : fed + (1 << 16)])
            fed += len(chunk)
            out.append(unpack.decompress(chunk))
            if not checked and sum(map(len, out)) >= 7:
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    return (b"".join(out), fed - len(unpack.unused_data)) if checked else None


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _key(urn: str | None) -> str | None:
    return (urn or "").removeprefix("<urn:record:").removesuffix(">") or None


def decode_record(record: bytes) -> tuple:
    """A row of `RECORDS`. The payload of a revisit is null; its length is in the HTTP header."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields.get("content-length", "0"))]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields.get("warc-type") == "revisit"
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    digest = b32decode(digest).hex() if digest else None
    if not revisit and digest and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return (
        _key(fields.get("warc-record-id")), fields.get("warc-type"), _key(fields.get("warc-refers-to")),
        fields.get("warc-target-uri"), digest,
        int(_fields(http).get("content-length", "0")) if revisit else len(payload),
        None if revisit else payload,
    )


def read_range(path: str, start: int, end: int, size: int) -> Iterator[tuple]:
    """The records whose gzip members start in [start, end).

    The first candidate of a range may lie inside another member (an archive stored in an
    archive); it counts only if another member or the end of the file follows it. After it, each
    member must begin where the one before it ends, and the one after a range's last must be whole
    too, so that a damaged or cut member raises `Damaged` in whichever range it lies, for any
    split; so does a file of another size than its manifest says.
    """
    files, name = open_folder(path)
    with files.open_input_file(name) as file:
        if file.size() != size:
            raise Damaged(f"{path} has {file.size()} bytes, not {size}")
        window = _Window(file, start, end - start + len(MAGIC) - 1, size)
        at, aligned = 0, start == 0
        while start + at < size:
            if not aligned and not 0 <= (at := window.data.find(MAGIC, at)) < end - start:
                return
            found = _member(window, at)
            if found is None and aligned:
                raise Damaged(f"{path} has no whole record at byte {start + at}")
            if found is None:
                at += 1
                continue
            if at >= end - start:  # the next range's first, which is whole
                return
            record, after = found
            while after + len(MAGIC) > len(window.data) and window.more():
                pass
            if not aligned and window.data[after : after + len(MAGIC)] not in (MAGIC, b""):
                at += 1
                continue
            yield decode_record(record)
            at, aligned = after, True


def read_warc(spark: SparkSession, manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the archives of a manifest (path, bytes); columns as in `RECORDS`."""
    spans = manifest.select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes))).alias("start")
    ).select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"), "bytes")
    tasks = max(1, spans.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
            ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
            ("payload", pa.binary()),
        ])
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for span in zip(*(c.to_pylist() for c in batch.columns)):
                for row in read_range(*span):
                    rows.append(row)
                    size += len(row[-1] or b"") + 100
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return spans.repartition(tasks).mapInArrow(read, RECORDS)
