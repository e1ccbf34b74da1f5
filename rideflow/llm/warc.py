"""WARC archives: a writer, and a splittable reader.

A gzipped WARC file is a chain of gzip members, one per record.  The reader cuts files into byte
ranges.  A task scans its range for the gzip magic, takes a candidate for a member only if it decodes
to WARC headers, and then owns every record that *starts* inside its range, reading past its end to
finish the last one.  So no two tasks give the same record and none is lost, whatever the cut.

Files are opened through ``pyarrow.fs`` by their URI, so archives may lie on any file system it knows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.llm.common import arrow_batches
from rideflow.sources import materialize

# Fixed values of the formats.
_MAGIC = b"\x1f\x8b\x08"
_BLANK = b"\r\n\r\n"
_GZIP = 31
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"

_BLOCK = 1 << 20
_STEP = 1 << 16

MANIFEST = "file string, n_records long, n_bytes long"
RECORD = (
    "file string, offset long, record_type string, record_id string, refers_to string, target_uri string, "
    "payload_bytes long, payload_digest string, payload binary"
)


# ---- writing ----------------------------------------------------------------------------------


def _value(text: str) -> str:
    """A header value on one line: control characters and blanks are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def encode_record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool, date: str, level: int) -> bytes:
    """One gzip member.  A revisit holds the HTTP headers only and names the record it repeats."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <{_ID}{'null' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_value(url)}")
    if is_revisit:
        lines += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    packer = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
    return packer.compress("\r\n".join(lines).encode() + _BLANK + block + _BLANK) + packer.flush()


def _write_part(folder: str, date: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        name, out, count = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store.create_dir(top, recursive=True)
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                out.write(
                    encode_record(
                        row["id"], row["url"], row["payload"], row["digest"], row["refers_to"], row["is_revisit"], date, level
                    )
                )
                count += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "n_records": count, "n_bytes": size}])

    return write


def write_warc(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
    level: int = 4,
) -> DataFrame:
    """Write a record per row below ``folder``; the manifest of the files, written already.

    The payload is the html in UTF-8 (null: empty).  Of records with equal payloads of at least
    ``least_bytes``, the one with the largest id is the response and the others are revisits of it.
    Rows that share the largest id are all responses; a null id is below every other, and where all
    ids are null all records are responses.  A null url has no target header.  No rows: no file.

    Each task writes a file under a name of its own; what a lost task left behind is not in the
    manifest, whose rows Spark commits.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn(
        "digest", F.sha1("payload")
    )
    kept = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("keep").isNotNull())
        .select(F.col("digest").alias("of"), "keep")
    )
    # Written first, so that both sides of the join are plain scans: a payload that a third of all
    # pages share is a skewed key that Spark can then split.
    kept = materialize(kept, label="warc-kept")
    revisit = F.col("keep").isNotNull() & F.coalesce(F.col("id") != F.col("keep"), F.lit(True))
    records = rows.join(kept, F.col("digest") == F.col("of"), "left").select(
        "id", "url", "payload", "digest", F.col("keep").alias("refers_to"), revisit.alias("is_revisit")
    )
    with arrow_batches(spark, 200):
        return materialize(records.mapInArrow(_write_part(folder, date, level), MANIFEST), label="warc-manifest")


# ---- reading ----------------------------------------------------------------------------------


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _starts_record(f: BinaryIO, at: int) -> bool:
    """Whether the bytes at ``at`` are a gzip member that begins with WARC headers, of any length."""
    f.seek(at)
    unpack, text, seen = zlib.decompressobj(_GZIP), bytearray(), 0
    try:
        while not unpack.eof:
            block = unpack.unconsumed_tail or f.read(4096)
            if not block:
                break
            text += unpack.decompress(block, _STEP)
            if not text.startswith(b"WARC/"[: len(text)]):
                return False
            if text.find(_BLANK, seen) >= 0:
                break
            seen = max(len(text) - len(_BLANK) + 1, 0)
    except zlib.error:
        return False
    head, blank, _ = bytes(text).partition(_BLANK)
    return bool(blank) and head.startswith(b"WARC/") and {"warc-type", "content-length"} <= _headers(head).keys()


def _next_record(f: BinaryIO, at: int, end: int) -> int | None:
    """The first offset of a record in [at, end)."""
    while at < end:
        f.seek(at)
        block = f.read(min(_BLOCK, end - at) + len(_MAGIC) - 1)
        found = block.find(_MAGIC)
        while found >= 0 and at + found < end:
            if _starts_record(f, at + found):
                return at + found
            found = block.find(_MAGIC, found + 1)
        at += max(len(block) - len(_MAGIC) + 1, 1)
    return None


def _member(f: BinaryIO, at: int) -> tuple[bytes, int]:
    """The decoded member at ``at`` and the offset behind it."""
    f.seek(at)
    unpack, parts, read = zlib.decompressobj(_GZIP), [], 0
    while not unpack.eof:
        block = f.read(1 << 16)
        if not block:
            raise OSError(f"the record at {at} is cut off")
        read += len(block)
        parts.append(unpack.decompress(block))
    return b"".join(parts), at + read - len(unpack.unused_data)


def _digest_of(header: str | None) -> str | None:
    """Lower-case hex of a ``sha1:`` header in base 32 or hex."""
    if not header:
        return None
    text = header.rpartition(":")[2]
    return text.lower() if len(text) == 40 else base64.b32decode(text).hex()


def parse_record(member: bytes) -> dict:
    head, _, rest = member.partition(_BLANK)
    headers = _headers(head)
    block = rest[: int(headers["content-length"])]
    kind, payload, size = headers["warc-type"], block, len(block)
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(_BLANK)
        size = int(_headers(http).get("content-length", len(payload))) if kind == "revisit" else len(payload)
    digest = _digest_of(headers.get("warc-payload-digest")) if kind == "revisit" else hashlib.sha1(payload).hexdigest()
    return {
        "record_type": kind,
        "record_id": headers.get("warc-record-id"),
        "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if kind == "revisit" else payload,
    }


def records_in_range(f: BinaryIO, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """(offset, record) of every record that starts in [start, end)."""
    at = _next_record(f, start, end)
    while at is not None and at < end:
        member, behind = _member(f, at)
        yield at, parse_record(member)
        f.seek(behind)
        at = behind if f.read(len(_MAGIC)) == _MAGIC and _starts_record(f, behind) else _next_record(f, behind, end)


def _read_ranges(with_payload: bool):
    schema = pa.schema(
        [
            ("file", pa.string()),
            ("offset", pa.int64()),
            ("record_type", pa.string()),
            ("record_id", pa.string()),
            ("refers_to", pa.string()),
            ("target_uri", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["file"])
                rows, held = [], 0
                with store.open_input_file(path) as f:
                    for at, record in records_in_range(f, row["start"], row["end"]):
                        if not with_payload:
                            record["payload"] = None
                        rows.append({"file": row["file"], "offset": at} | record)
                        held += len(record["payload"] or b"") + 500
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def list_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, n_bytes) of the files under ``path`` (a folder or glob), listed by Spark."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # Spark names local files file:/x; pyarrow wants file:///x.
    file = F.regexp_replace("path", "^file:/+", "file:///")
    return found.select(file.alias("file"), F.col("length").alias("n_bytes"))


def read_warc(files: DataFrame, *, split_bytes: int = 8 << 20, with_payload: bool = True) -> DataFrame:
    """The records of ``files`` (file, n_bytes), with columns RECORD, read in ranges of ``split_bytes``.

    The digest and size of a response are those of the payload as read; a revisit has no payload and
    gives the size and digest of its headers.  An empty file has no record; a record that is cut off
    or fails its checksum raises.
    """
    spark = files.sparkSession
    total = files.agg(F.sum(F.ceil(F.col("n_bytes") / split_bytes))).first()[0] or 1
    cuts = F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(split_bytes).cast("long"))
    ranges = (
        files.filter("n_bytes > 0")
        .select("file", "n_bytes", F.explode(cuts).alias("start"))
        .select("file", "start", F.least(F.col("start") + split_bytes, F.col("n_bytes")).alias("end"))
        .repartition(int(total))
    )
    return ranges.mapInArrow(_read_ranges(with_payload), RECORD)


def page_of(record_id):
    """The id of the page in a record id that ``write_warc`` gave (null for a null id)."""
    return F.expr(f"try_cast(regexp_extract({record_id}, '{_ID}(-?[0-9]+)', 1) AS BIGINT)")
