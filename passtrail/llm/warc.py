"""WARC archives in Zstandard: a dictionary in a leading skippable frame, then one frame per record.

Writing: each scan partition rolls its records into archives of a bounded size, so a lost executor only costs its own partitions.
A file gets its name when it is complete, so a failed attempt leaves nothing that a reader would find.
Reading: each archive is decoded frame by frame; every frame must hold exactly one record, whose version line, mandatory headers,
lengths and digests are checked.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passtrail.llm import common

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES, DICTIONARY_SAMPLES, SAMPLE_BYTES = 16 << 10, 64, 8 << 10
MIN_REVISIT_BYTES = 100
ARCHIVES = "name string, records bigint, content binary"
RECORDS = (
    "archive string, position bigint, record_id string, record_type string, refers_to_id string, target_uri string,"
    " payload_length bigint, payload_digest string, payload binary, error string"
)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_DATE = "2024-01-01T00:00:00Z"


# -------------------------------------------------------------------------------------------------------------- records


def record(
    record_id: str, kind: str, payload: bytes, digest: str, uri: str | None, refers_to: str | None = None, date: str = _DATE
) -> bytes:
    """A response or a revisit as bytes. A revisit's block is the HTTP head alone, which still gives the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if uri is not None:
        lines.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", uri)))
    if kind == "revisit":
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    lines += [
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    text = "".join(f"{name}: {value}\r\n" for name, value in lines).encode()
    return VERSION + b"\r\n" + text + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The fields of one record. ValueError says what is wrong with it."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("the header does not end")
    version, *lines = data[:end].split(b"\r\n")
    if version not in (b"WARC/1.0", VERSION):
        raise ValueError(f"version line {version[:20]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"header line {line[:40]!r}")
        headers.setdefault(name.lower(), value.strip())
    for name in MANDATORY:
        if name.lower() not in headers:
            raise ValueError(f"no {name}")
    length = headers["content-length"]
    if not length.isdecimal() or not length.isascii():
        raise ValueError(f"Content-Length {length[:20]!r}")
    start = end + 4
    stop = start + int(length)
    if data[stop:] != b"\r\n\r\n":
        raise ValueError(f"a block of {len(data) - start - 4} bytes, not {length}")
    block = data[start:stop]
    _digest(headers.get("warc-block-digest"), block, "block")
    kind, payload, size = headers["warc-type"], block, len(block)
    if headers.get("content-type", "").startswith("application/http"):
        head, gap, payload = block.partition(b"\r\n\r\n")
        if not gap:
            raise ValueError("the HTTP head does not end")
        given = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", head)
        size = int(given[1]) if given else len(payload)
        if kind == "response" and size != len(payload):
            raise ValueError(f"a payload of {len(payload)} bytes, not {size}")
    digest = headers.get("warc-payload-digest")
    if kind == "revisit":
        if "warc-refers-to" not in headers or digest is None:
            raise ValueError("a revisit without WARC-Refers-To or WARC-Payload-Digest")
        payload = None
    else:
        _digest(digest, payload, "payload")
    return {
        "record_id": headers["warc-record-id"].strip("<>"), "record_type": kind, "target_uri": headers.get("warc-target-uri"),
        "refers_to_id": headers["warc-refers-to"].strip("<>") if kind == "revisit" else None, "payload_length": size,
        "payload_digest": digest.partition(":")[2] if digest else hashlib.sha256(payload).hexdigest(), "payload": payload,
    }


def _digest(given: str | None, data: bytes, what: str) -> None:
    if given is not None and given.startswith("sha256:") and given[7:] != hashlib.sha256(data).hexdigest():
        raise ValueError(f"the {what} digest differs")


# ------------------------------------------------------------------------------------------------------------- archives


class Archive:
    """An archive that grows by records. The dictionary is learned from a bounded sample of the first ones."""

    def __init__(self, samples: list[bytes], level: int = 3):
        self.parts, self.size, self.records, dictionary = [], 0, 0, None
        if len(samples) >= 16 and sum(map(len, samples)) >= 8 * DICTIONARY_BYTES:
            try:
                dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
            except zstandard.ZstdError:  # samples that have nothing in common
                dictionary = None
        if dictionary is not None:
            raw = dictionary.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
        self.packer = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True, write_content_size=True)

    def _put(self, data: bytes) -> None:
        self.parts.append(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.packer.compress(data))
        self.records += 1

    def content(self) -> bytes:
        return b"".join(self.parts)


def frames(content: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(position, record bytes, error) of each frame after the dictionary. A broken frame ends the archive.

    The dictionary frame may hold the dictionary itself or a compressed one. Other skippable frames are passed over.
    """
    view, at, dictionary = memoryview(content), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", view, 4)[0]
        if 8 + size > len(view):
            yield 0, None, "the dictionary frame is cut off"
            return
        raw = bytes(view[8 : 8 + size])
        try:
            if raw[:4] == struct.pack("<I", ZSTD_FRAME):
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
            dictionary = zstandard.ZstdCompressionDict(raw)
        except zstandard.ZstdError as e:
            yield 0, None, f"the dictionary: {e}"
            return
        at = 8 + size
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at >= 8 and struct.unpack_from("<I", view, at)[0] & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", view, at + 4)[0]
            continue
        frame, out, begin = unpacker.decompressobj(), [], at
        try:
            while not frame.eof:
                if at >= len(view):
                    raise zstandard.ZstdError("it is cut off")
                fed = bytes(view[at : at + (1 << 16)])
                out.append(frame.decompress(fed))
                at += len(fed) - len(frame.unused_data)
        except zstandard.ZstdError as e:
            yield begin, None, f"the frame: {e}"
            return
        yield begin, b"".join(out), None


def write_archives(records: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of records (``record_id``, ``record_type``, ``refers_to_id``, ``target_uri``, ``payload_digest``, ``payload``).

    With a folder, whose URI all executors reach, the archives become files there, named by partition and number; the result has one
    row per file and must be run for them to be written. A file appears under its name when it is complete, and a repeated task writes
    the same one again. Without a folder, ``content`` holds each archive. A null payload is empty. A single record can make an archive
    larger than ``archive_bytes``.
    """
    columns = ("record_id", "record_type", "refers_to_id", "target_uri", "payload_digest")

    def roll(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, archive in _rolled(parts, archive_bytes):
            content = archive.content()
            if folder is not None:
                _save(f"{folder.rstrip('/')}/{name}", content)
            yield pa.record_batch(
                [pa.array([name]), pa.array([archive.records], pa.int64()), pa.array([None if folder else content], pa.binary())],
                names=["name", "records", "content"],
            )

    return records.select(*columns, F.col("payload").cast("binary").alias("payload")).mapInArrow(roll, ARCHIVES)


def _rolled(parts: Iterator[pa.RecordBatch], archive_bytes: int) -> Iterator[tuple[str, Archive]]:
    partition, number, archive = TaskContext.get().partitionId(), 0, None
    for part in common.batches(parts):
        rows = part.to_pylist()
        for row in rows:
            payload = row["payload"] or b""
            data = record(row["record_id"], row["record_type"], payload, row["payload_digest"], row["target_uri"], row["refers_to_id"])
            if archive is None:
                archive = Archive([(r["payload"] or b"")[:SAMPLE_BYTES] for r in rows[:DICTIONARY_SAMPLES]])
            archive.add(data)
            if archive.size >= archive_bytes:
                yield f"part-{partition:06d}-{number:04d}.warc.zst", archive
                number, archive = number + 1, None
    if archive is not None:
        yield f"part-{partition:06d}-{number:04d}.warc.zst", archive


def _save(uri: str, content: bytes) -> None:
    store, path = fs.FileSystem.from_uri(uri)
    begun = f"{path}.{uuid.uuid4().hex}.begun"
    with store.open_output_stream(begun) as out:
        out.write(content)
    store.move(begun, path)


def load_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``name`` and ``content`` of all archives in a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return found.select(F.col("path").alias("name"), "content")


def read_archives(archives: DataFrame, name: str = "name", content: str = "content", with_payload: bool = True, strict: bool = False) -> DataFrame:
    """The records of archives: rows with a name and the archive's bytes, such as Spark's ``binaryFile`` source gives as ``path`` and
    ``content``.

    A record or a frame that is not as it should be gives a row with ``error``, or with ``strict`` fails the job. A null or empty
    archive has no records. Revisits have no payload. Other columns are not looked at.
    """

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [c.split()[0] for c in RECORDS.split(", ")]
        types = [pa.binary() if "binary" in c else pa.int64() if "bigint" in c else pa.string() for c in RECORDS.split(", ")]
        for part in common.batches(parts):
            for path, data in zip(*[part.column(c).to_pylist() for c in (0, 1)]):
                rows, held = [], 0
                for position, record_bytes, error in frames(data or b""):
                    row = {"archive": path, "position": position, "error": error}
                    if record_bytes is not None:
                        try:
                            row |= parsed(record_bytes)
                        except ValueError as e:
                            row["error"] = str(e)
                    if strict and row["error"]:
                        raise ValueError(f"{path} at {position}: {row['error']}")
                    held += len(row.get("payload") or b"")
                    if not with_payload:
                        row.pop("payload", None)
                    rows.append(row)
                    if held > (16 << 20) or len(rows) >= 10_000:
                        yield _batch(rows, fields, types)
                        rows, held = [], 0
                yield _batch(rows, fields, types)

    return archives.select(F.col(name), F.col(content)).mapInArrow(read, RECORDS)


def _batch(rows: list[dict], fields: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r.get(f) for r in rows], t) for f, t in zip(fields, types)], names=fields)


# ---------------------------------------------------------------------------------------------------------------- pages


def page_records(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", body_column: str = "html") -> DataFrame:
    """Pages as records, with revisits of equal payloads.

    Of payloads of at least 100 bytes that are equal, the page with the smallest id is a response and the others revisit it; rows
    that share that id are all responses. Shorter payloads, and null ones, which are empty, are responses. A null id is larger than
    any other. Payloads are told apart by SHA-256, as the format does. Other columns are not looked at.
    """
    body = F.coalesce(F.col(body_column), F.lit(""))
    narrow = pages.select(
        F.col(id_column).cast("long").alias("id"), F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("size")
    )
    large = narrow.filter(F.col("size") >= MIN_REVISIT_BYTES).select("id", "digest").distinct()
    order = F.struct(F.col("id").isNull().alias("none"), "id")
    firsts = {"_first": (lambda: F.min(order), F.min)}
    again = common.share_in_groups(large, ["digest"], firsts, F.col("id")).filter(~F.col("id").eqNullSafe(F.col("_first.id")))
    again = again.select(F.col("id").alias("_i"), F.col("digest").alias("_d"), F.col("_first.id").alias("first"), F.lit(True).alias("again"))
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"), F.col(url_column).cast("string").alias("target_uri"), body.alias("payload"),
        F.sha2(body, 256).alias("payload_digest"),
    )
    told = rows.join(again, F.col("id").eqNullSafe(F.col("_i")) & (F.col("payload_digest") == F.col("_d")), "left")
    return told.select(
        _name(F.col("id")).alias("record_id"), F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"),
        F.when(F.col("again"), _name(F.col("first"))).alias("refers_to_id"), "target_uri", "payload_digest", "payload",
    )


def _name(page: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("null")))


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^urn:page:(-?[0-9]+)$", 1).try_cast("long")
