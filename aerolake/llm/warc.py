"""WARC records in seekable Zstandard bundles, with an index from record to place.

A bundle is a file of Zstandard frames, each a group of whole records that decompresses by itself,
and a seek table at the end: a skippable frame with the compressed and decompressed size and the
checksum of every frame, then their number, as in the public seekable format. Plain Zstandard
readers see one WARC file. The index gives bundle, frame, and offset and length inside the
decompressed frame, so one record costs one footer and one frame.

Pages with equal payloads (same SHA-256 and size) are one ``response`` and ``revisit`` records
without payload that refer to it. The largest page_id of each payload is found by an aggregate over
light rows, so copies are reduced before the shuffle; payloads are shuffled once, to the answer.

Tasks write bundles of their own under names no other attempt uses and give the index of what they
closed. A bundle of a lost attempt is in no index and nothing reads it. The folder must be one that
all executors see and Arrow can open (a path, or file, hdfs, s3, gs).

Defined results: a null html is an empty payload; an empty one is a payload like any other; a null
url gives a record without target; white space and control characters of a url are written as %XX;
a null page_id counts as the smallest; of repeated rows one is the response. Other columns are
ignored. An empty table gives no rows. ``pages`` is read twice and must be the same both times, as
a stored table is.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches
from aerolake.plans.tables import stage
from aerolake.session import work_dir

FRAME_BYTES = 1_000_000  # of records in a frame, or one larger record
BUNDLE_BYTES = 256_000_000  # of records in a bundle
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, page_id bigint, path string, frame bigint, offset bigint, length bigint"
FRAMES = "path string, frame bigint, start bigint, size bigint, n_bytes bigint, checksum bigint"
RECORDS = (
    "record_id string, page_id bigint, record_type string, target_uri string, refers_to_record string,"
    " refers_to bigint, payload_digest string, payload_bytes bigint, payload binary,"
    " path string, frame bigint, offset bigint, length bigint"
)
_KINDS = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [part.split() for part in schema.split(", ")]
    return batch_of({name: (list(values), _KINDS[kind]) for (name, kind), values in zip(fields, zip(*rows))})


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


# --- records ---------------------------------------------------------------------------------


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{row}>"


def _page_of(name: str | None) -> int | None:
    found = re.fullmatch("<urn:x-page:(-?[0-9]+):[0-9]+>", name or "")
    return int(found[1]) if found else None


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, row, payload: bytes | None, sha1: bytes, first_id, first_row) -> bytes:
    """A response, or without payload a revisit of the record of ``first_id`` and ``first_row``."""
    target = None if url is None else re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    headers = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", record_id(page_id, row)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest_text(sha1)}"),
    ]
    if payload is None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(first_id, first_row))]
        block = head + b"\r\n"
    else:
        block = head + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    return record([*headers, ("Content-Type", "application/http;msgtype=response")], block)


def parse(frame: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """offset, length, headers (lower case) and block of the records of a decompressed frame."""
    at = 0
    while at < len(frame):
        stop = frame.index(b"\r\n\r\n", at)
        version, *lines = frame[at:stop].decode().split("\r\n")
        headers = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}
        end = stop + 4 + int(headers["content-length"])
        if version != "WARC/1.1" or frame[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"no WARC record at {at}")
        yield at, end + 4 - at, headers, frame[stop + 4 : end]
        at = end + 4


# --- bundles ---------------------------------------------------------------------------------


class Bundle:
    """Writes frames to a stream and keeps their sizes for the seek table."""

    def __init__(self, stream, level: int = LEVEL):
        self.stream, self.coder = stream, zstandard.ZstdCompressor(level=level)
        self.entries: list[tuple[int, int, int]] = []
        self.held: list[bytes] = []
        self.held_bytes = self.total = 0

    def add(self, record: bytes, frame_bytes: int) -> tuple[int, int]:
        """Frame and offset in it of a record."""
        if self.held and self.held_bytes + len(record) > frame_bytes:
            self.flush()
        place = len(self.entries), self.held_bytes
        self.held.append(record)
        self.held_bytes += len(record)
        self.total += len(record)
        return place

    def flush(self) -> None:
        if not self.held:
            return
        raw = b"".join(self.held)
        packed = self.coder.compress(raw)
        self.stream.write(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<III", *entry) for entry in self.entries)
        footer = struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.stream.close()


def seek_table(file, size: int) -> np.ndarray:
    """(compressed size, size, checksum) of every frame, read from the end of a bundle."""
    file.seek(size - 9)
    frames, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE or flags != CHECKSUMS:
        raise ValueError("no seek table with checksums at the end")
    file.seek(size - 9 - 12 * frames)
    return np.frombuffer(file.read(12 * frames), "<u4").reshape(-1, 3).astype(np.int64)


def _write(batches: Iterator[pa.RecordBatch], folder: str, frame_bytes: int, bundle_bytes: int):
    filesystem, base = _open(folder)
    filesystem.create_dir(base, recursive=True)
    context = TaskContext.get()
    mark = f"{context.partitionId():06d}-{context.taskAttemptId()}"
    bundle, rows, made = None, [], 0
    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for page_id, url, row, payload, sha1, first_id, first_row in zip(*columns):
            if bundle is None:
                name = f"bundle-{mark}-{made:04d}.warc.zst"
                bundle = Bundle(filesystem.open_output_stream(f"{base}/{name}", compression=None))
                about = b"format: WARC File Format 1.1\r\n"
                bundle.add(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-bundle:{name}>"),
                                   ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], about), frame_bytes)
            made_record = page_record(page_id, url, row, payload, sha1, first_id, first_row)
            place = bundle.add(made_record, frame_bytes)
            rows.append((record_id(page_id, row), page_id, f"{folder}/{name}", *place, len(made_record)))
            if bundle.total >= bundle_bytes:
                bundle.close()
                yield _batch(INDEX, rows)
                bundle, rows, made = None, [], made + 1
    if bundle is not None:
        bundle.close()
        yield _batch(INDEX, rows)


def write_bundles(
    pages: DataFrame,
    folder: str,
    least: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write a record for each page; the stored index (``INDEX``) of all bundles.

    Payloads of fewer than ``least`` bytes are always responses.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.monotonically_increasing_id().alias("row"),
        payload.alias("payload"),
    )
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256))).withColumn("size", F.length("payload"))
    first = (
        rows.filter(F.col("size") >= least)
        .groupBy("key", "size")
        .agg(F.max(F.struct("page_id", "row")).alias("first"))
    )
    joined = rows.join(first, ["key", "size"], "left")
    is_first = F.coalesce(F.col("first.row") == F.col("row"), F.lit(True))
    typed = joined.select(
        "page_id",
        "url",
        "row",
        F.when(is_first, F.col("payload")).alias("payload"),
        F.unhex(F.sha1("payload")).alias("sha1"),
        F.col("first.page_id").alias("first_id"),
        F.col("first.row").alias("first_row"),
    )
    work = partial(_write, folder=folder, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes)
    return stage(in_batches(typed, work, INDEX), "warc-index")


# --- reading ---------------------------------------------------------------------------------


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            filesystem, name = _open(path)
            with filesystem.open_input_file(name) as file:
                table = seek_table(file, file.size())
            if not len(table):
                continue
            ends = np.cumsum(table[:, 0])
            yield batch_of(
                {
                    "path": ([path] * len(table), pa.string()),
                    "frame": (np.arange(len(table)), pa.int64()),
                    "start": (ends - table[:, 0], pa.int64()),
                    "size": (table[:, 0], pa.int64()),
                    "n_bytes": (table[:, 1], pa.int64()),
                    "checksum": (table[:, 2], pa.int64()),
                }
            )


def _records(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    decoder, last, file = zstandard.ZstdDecompressor(), None, None
    for batch in batches:
        for path, frame, start, size, n_bytes, checksum in zip(*(c.to_pylist() for c in batch.columns)):
            if path != last:
                if file is not None:
                    file.close()
                filesystem, name = _open(path)
                last, file = path, filesystem.open_input_file(name)
            file.seek(start)
            raw = decoder.decompress(file.read(size), max_output_size=n_bytes)
            if len(raw) != n_bytes or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {frame} of {path} is damaged")
            rows = []
            for offset, length, headers, block in parse(raw):
                kind, name = headers["warc-type"], headers["warc-record-id"]
                payload, n, said = None, None, headers.get("warc-payload-digest", "").removeprefix("sha1:")
                if kind == "response":
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    n = len(payload)
                    if digest_text(hashlib.sha1(payload).digest()) != said:
                        raise ValueError(f"payload of {name} in {path} does not match its digest")
                refers = headers.get("warc-refers-to")
                rows.append((name, _page_of(name), kind, headers.get("warc-target-uri"), refers, _page_of(refers),
                             said or None, n, payload if payloads else None, path, frame, offset, length))
            yield _batch(RECORDS, rows)
    if file is not None:
        file.close()


def frames_of(paths: DataFrame) -> DataFrame:
    """Frames (``FRAMES``) of bundles, from their seek tables; ``paths`` has one column."""
    return in_batches(paths.distinct(), _frames, FRAMES)


def read_frames(frames: DataFrame, payloads: bool = True) -> DataFrame:
    """Records (``RECORDS``) of some frames, checked against their checksums and digests."""
    dealt = frames.repartition("path", "frame").sortWithinPartitions("path", "frame")
    return in_batches(dealt, partial(_records, payloads=payloads), RECORDS)


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records with the ids of ``wanted`` (column record_id); only their frames are read."""
    places = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    frames = frames_of(places.select("path")).join(places.select("path", "frame"), ["path", "frame"], "left_semi")
    return read_frames(frames).join(places.select("record_id"), "record_id", "left_semi")


def read_pages(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of all records of bundles.

    Size and digest of a revisit are those of the response it refers to, whose payload was read.
    """
    records = read_frames(frames_of(index.select("path")), payloads=False)
    records = stage(records.filter("record_type <> 'warcinfo'"), "warc-records")
    light = records.select(
        F.coalesce("refers_to_record", "record_id").alias("_of"), "page_id", "payload_digest", "record_type", "refers_to"
    )
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("_of"), "payload_bytes", F.col("payload_digest").alias("_read")
    )
    wrong = F.raise_error(F.concat(F.lit("no payload for "), "_of"))
    checked = F.when(F.col("_read") == F.col("payload_digest"), F.col("payload_digest")).otherwise(wrong)
    return light.join(responses, "_of", "left").select(
        "page_id", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to"
    )


def archive(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write the pages and read all of them back (``read_pages``)."""
    folder = folder or work_dir(pages.sparkSession, "warc")
    return read_pages(write_bundles(pages, folder, least))
