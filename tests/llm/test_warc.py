"""Bundles against plain records, the seekable format, and damaged files."""

import base64
import hashlib
import io
import struct
from collections import Counter, defaultdict

import pytest
import zstandard

from aerolake.llm import warc

PAGES = "page_id bigint, url string, html string, path string, frame double, row string, size string, payload bigint"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.5, None, "s", 7) for r in rows], PAGES)


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two é\r\n\r\nWARC/1.1</p>"), (5, "http://a/ 5\n", "<p>one</p>"),
    (3, None, None), (4, "", ""), (9, "http://b/é", "<p>one</p>"), (-7, "http://b/7", ""), (8, "u", "x" * 50_000),
    (None, "none", "<p>none</p>"), (None, "none", "<p>one</p>"), (9, "http://b/é", "<p>one</p>"), (11, "v", "x" * 50_000),
    (12, "w", "tiny"), (13, "w", "tiny"),
]


def plain(rows, least):
    groups = defaultdict(list)
    for i, (page_id, _, html) in enumerate(rows):
        groups[html or ""].append((page_id is not None, page_id or 0, i))
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest))
    kinds = []
    for i, (page_id, _, html) in enumerate(rows):
        first = max(groups[html or ""])
        response = len((html or "").encode()) < least or first[2] == i
        kinds.append(("response", None) if response else ("revisit", first[1]))
    return Counter((*a, *b) for a, b in zip(out, kinds))


FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least", [0, 6])
def test_archive_reads_back(spark, tmp_path, least):
    frame = pages(spark, ROWS)
    out = warc.archive(frame, str(tmp_path / "a"), least).collect()
    # of repeated rows one is the response, whichever
    have = Counter(tuple(r[f] for f in FIELDS) for r in out)
    assert have == plain(ROWS, least)


def test_archive_of_nothing(spark, tmp_path):
    assert warc.archive(pages(spark, []), str(tmp_path / "a")).collect() == []


def bundles(index):
    return sorted({r["path"] for r in index.collect()})


def test_bundles_are_plain_zstandard_and_seekable(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>{i % 40} {'é' * (i % 90)}</p>") for i in range(300)]
    index = warc.write_bundles(pages(spark, rows).coalesce(2), str(tmp_path / "a"), 0, 2000, 12_000)
    paths = bundles(index)
    assert len(paths) > 2
    places = {(r["path"], r["frame"], r["offset"], r["length"]): r for r in index.collect()}
    seen = 0
    for path in paths:
        raw = open(path, "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        table = warc.seek_table(io.BytesIO(raw), len(raw))
        assert len(table) > 1 and raw[-4:] == struct.pack("<I", 0x8F92EAB1)
        parts, start = [], 0
        for frame, (size, n_bytes, _) in enumerate(table.tolist()):
            part = zstandard.ZstdDecompressor().decompress(raw[start : start + size])  # by itself
            assert len(part) == n_bytes <= 2000
            for offset, length, headers, _ in warc.parse(part):
                found = places.get((path, frame, offset, length))
                seen += found is not None and found["record_id"] == headers["warc-record-id"]
            parts.append(part)
            start += size
        assert b"".join(parts) == whole
    assert seen == len(rows)


def test_fetch_reads_only_the_frames_of_its_records(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>page {i}</p>" * 20) for i in range(200)]
    index = warc.write_bundles(pages(spark, rows).coalesce(1), str(tmp_path / "a"), 0, 3000)
    wanted = index.filter("page_id IN (3, 150)").select("record_id")
    places = {(r["path"], r["frame"]) for r in index.filter("page_id IN (3, 150)").collect()}
    # damage every other frame: they must not be read
    [path] = bundles(index)
    raw = bytearray(open(path, "rb").read())
    start = 0
    for frame, (size, _, _) in enumerate(warc.seek_table(io.BytesIO(bytes(raw)), len(raw)).tolist()):
        if (path, frame) not in places:
            raw[start : start + size] = b"\x00" * size
        start += size
    open(path, "wb").write(raw)
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.fetch(index, wanted).collect()}
    assert got == {i: rows[i][2] for i in (3, 150)}
    with pytest.raises(Exception, match="Zstd|damaged"):
        warc.read_pages(index).collect()


def test_urls_and_payloads_survive(spark, tmp_path):
    index = warc.write_bundles(pages(spark, ROWS), str(tmp_path / "a"))
    got = warc.read_frames(warc.frames_of(index.select("path"))).filter("record_type = 'response'").collect()
    assert {bytes(r["payload"]).decode() for r in got} == {html or "" for _, _, html in ROWS}
    urls = {r["page_id"]: r["target_uri"] for r in warc.read_frames(warc.frames_of(index.select("path"))).collect()}
    assert urls[5] == "http://a/%205%0A" and urls[3] is None and urls[9] == "http://b/é"
