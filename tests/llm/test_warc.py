"""Packages: directories, ZIP64, ranges, and the round trip of records."""

import base64
import hashlib
import io
import struct
import zipfile
from collections import defaultdict

import pytest

from teamlines.llm import warc

SCHEMA = "page_id long, url string, html string, row_id int, first int, same string, file string"


def table(written, rows):
    return written([(*r, 1, 2, "s", "f") for r in rows], SCHEMA)


ROWS = [
    (4, "http://a/", "<p>same</p>"), (2, "http://b/ c", "<p>same</p>"), (2, "http://b/ c", "<p>same</p>"), (None, "http://n/", "<p>same</p>"),
    (7, None, None), (6, "", ""), (9, "http://é/", "é\U0001f600" * 1000), (10, "http://x/", "\r\n\r\nWARC/1.1\r\n\r\n"), (11, "http://long/", "word " * 500_000),
    (12, "u\r\nX: y", "own"),
]


def read(docs, **settings):
    files = warc.write_packages(docs, **settings)
    return files, warc.read_records(files, span=2000).collect()


@pytest.mark.parametrize("least,limit", [(0, 1 << 26), (0, 1), (5, 3000)])
def test_round_trip(written, least, limit):
    _, found = read(table(written, ROWS), least=least, limit=limit)
    payload = lambda t: (t or "").encode()
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in found) == sorted((str(i), len(payload(t)), sha(payload(t))) for i, _, t in ROWS)
    groups = defaultdict(list)
    for r in found:
        groups[r.payload_digest].append(r)
    for rows in groups.values():
        first = [r for r in rows if r.record_type == "response"]
        if rows[0].payload_bytes < least:
            assert len(first) == len(rows)
            continue
        assert len(first) == 1
        assert first[0].page_id == min((r.page_id for r in rows if r.page_id is not None), default=None)
        assert {r.refers_to for r in rows if r.record_type == "revisit"} <= {first[0].page_id}
        assert sha(first[0].payload) == first[0].payload_digest
    urls = {r.page_id: r.url for r in found}
    assert urls[9] == "http://é/" and urls[12] == "u X: y" and urls[7] == ""


def test_empty_table(written):
    files, found = read(table(written, []))
    assert files.count() == 0 and found == []


def test_ranges_fetch_single_records(written):
    files = warc.write_packages(table(written, ROWS))
    rows = warc.read_records(files).collect()
    for r in rows:
        with open(r.file, "rb") as source:
            fields, _, payload = warc.parsed(warc.read_at(source, r.begin, r.size))
        assert fields["WARC-Type"] == r.record_type and (payload is None or payload == bytes(r.payload))


def zipped(compression=zipfile.ZIP_STORED, note=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", compression) as z:
        z.writestr("a.txt", b"alpha")
        z.writestr("dir/é.bin", b"\0" * 100)
        z.comment = note
    return out.getvalue()


@pytest.mark.parametrize("note", [b"", b"a note", b"PK\x05\x06" + b"x" * 30])
def test_directories(note):
    data = zipped(note=note)
    source = io.BytesIO(data)
    found = warc.directory(source, len(data))
    assert sorted(found) == ["a.txt", "dir/é.bin"]
    at = warc.member_start(source, found["a.txt"])
    assert data[at : at + found["a.txt"][1]] == b"alpha"


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 1)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = zipped()
    assert warc.LOCATOR64 in data
    source = io.BytesIO(data)
    found = warc.directory(source, len(data))
    at = warc.member_start(source, found["dir/é.bin"])
    assert data[at : at + found["dir/é.bin"][1]] == b"\0" * 100


def test_wide_entries_take_only_what_the_entry_lacks():
    extra = struct.pack("<2HH", 9, 2, 0) + struct.pack("<2HQ", 1, 8, 1 << 40)
    assert warc._wide(extra, 5, 5, 0xFFFFFFFF) == (5, 5, 1 << 40)


def test_broken_packages():
    for data in (b"", b"PK", zipped()[:-5], zipped(zipfile.ZIP_DEFLATED)):
        source = io.BytesIO(data)
        with pytest.raises(warc.PackageError):
            warc.member_start(source, warc.directory(source, len(data))["a.txt"])
