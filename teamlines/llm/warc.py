"""WARC records in ZIP packages: written by tasks, listed from their directories, read by byte range.

A package is one ZIP file whose members are *stored*, so a record lies in the package as it lies in
its member: ``archive/data.warc.gz`` (each record a gzip member of its own) and
``indexes/index.cdxj`` (a line per record with its place in the archive). The reader opens a package
by its end, reads the central directory (its ZIP64 form too), finds archive and index members,
and then reads records by range. Nothing is extracted or unpacked to disk.
"""

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import numbered, rows_of
from teamlines.llm.tokens import _file_system
from teamlines.session import materialized, scratch_path

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20  # payload after which a task begins another package
SPAN_BYTES = 4 << 20  # what one range read fetches at most, or one record

# Fixed values of the ZIP format: signatures and layouts of its records.
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
LONGEST_END = 22 + 0xFFFF
STORED = 0


class PackageError(ValueError):
    """The bytes are no readable package."""


# -- ZIP directories --


def read_at(source, start, size):
    source.seek(start)
    data = source.read(size)
    if len(data) != size:
        raise PackageError("the package ends early")
    return data


def directory(source, size):
    """``name: (method, packed bytes, bytes, place of the local header)`` of each member."""
    tail_at = max(0, size - LONGEST_END)
    tail = read_at(source, tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise PackageError("no end of directory")
    count, length, start = struct.unpack_from("<H2L", tail, at + 10)
    end = tail_at + at
    if end >= 20 and (locator := read_at(source, end - 20, 20))[:4] == LOCATOR64:
        (end,) = struct.unpack_from("<Q", locator, 8)
        record = read_at(source, end, 56)
        if record[:4] != END64:
            raise PackageError("no ZIP64 end of directory")
        count, length, start = struct.unpack_from("<3Q", record, 32)
    entries, found, at = read_at(source, start, length), {}, 0
    for _ in range(count):
        if entries[at : at + 4] != ENTRY:
            raise PackageError("a directory entry is broken")
        (method,) = struct.unpack_from("<H", entries, at + 10)
        packed, unpacked, n_name, n_extra, n_note = struct.unpack_from("<2L3H", entries, at + 20)
        (header,) = struct.unpack_from("<L", entries, at + 42)
        name = entries[at + 46 : at + 46 + n_name].decode()
        extra = entries[at + 46 + n_name : at + 46 + n_name + n_extra]
        found[name] = (method, *_wide(extra, unpacked, packed, header))
        at += 46 + n_name + n_extra + n_note
    return found


def _wide(extra, unpacked, packed, header):
    """Sizes and place, from the ZIP64 field where the entry says so."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            unpacked = next(values) if unpacked == 0xFFFFFFFF else unpacked
            packed = next(values) if packed == 0xFFFFFFFF else packed
            header = next(values) if header == 0xFFFFFFFF else header
        at += 4 + length
    return packed, unpacked, header


def member_start(source, entry):
    """Where the bytes of a stored member begin."""
    method, _, _, header = entry
    if method != STORED:
        raise PackageError("the member is compressed, so its records have no place in the package")
    local = read_at(source, header, 30)
    if local[:4] != LOCAL:
        raise PackageError("no local header")
    return header + 30 + sum(struct.unpack_from("<2H", local, 26))


def listed(source, size):
    """``(member, offset, length, fields)`` of every record that the index members name, offsets from the package's start."""
    members = directory(source, size)
    for name in sorted(members):
        if not name.startswith("indexes/"):
            continue
        entry = members[name]
        for line in read_at(source, member_start(source, entry), entry[1]).splitlines():
            fields = json.loads(line.split(b" ", 2)[2])
            archive = members[fields["filename"]]
            begin = member_start(source, archive)
            if int(fields["offset"]) + int(fields["length"]) > archive[1]:
                raise PackageError("a record lies beyond its archive")
            yield fields["filename"], begin + int(fields["offset"]), int(fields["length"]), fields


# -- records --


def digest(payload: bytes):
    """SHA-1 in base32, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, row_id, url, payload: bytes, refers_to, refers_row):
    """One WARC record as a gzip member. A revisit keeps the HTTP head, with the length of what isn't repeated."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    again = refers_row is not None
    block = head if again else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if again else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}:{row_id}>",
        "WARC-Target-URI: " + " ".join((url or "").split()),
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if again:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}:{refers_row}>")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def parsed(data: bytes):
    """``(fields, http fields, payload)`` of one gzip member; the payload of a revisit is None."""
    whole = zlib.decompress(data, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), None if fields["WARC-Type"] == "revisit" else payload


def _fields(head):
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)


def _ids(uri):
    page, row = uri.removeprefix("<urn:page:").removesuffix(">").rsplit(":", 1)
    return (int(page) if page else None), int(row)


def package(records):
    """The bytes of a package with these ``(sort key, url, record)``."""
    archive, index = io.BytesIO(), []
    for key, data in records:
        fields = {"filename": ARCHIVE, "offset": str(archive.tell()), "length": str(len(data))}
        index.append(f"{key} - {json.dumps(fields)}\n")
        archive.write(data)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as members:
        members.writestr(ARCHIVE, archive.getvalue())
        members.writestr(INDEX, "".join(index))
    return out.getvalue()


# -- Spark --


def write_packages(pages: DataFrame, folder=None, least=0, limit=PACKAGE_BYTES, page_id="page_id", url="url", html="html"):
    """A record per row of ``pages`` in packages of about ``limit`` bytes. Returns the written table ``file, bytes``.

    Of equal payloads of at least ``least`` bytes, the row with the smallest id (then the first of
    equal rows; rows without an id last) is a response and the others are revisits of it; null is the
    empty payload. Equality is by SHA-256. A package of a failed attempt has another name and isn't listed.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "packages")
    pages = numbered(pages)
    rows = rows_of(pages, page_id=F.col(page_id).cast("long"), url=url, html=html)
    keyed = rows.select("row_id", "page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("same"), F.octet_length(F.coalesce("html", F.lit(""))).alias("n"))
    keyed = materialized(keyed.where(F.col("n") >= least).select("row_id", "page_id", "same"))
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"), F.col("row_id").alias("row"))
    first = materialized(keyed.groupBy("same").agg(F.min(order).alias("first")))
    again = keyed.join(first, "same").where("row_id <> first.row")
    again = again.select("row_id", F.col("first.id").alias("refers_to"), F.col("first.row").alias("refers_row"))
    marked = rows.join(again, "row_id", "left").select("row_id", "page_id", "url", "html", "refers_to", "refers_row")

    def write(batches):
        held, size = [], 0
        for batch in batches:
            for row_id, page, link, text, refers_to, refers_row in zip(*(c.to_pylist() for c in batch.columns)):
                data = record(page, row_id, link, (text or "").encode(), refers_to, refers_row)
                held.append((row_id, data))
                size += len(data)
                if size >= limit:
                    yield _put(folder, held)
                    held, size = [], 0
        if held:
            yield _put(folder, held)

    return materialized(marked.mapInArrow(write, "file string, bytes long"))


def _put(folder, held):
    name = f"{folder}/{uuid.uuid4().hex}.wacz"
    system, place = _file_system(name)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    data = package(held)
    with system.open_output_stream(place) as out:
        out.write(data)
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(data)], pa.int64())], names=["file", "bytes"])


def list_records(files: DataFrame, span=SPAN_BYTES):
    """``file, member, begin, sizes``: runs of neighbouring records of packages ``file, bytes``, from directories and indexes alone."""

    def spans(batches):
        for batch in batches:
            for name, size in zip(batch.column("file").to_pylist(), batch.column("bytes").to_pylist()):
                system, place = _file_system(name)
                found = []
                with system.open_input_file(place) as source:
                    for member, at, length, _ in listed(source, size):
                        run = found[-1] if found else None
                        if run and run[0] == member and run[1] + run[3] == at and run[3] + length <= span:
                            run[2].append(length)
                            run[3] += length
                        else:
                            found.append([member, at, [length], length])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.list_(pa.int64()))],
                    names=["file", "member", "begin", "sizes"],
                )

    return files.select("file", "bytes").mapInArrow(spans, "file string, member string, begin long, sizes array<long>")


RECORDS = (
    "page_id long, record_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary, file string, member string, begin long, size long"
)


def read_records(files: DataFrame, span=SPAN_BYTES):
    """Every record of packages ``file, bytes``, read by range: one row each, the payload of a revisit null.

    The digest of a response's payload is checked against its header; a difference is an error.
    """
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = list_records(files, span).repartition(n, "file", "begin")

    def read(batches):
        for batch in batches:
            for name, member, begin, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = _file_system(name)
                with system.open_input_file(place) as source:
                    data = read_at(source, begin, sum(sizes))
                rows, at = [], 0
                for size in sizes:
                    fields, http, payload = parsed(data[at : at + size])
                    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if payload is not None and digest(payload) != told:
                        raise PackageError(f"{name} at {begin + at}: the payload isn't the one written")
                    page, row = _ids(fields["WARC-Record-ID"])
                    refers = _ids(fields["WARC-Refers-To"])[0] if payload is None else None
                    rows.append((page, row, fields["WARC-Target-URI"], fields["WARC-Type"], int(http["Content-Length"]), told, refers, payload, name, member, begin + at, size))
                    at += size
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES)

    return runs.mapInArrow(read, RECORDS)


NAMES = [x.split()[0] for x in RECORDS.split(", ")]
TYPES = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in RECORDS.split(", ")]
