"""Web archives in ZIP packages: written by Spark tasks and read back record by record, without unpacking.

A package holds a WARC file of separately compressed records and an index of their places, both stored, not deflated,
in the ZIP file. A reader finds the central directory from the end of the file (by way of the ZIP64 directory where
there is one), the two members from the directory, and the records from the index; it reads no bytes besides. Packages
are read in two steps: one row for each record from the indexes, dealt out by stretches of the files, then the records.

Pages with equal payloads are written once, as the response with the smallest id; the others are revisits that refer to
it. Files lie in the shared folder and have a name of their own for every attempt of a task; the list of those that
count is written as a table, so a repeated task leaves at most an unused file behind. Files are reached through
pyarrow's file systems, by the URI of the folder.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import scratch_dir, settle

#: A package is closed when its records reach this size; stretches of this size are read by one task.
PACKAGE_BYTES = 256 << 20
#: Bytes that are read one after the other, and bytes that a task reads.
STRETCH_BYTES, TASK_BYTES = 4 << 20, 64 << 20
BATCH_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"

# Fixed signatures and values of the ZIP and WARC formats.
END, END64_PLACE, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
ALL16, ALL32 = 0xFFFF, 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
ID, NO_ID = "urn:x-page:", "urn:x-no-page:"


# ---- packages -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    """A member of a ZIP file: its name, method (0: stored), sizes and the place of its local header."""

    name: str
    method: int
    packed: int
    size: int
    header: int


def filesystem(uri: str):
    """The file system of a URI or an absolute path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _wide(extra: bytes, fields: list[int]) -> list[int]:
    """The fields of a directory entry, with those that do not fit in 32 bits from its ZIP64 part."""
    at = 0
    while at + 4 <= len(extra):
        tag, length = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            place = at + 4
            for i, value in enumerate(fields):
                if value == ALL32:
                    (fields[i],) = struct.unpack_from("<Q", extra, place)
                    place += 8
        at += 4 + length
    return fields


def members(file, size: int) -> list[Member]:
    """The central directory of a ZIP file, from its last bytes; `file` has read_at(length, offset)."""
    tail_at = max(0, size - (22 + ALL16 + 20))
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(END)
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(END, 0, end)  # the signature may also stand in the comment
    if end < 0:
        raise ValueError("not a ZIP file: it has no end record")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if ALL16 == count or ALL32 in (length, start):
        if end < 20 or tail[end - 20 : end - 16] != END64_PLACE:
            raise ValueError("the ZIP64 end record is missing")
        (place,) = struct.unpack_from("<Q", tail, end - 12)
        record = file.read_at(56, place)
        if record[:4] != END64:
            raise ValueError("the ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, out = file.read_at(length, start), 0, []
    for _ in range(count):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, name, extra, comment = struct.unpack_from("<IIHHH", directory, at + 20)
        (header,) = struct.unpack_from("<I", directory, at + 42)
        names = directory[at + 46 : at + 46 + name]
        rest = directory[at + 46 + name : at + 46 + name + extra]
        plain, packed, header = _wide(rest, [plain, packed, header])
        out.append(Member(names.decode("utf-8" if flags & 0x800 else "cp437"), method, packed, plain, header))
        at += 46 + name + extra + comment
    return out


def data_start(file, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    head = file.read_at(30, member.header)
    if head[:4] != LOCAL:
        raise ValueError(f"{member.name} has no local header")
    name, extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + name + extra


def index_entries(file, size: int) -> Iterator[tuple[int, int]]:
    """(offset in the ZIP file, length) of every record that the indexes list."""
    found = {m.name: m for m in members(file, size)}
    for name, member in found.items():
        if name.endswith(".cdxj"):
            lines = file.read_at(member.size, data_start(file, member)).decode("utf-8").splitlines()
            starts: dict[str, int] = {}
            for line in lines:
                entry = json.loads(line[line.index("{") :])
                data = entry["filename"]
                if data not in starts:
                    starts[data] = data_start(file, found[data])
                yield starts[data] + int(entry["offset"]), int(entry["length"])


# ---- records ------------------------------------------------------------------------------------------------------


def digest_of(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


#: What cannot stand in a header, an identifier in angle brackets or a line of an index.
UNSAFE = re.compile("[%\x00-\x20<>{}\x7f-\x9f\u2028\u2029]")
ESCAPED = re.compile("(?:%[0-9A-F]{2})+")


def _clean(value: str) -> str:
    """A text with unsafe characters as the bytes of their UTF-8 after percent signs."""
    return UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value)


def _plain(value: str) -> str:
    return ESCAPED.sub(lambda m: bytes.fromhex(m[0].replace("%", "")).decode(), value)


def _name(page: str | None) -> str:
    """A record's identifier; no page is not the page without a name."""
    return f"<{NO_ID}>" if page is None else f"<{ID}{_clean(page)}>"


def _page(name: str | None) -> str | None:
    inner = (name or "")[1:-1]
    return _plain(inner.removeprefix(ID)) if inner.startswith(ID) else None


def record(page: str | None, url: str | None, payload: bytes, refers: str | None, is_revisit: bool) -> bytes:
    """A compressed WARC record: a response with its payload, or a revisit without it."""
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if is_revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_name(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if is_revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    body = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(body) + packer.flush()


def _headers(data: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = data.decode("utf-8", "surrogatepass").split("\r\n")
    pairs = (line.split(":", 1) for line in rest if ":" in line)
    return first, {k.strip().lower(): v.strip(" \t") for k, v in pairs}


@dataclass(frozen=True)
class Record:
    page: str | None
    url: str | None
    kind: str
    payload: bytes | None
    payload_bytes: int
    digest: str
    refers: str | None


def parse(packed: bytes) -> Record:
    """A record from its compressed bytes; the digest of a response is checked against its payload."""
    data = zlib.decompress(packed, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, fields = _headers(head)
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    is_revisit = fields["warc-type"] == "revisit"
    if not is_revisit and digest_of(payload) != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    size = int(_headers(http)[1]["content-length"])
    url = fields.get("warc-target-uri")
    return Record(
        _page(fields["warc-record-id"]),
        None if url is None else _plain(url),
        fields["warc-type"],
        None if is_revisit else payload,
        size,
        digest,
        _page(fields.get("warc-refers-to")),
    )


# ---- Spark --------------------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, body: str = "html", key: str = "page_id", url: str = "url", least: int = 0) -> DataFrame:
    """(page, url, payload, refers, revisit) of every page; ids as text, null payloads empty.

    Of equal payloads of at least `least` bytes the smallest id is the response, and rows with that id too; null ids
    come last, and pages without any id in their group are all responses.
    """
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"))).alias("first")
    groups = rows.where(F.octet_length("payload") >= least).groupBy("sha1").agg(first, F.count("*").alias("n"))
    groups = settle(groups.where("n > 1").select(F.col("sha1").alias("same"), F.col("first.id").alias("first")))
    joined = rows.join(groups, F.col("sha1").eqNullSafe(F.col("same")), "left")
    revisit = F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(
        F.col("id").cast("string").alias("page"),
        "url",
        "payload",
        F.when(revisit, F.col("first").cast("string")).alias("refers"),
        revisit.alias("revisit"),
    )


def write_packages(rows: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Packages of the rows of `with_revisits`; the table of those that count: (path, bytes, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid
        import zipfile

        fs, home = filesystem(folder)
        fs.create_dir(home, recursive=True)

        def records():
            for b in batches:
                for i in range(b.num_rows):
                    page, url, payload, refers, revisit = (b.column(c)[i].as_py() for c in range(5))
                    yield page, url, record(page, url, payload, refers, revisit)

        source = records()
        item = next(source, None)
        while item is not None:
            path = f"{home}/{uuid.uuid4().hex}.zip"
            index, at = [], 0
            with fs.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(zipfile.ZipInfo(DATA_MEMBER), "w", force_zip64=True) as data:
                    while item is not None and at < package_bytes:
                        page, url, packed = item
                        data.write(packed)
                        entry = {"url": url, "filename": DATA_MEMBER, "offset": str(at), "length": str(len(packed))}
                        index.append(f"{_name(page)} {DATE} {json.dumps(entry)}\n")
                        at += len(packed)
                        item = next(source, None)
                package.writestr(zipfile.ZipInfo(INDEX_MEMBER), "".join(index).encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path], pa.string()),
                    pa.array([fs.get_file_info(path).size], pa.int64()),
                    pa.array([len(index)], pa.int64()),
                ],
                names=["path", "bytes", "records"],
            )

    return settle(rows.mapInArrow(write, "path string, bytes bigint, records bigint"))


def locate_records(packages: DataFrame, folder: str) -> DataFrame:
    """(path, offset, length) of every record, from the packages' directories and indexes."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for b in batches:
            for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with fs.open_input_file(path) as file:
                    places = list(index_entries(file, size))
                offsets, lengths = zip(*places, strict=True) if places else ((), ())
                for at in range(0, len(places), 100_000):
                    here = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * len(offsets[here]), pa.string()),
                            pa.array(offsets[here], pa.int64()),
                            pa.array(lengths[here], pa.int64()),
                        ],
                        names=["path", "offset", "length"],
                    )

    return packages.select("path", "bytes").mapInArrow(locate, "path string, offset bigint, length bigint")


def read_records(places: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records at the places: page, url, record_type, payload (null for revisits), payload_bytes, payload_digest,
    refers_to; ids as text."""
    names = ["page", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        rows, size, file, name = [], 0, None, None

        def batch():
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        try:
            for b in batches:
                for path, offset, length in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                    if path != name:
                        if file is not None:
                            file.close()
                        file, name = fs.open_input_file(path), path
                    r = parse(file.read_at(length, offset))
                    payload = r.payload if with_payload else None
                    rows.append((r.page, r.url, r.kind, payload, r.payload_bytes, r.digest, r.refers))
                    size += 200 + len(payload or b"")
                    if size > BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        finally:
            if file is not None:
                file.close()
        if rows:
            yield batch()

    places = settle(places)
    size = places.agg(F.sum("length")).first()[0] or 0
    spark = places.sparkSession
    # an explicit number: the rows are small, but what they stand for is not, and must not be merged into few tasks
    tasks = max(1, -(-size // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-size // STRETCH_BYTES)))
    stretch = (F.col("offset") / STRETCH_BYTES).cast("long")
    dealt = places.repartition(tasks, F.col("path"), stretch).sortWithinPartitions("path", "offset")
    schema = (
        "page string, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, "
        "refers_to string"
    )
    return dealt.mapInArrow(read, schema)


def archive(
    pages: DataFrame, body: str = "html", key: str = "page_id", url: str = "url", least: int = 0, with_payload: bool = True
) -> DataFrame:
    """Writes the pages to packages and reads them back: the columns of `read_records` with the key in its own type."""
    folder = scratch_dir(pages.sparkSession, "warc")
    packages = write_packages(with_revisits(pages, body, key, url, least), folder)
    out = read_records(locate_records(packages, folder), folder, with_payload)
    kind = pages.schema[key].dataType
    rest = [c for c in out.columns if c not in ("page", "refers_to")]
    return out.select(F.col("page").cast(kind).alias(key), *rest, F.col("refers_to").cast(kind).alias("refers_to"))
