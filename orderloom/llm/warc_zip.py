"""Web records in ZIP-packaged archives: writing them, and reading them in place.

An archive is a ZIP file of stored members: `archive/data.warc.gz`, in which each record is a gzip member by
itself, and `indexes/index.cdxj`, a line per record with its offset and length. The writer makes archives of
bounded size, a few per task; the names of those that a task finished travel back as rows, so what a
lost or repeated attempt left behind is never read.

The reader looks only at what it needs. From the end of a file it finds the end record, its ZIP64 form if there is
one, and the central directory; from that, the stored archive members and their indexes. The index
gives the ranges of records, which are dealt out over tasks and read by range; nothing is extracted, and
archives without an index are read from the start of the member on, record by record, as are members of plain records
(`.warc`). Files are opened through Arrow's file
systems, so the folder may be any that they and Spark know by the same address.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import picked, scratch, ship, small_enough, written

ARCHIVE_BYTES = 64 * 1024 * 1024
RANGE_BYTES = 2 * 1024 * 1024
ROWS_AT_ONCE = 256
BROADCAST_BYTES = 32 * 1024 * 1024
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
PAGE_URN, NO_PAGE_URN = "urn:page:", "urn:page-without-id"
# A file is read in blocks of so many bytes; a record is held as a whole.
BLOCK_BYTES = 64 * 1024
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records -----------------------------------------------------------------------------------


def _on_one_line(value: str) -> str:
    """An address as a header value: what may not stand in one is written as `%XX`."""
    return "".join(c if c.isprintable() and c != " " else quote(c, safe="") for c in value)


def page_urn(page_id: object) -> str:
    """The name of a page's record, from which its id is read back as it was."""
    if page_id is None:
        return NO_PAGE_URN
    return PAGE_URN + "".join(c if c.isprintable() and c not in " %<>{}" else quote(c, safe="") for c in str(page_id))


def page_of(urn: str) -> str | None:
    """The id in a record's name; none if it is not the name of a page with an id."""
    urn = urn.removeprefix("<").removesuffix(">")
    return unquote(urn.removeprefix(PAGE_URN)) if urn.startswith(PAGE_URN) else None


def record(page_id: object, url: str | None, payload: bytes, refers_to: object = None) -> bytes:
    """A response, or a revisit of another page's response, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    body = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{page_urn(page_id)}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", _on_one_line(url))] if url else []),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        *([("WARC-Refers-To", f"<{page_urn(refers_to)}>"), ("WARC-Profile", REVISIT_PROFILE)] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + body + b"\r\n\r\n") + packer.flush()


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes

    def page(self, header: str) -> str | None:
        return page_of(self.headers.get(header, ""))


def parsed(data: bytes) -> Record:
    """A record's headers, its HTTP headers and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = _fields(lines)
    body = rest[: int(headers["content-length"])]
    if not headers.get("content-type", "").startswith("application/http"):
        return Record(headers, {}, body)
    http, _, payload = body.partition(b"\r\n\r\n")
    return Record(headers, _fields(http.decode("latin-1").split("\r\n")[1:]), payload)


def _fields(lines: Iterable[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def plain_blocks(file, start: int, length: int) -> Iterator[bytes]:
    """A stretch of a file, block by block."""
    for at in range(start, start + length, BLOCK_BYTES):
        yield _read(file, at, min(BLOCK_BYTES, start + length - at))


def unpacked_blocks(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """The contents of successive gzip members, block by block."""
    unpacker = None
    for data in blocks:
        while data:
            unpacker = unpacker or zlib.decompressobj(31)
            yield unpacker.decompress(data)
            data = unpacker.unused_data
            if unpacker.eof:
                unpacker = None
    if unpacker is not None:
        raise ValueError("a record is cut short")


def split_records(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """Record by record, whatever blocks they come in: no more than a record and a block are held."""
    held, wanted = bytearray(), None
    for data in blocks:
        held += data
        while True:
            if wanted is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                fields = _fields(held[:end].decode().split("\r\n")[1:])
                wanted = end + 4 + int(fields["content-length"]) + 4
            if len(held) < wanted:
                break
            yield bytes(held[:wanted])
            del held[:wanted]
            wanted = None
    if held.strip():
        raise ValueError("a record is cut short")


# --- ZIP ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    start: int
    size: int


def _read(file, start: int, length: int) -> bytes:
    file.seek(start)
    data = file.read(length)
    if len(data) != length:
        raise ValueError("the archive is cut short")
    return data


def directory(file, size: int) -> list[Member]:
    """The members of a ZIP file, from its central directory; ZIP64 forms are followed where they are needed."""
    tail_at = max(0, size - 65_557)
    tail = _read(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    # The marker may also stand in the note after the record, whose length tells them apart.
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("not a ZIP archive")
    entries, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = _read(file, tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("the ZIP64 locator is missing")
        record64 = _read(file, struct.unpack_from("<Q", locator, 8)[0], 56)
        if record64[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is missing")
        entries, length, offset = struct.unpack_from("<QQQ", record64, 32)
    data, at, out = _read(file, offset, length), 0, []
    for _ in range(entries):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        method, packed, plain, n_name, n_extra, n_note, local = struct.unpack_from("<H8xIIHHH8xI", data, at + 10)
        name = data[at + 46 : at + 46 + n_name].decode()
        extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
        packed, local = _zip64(extra, plain, packed, local)
        header = _read(file, local, 30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header for {name}")
        skip = 30 + sum(struct.unpack_from("<HH", header, 26))
        out.append(Member(name, method, local + skip, packed))
        at += 46 + n_name + n_extra + n_note
    return out


def _zip64(extra: bytes, plain: int, packed: int, local: int) -> tuple[int, int]:
    """Packed size and local offset; the extra field holds, in this order, those that didn't fit."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = list(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if plain == 0xFFFFFFFF:
                values.pop(0)
            if packed == 0xFFFFFFFF:
                packed = values.pop(0)
            if local == 0xFFFFFFFF:
                local = values.pop(0)
        at += 4 + length
    return packed, local


def _index(file, member: Member) -> str:
    """The text of an index, stored or compressed."""
    data = _read(file, member.start, member.size)
    if member.method == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -15)
    elif member.method != zipfile.ZIP_STORED:
        raise ValueError(f"the index {member.name} is compressed by a method that is not known")
    return (gzip.decompress(data) if member.name.endswith(".gz") else data).decode()


def ranges(path: str) -> Iterator[tuple[str, int, int, bool]]:
    """path, start, length and packed (by gzip) of runs of records in a file, by its index; a member without one is a
    run, which its reader takes record by record."""
    system, place = fs.FileSystem.from_uri(path)
    size = system.get_file_info(place).size
    with system.open_input_file(place) as file:
        found = directory(file, size)
        archives = [m for m in found if m.name.startswith("archive/") and m.name.endswith((".warc.gz", ".warc"))]
        for m in archives:
            if m.method != 0:
                raise ValueError(f"{m.name} is compressed in {path}; archive members must be stored")
        spans: dict[str, list[tuple[int, int]]] = {}
        for m in found:
            if m.name.startswith("indexes/") and m.name.endswith((".cdxj", ".cdxj.gz")):
                for line in _index(file, m).split("\n"):
                    if not line or line.startswith("!"):  # a note about the index
                        continue
                    entry = json.loads(line.split(" ", 2)[2])
                    spans.setdefault(entry["filename"], []).append((int(entry["offset"]), int(entry["length"])))
    for m in archives:
        own = sorted(spans.get(m.name.removeprefix("archive/"), [(0, m.size)] if m.size else []))
        packed = m.name.endswith(".gz")
        start = stop = None
        for offset, length in own:
            if start is not None and offset == stop and offset + length - start <= RANGE_BYTES:
                stop = offset + length
                continue
            if start is not None:
                yield path, m.start + start, stop - start, packed
            start, stop = offset, offset + length
        if start is not None:
            yield path, m.start + start, stop - start, packed


# --- Spark -------------------------------------------------------------------------------------


class _Archive:
    """A ZIP file that is written in one go."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.zip"
        system, place = fs.FileSystem.from_uri(self.path)
        self.stream = system.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(WARC_MEMBER, "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, page_id, url, data: bytes) -> None:
        entry = {"url": url or "", "offset": str(self.size), "length": str(len(data)), "filename": "data.warc.gz"}
        self.lines.append(f"{page_urn(page_id)} {DATE} {json.dumps(entry)}\n")
        self.member.write(data)
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(INDEX_MEMBER, "".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.path, self.size, len(self.lines)


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, archive = [], None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*batch.columns, strict=True):
                archive = archive or _Archive(folder)
                key = page_id.as_py()
                content = (payload.as_py() or "").encode(errors="replace")
                archive.add(key, url.as_py(), record(key, url.as_py(), content, refers_to.as_py()))
                if archive.size >= archive_bytes:
                    made.append(archive.close())
                    archive = None
        if archive:
            made.append(archive.close())
        if made:
            yield pa.RecordBatch.from_pydict(dict(zip(("path", "bytes", "records"), map(list, zip(*made)), strict=True)))

    return write


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: the page whose payload a page repeats. Of equal payloads of `min_bytes` or more
    the one with the largest page_id is the original."""
    plain = picked(pages, page_id="page_id", url="url", html="html")
    long = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    keyed = plain.withColumn("key", F.when(long, F.unhex(F.sha2(F.coalesce("html", F.lit("")), 256))))
    repeated = written(
        keyed.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("key", "original"),
        "originals",
    )
    joined = keyed.join(small_enough(repeated, 64, BROADCAST_BYTES), "key", "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    return joined.select("page_id", "url", "html", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page and return the archives: path, bytes, records."""
    ship(pages.sparkSession)
    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(place, recursive=True)
    rows = with_originals(pages, min_bytes)
    made = rows.mapInArrow(_writer(folder, archive_bytes), "path string, bytes long, records long")
    return written(made, "archives")


def _planner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path"):
            found = list(ranges(path.as_py()))
            if found:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("path", "start", "length", "packed"), map(list, zip(*found)), strict=True))
                )


_COLUMNS = "record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string"


def _reader(with_payload: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = ("path", "start", "length", "packed")
            for path, start, length, packed in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    blocks = plain_blocks(file, start, length)
                    for content in split_records(unpacked_blocks(blocks) if packed else blocks):
                        yield row(parsed(content), f"{path} at {start}")

    def row(one: Record, place: str) -> dict:
        kind, digest = one.headers.get("warc-type"), one.headers.get("warc-payload-digest", "")
        size = len(one.payload)
        if kind == "response" and digest and digest != f"sha1:{base32_sha1(one.payload)}":
            raise ValueError(f"payload and digest differ in {place}")
        if kind == "revisit":
            size = int(one.http.get("content-length", size))
        return {
            "record_id": one.page("warc-record-id"),
            "record_type": kind,
            "url": one.headers.get("warc-target-uri"),
            "payload_bytes": size,
            "payload_digest": digest.removeprefix("sha1:") or None,
            "refers_to": one.page("warc-refers-to"),
            **({"payload": one.payload if kind == "response" else None} if with_payload else {}),
        }

    kinds = [("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64())]
    kinds += [("payload_digest", pa.string()), ("refers_to", pa.string())]
    schema = pa.schema(kinds + ([("payload", pa.binary())] if with_payload else []))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in rows(batches):
            held.append(row)
            if len(held) >= ROWS_AT_ONCE:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    return read


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives at `path`: record_id, record_type, url, payload_bytes, payload_digest,
    refers_to and, if asked for, payload. A response's payload is held against its digest.

    Payload figures of a revisit are those of the full payload, as far as it states them. `record_id` and `refers_to` are the
    ids of pages, as they were; records that are not named for a page with an id have none. An archive without records
    gives no rows.
    """
    ship(archives.sparkSession)
    runs = written(archives.select("path").mapInArrow(_planner, "path string, start long, length long, packed boolean"), "ranges")
    total = runs.agg(F.sum("length")).head()[0] or 0
    parts = max(1, min(runs.count(), total // (4 * RANGE_BYTES) + 1))
    dealt = runs.repartition(int(parts), "path", "start")
    return dealt.mapInArrow(_reader(with_payload), _COLUMNS + (", payload binary" if with_payload else ""))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page, as read back from archives that were written for it: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url.

    A null html is an empty payload; a null page_id has a record without a name, which is no original
    while there is another. Pages repeated with id and payload are all responses.
    """
    archives = write_archives(pages, scratch(spark, "warc"))
    id_type = picked(pages, page_id="page_id").schema["page_id"].dataType
    return read_archives(archives).select(
        F.col("record_id").cast(id_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
        "url",
    )
