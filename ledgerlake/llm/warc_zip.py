"""Web archives packed in ZIP files: writing WARC records, and reading them by byte range.

A package is a ZIP file with two stored (not compressed) members: the WARC
records and an index of their places. A reader takes the central directory from
the file's end (ZIP64 fields included), finds the index and the archive member,
and reads each record by its byte range; nothing is extracted.

Packages are written by the tasks, into the shared folder, in parts of at most
``PACKAGE_BYTES``. A task that runs again writes files under new names; only
those that the manifest of the finished write names are ever read.

Defined results: null html is an empty payload, a null url becomes about:blank;
of equal payloads of at least ``min_bytes`` bytes the row with the smallest id
is a response and the others are revisits of it; rows that repeat that id are
responses too; a null id comes after all others; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import in_tasks, small_slices, staged, text_or_empty
from ledgerlake.session import scratch_path

PACKAGE_BYTES = 256 << 20
CHUNK_BYTES = 8 << 20
ARCHIVE, INDEX = "archive/data.warc", "indexes/index.jsonl"
WARC_DATE = "1970-01-01T00:00:00Z"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


# --- ZIP ---


class PackageWriter:
    """Writes stored members one after another to a sink that cannot seek; always with ZIP64 fields."""

    def __init__(self, sink):
        self.sink, self.at, self.members = sink, 0, []

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        # Flags: sizes follow the data, names are UTF-8.
        self._put(struct.pack("<4s5H3L2H", b"PK\3\4", 45, 0x808, 0, 0, 0x21, 0, FULL32, FULL32, len(self.name), len(extra)))
        self._put(self.name + extra)

    def write(self, data: bytes) -> int:
        """Append to the open member; returns where in the member the data begins."""
        place = self.size
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._put(data)
        return place

    def end(self) -> None:
        self._put(struct.pack("<4sLQQ", b"PK\7\10", self.crc, self.size, self.size))
        self.members.append((self.name, self.crc, self.size, self.start))

    def close(self) -> None:
        begin = self.at
        for name, crc, size, start in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start)
            head = struct.pack(
                "<4s6H3L5H2L", b"PK\1\2", 45, 45, 0x808, 0, 0, 0x21, crc, FULL32, FULL32, len(name), len(extra), 0, 0, 0, 0, FULL32
            )
            self._put(head + name + extra)
        length, n, end = self.at - begin, len(self.members), self.at
        self._put(struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, length, begin))
        self._put(struct.pack("<4sLQL", b"PK\6\7", 0, end, 1))
        self._put(struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, FULL16, FULL16, FULL32, FULL32, 0))
        self.sink.close()


def stored_members(source, size: int) -> dict[str, tuple[int, int]]:
    """Name to (place of the data, length) of all stored members of a ZIP file."""

    def read(start: int, length: int) -> bytes:
        source.seek(start)
        return source.read(length)

    tail_start = max(0, size - 22 - FULL16 - 20)
    tail = read(tail_start, size - tail_start)
    at = tail.rfind(b"PK\5\6")
    if at < 0:
        raise ValueError("no end of a central directory: not a ZIP file")
    n, length, begin = struct.unpack_from("<H2L", tail, at + 10)
    if FULL16 == n or FULL32 in (length, begin):
        if at < 20 or tail[at - 20 : at - 16] != b"PK\6\7":
            raise ValueError("ZIP64 locator missing")
        place = struct.unpack_from("<Q", tail, at - 12)[0]
        record = read(place, 56)
        if record[:4] != b"PK\6\6":
            raise ValueError("ZIP64 end of the central directory missing")
        n, length, begin = struct.unpack_from("<3Q", record, 32)
    directory, found, at = read(begin, length), {}, 0
    for _ in range(n):
        if directory[at : at + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        method, packed, full, name_len, extra_len, note_len, start = struct.unpack_from("<10xH8x2L3H8xL", directory, at)
        name = directory[at + 46 : at + 46 + name_len].decode("utf-8", "replace")
        extra = directory[at + 46 + name_len : at + 46 + name_len + extra_len]
        wide = _zip64_extra(extra)
        values = []
        for value in (full, packed, start):
            values.append(wide.pop(0) if value == FULL32 and wide else value)
        full, packed, start = values
        if method == 0 and packed == full:
            own_name, own_extra = struct.unpack("<2H", read(start + 26, 4))
            found[name] = (start + 30 + own_name + own_extra, full)
        at += 46 + name_len + extra_len + note_len
    return found


def _zip64_extra(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            return list(struct.unpack_from(f"<{min(length, 24) // 8}Q", extra, at + 4))
        at += 4 + length
    return []


# --- WARC ---


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    text = identifier.strip("<>").removeprefix("urn:x-page:")
    return int(text) if text else None


def clean_uri(uri: str | None) -> str:
    """No white space or control characters in a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri) if uri else "about:blank"


def warc_record(page_id: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {clean_uri(uri)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers_to)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}, rest


def parse_record(record: bytes) -> dict:
    """Fields of one WARC record; the digest of a response is taken from its payload anew."""
    head, rest = _headers(record)
    http, payload = _headers(rest[: int(head["content-length"])])
    revisit = head["warc-type"] == "revisit"
    named = head["warc-payload-digest"].removeprefix("sha1:")
    digest = named if revisit else base32_digest(payload)
    if digest != named:
        raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
    return {
        "page_id": page_of(head["warc-record-id"]),
        "url": head["warc-target-uri"],
        "payload_bytes": int(http["content-length"]),
        "payload_digest": digest,
        "record_type": head["warc-type"],
        "refers_to": page_of(head["warc-refers-to"]) if revisit else None,
        "payload": None if revisit else payload,
    }


# --- Spark ---


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, revisit and refers_to of every page."""
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text_or_empty("html").cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    repeated = (
        keyed.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first_id")
    )
    joined = keyed.join(staged(repeated, "repeated-payloads"), "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("first_id")).alias("refers_to")
    )


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write planned records to packages in ``folder``; returns the manifest (path, bytes, records), staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        package, index, path = None, [], ""

        def finish() -> pa.RecordBatch:
            package.end()
            package.begin(INDEX)
            package.write("".join(index).encode())
            package.end()
            package.close()
            row = [pa.array([path]), pa.array([package.at]), pa.array([len(index)])]
            return pa.RecordBatch.from_arrays(row, ["path", "bytes", "records"])

        for part in small_slices(batches, rows=256):
            for row in part.to_pylist():
                if package is None:
                    path, index = f"{base}/{uuid.uuid4().hex}.zip", []
                    package = PackageWriter(store.open_output_stream(path))
                    package.begin(ARCHIVE)
                payload = row["payload"]
                record = warc_record(
                    row["page_id"], row["url"], payload, base32_digest(payload), row["refers_to"], row["revisit"]
                )
                place = package.write(record)
                index.append(json.dumps({"page": row["page_id"], "offset": place, "length": len(record)}) + "\n")
                if package.at >= package_bytes:
                    yield finish()
                    package = None
        if package is not None:
            yield finish()

    return staged(in_tasks(records, run, "path string, bytes long, records long"), "package-manifest")


def list_records(manifest: DataFrame, folder: str) -> DataFrame:
    """(path, offset, length) of every record, from the packages' directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(path) as source:
                    members = stored_members(source, size)
                    begin, _ = members[ARCHIVE]
                    source.seek(members[INDEX][0])
                    lines = source.read(members[INDEX][1]).splitlines()
                for start in range(0, len(lines), 10_000):
                    entries = [json.loads(line) for line in lines[start : start + 10_000]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * len(entries)),
                            pa.array([begin + e["offset"] for e in entries]),
                            pa.array([e["length"] for e in entries]),
                        ],
                        ["path", "offset", "length"],
                    )

    # A list of files is a small table; without this one task would open them all.
    spread = manifest.select("path", "bytes").repartition(_parts(manifest, 4), "path")
    return in_tasks(spread, run, "path string, offset long, length long")


def _parts(manifest: DataFrame, chunks: int) -> int:
    total = manifest.agg(F.sum("bytes").alias("bytes")).first().bytes or 0
    return max(1, -(-total // (chunks * CHUNK_BYTES)))


def read_records(entries: DataFrame, manifest: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Range-read and parse records; neighbours in a file are read by one task, in order."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        source, opened = None, None
        for part in small_slices(batches, rows=256):
            found = []
            for path, offset, length in zip(*(part.column(k).to_pylist() for k in range(3))):
                if path != opened:
                    if source is not None:
                        source.close()
                    source, opened = store.open_input_file(path), path
                source.seek(offset)
                found.append(parse_record(source.read(length)))
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k in zip(names, kinds)], names)
        if source is not None:
            source.close()

    chunk = F.expr(f"offset div {CHUNK_BYTES}")
    spread = entries.repartition(_parts(manifest, 1), "path", chunk).sortWithinPartitions("path", "offset")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return in_tasks(spread, run, schema + ", payload binary" * payload)


def round_trip(pages: DataFrame, min_bytes: int = 0, payload: bool = True) -> DataFrame:
    """Write every page to packages in the shared folder and read all records back."""
    folder = scratch_path(pages.sparkSession, "packages")
    manifest = write_packages(plan_records(pages, min_bytes), folder)
    return read_records(list_records(manifest, folder), manifest, folder, payload)
