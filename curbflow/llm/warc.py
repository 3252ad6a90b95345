"""WARC archives as a Spark source and sink: a gzip member for each record, read in byte ranges that need no index.

Writing: records of equal payloads are found by digest; one of them carries the payload, the others refer to it.
Reading: a task takes a byte range, looks for gzip magic, takes a candidate as a member if it inflates to the headers of a
record, and owns the records that start inside its range, however far they reach beyond it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

# Bytes of archive that one task reads, bytes after which a new file begins, and bytes of records in a batch.
SPLIT_BYTES, FILE_BYTES, BATCH_BYTES = 32 << 20, 1 << 30, 4 << 20
# Bytes fetched at once, bytes within which the headers of a record must end, and bytes of a member that show how its record begins.
PIECE, MOST_HEADER, HEAD = 1 << 20, 1 << 16, 1 << 12
MAGIC, END = b"\x1f\x8b\x08", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("date", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("digest_holds", pa.bool_()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)
RECORDS_SQL = (
    "file string, offset long, length long, record_type string, record_id string, target_uri string, date string, "
    "refers_to string, payload_digest string, digest_holds boolean, payload_bytes long, payload binary"
)


def write_warc(
    pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, date: str | None = None
) -> None:
    """Write a record for every row; files appear in the folder only once all tasks have ended.

    Of rows with equal payloads (SHA-1 and length) of at least `least_bytes` bytes, that with the largest key is a response
    and the others are revisits of it; rows that tie for the largest key, or whose group has NULL keys only, are all
    responses.  A NULL payload is an empty one, a NULL URL leaves its field out, and white space and control
    characters in a URL are percent-encoded.  Other columns are ignored; an empty table gives an empty folder.
    """
    pages.sparkSession.dataSource.register(WarcSource)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumns({"sha1": F.sha1("body"), "bytes": F.octet_length("body")})
    # Digests only: a payload is moved once, and only to find out whether its row is a copy.
    groups = rows.filter(F.col("bytes") >= least_bytes).groupBy("sha1", "bytes").agg(F.max("key").alias("first"), F.count(F.lit(1)).alias("rows"))
    copied = groups.filter((F.col("rows") > 1) & F.col("first").isNotNull()).drop("rows")
    joined = rows.join(copied, ["sha1", "bytes"], "left")
    revisits = F.when(F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    columns = joined.select("key", "url", "body", "sha1", revisits.alias("refers_to"))
    columns.write.format("warc").mode("append").option("date", date).save(path)


def read_warc(spark: SparkSession, path: str, *, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """All records of the `.warc.gz` files in a folder, or of one file.

    `payload_bytes` and `payload_digest` (bare base32 SHA-1) are computed from the payload; a revisit has them from its
    headers.  `digest_holds` tells whether the digest named in the headers is that of the payload (NULL without one).
    Damaged members are skipped up to the next record; without `payload` that column is NULL.

    A candidate found first in a range must be followed by another record or the end of the file: this tells
    a record from a copy of one that lies uncompressed inside a payload.  A whole archive that lies uncompressed inside a
    payload can still be taken for records of its own by a range that begins inside it.
    """
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("split_bytes", split_bytes).option("payload", payload).load(path)


def record_id(key: int | None, digest: str) -> str:
    """The URI of a page's record."""
    return f"<urn:x-page:{'' if key is None else key}:{digest}>"


def key_of(column: str) -> F.Column:
    """The key in such a URI; NULL if it has none."""
    return F.regexp_extract(column, r"^<urn:x-page:(-?\d+):", 1).try_cast("long")


class WarcSource(DataSource):
    """Options: path, split_bytes and payload to read, date to write."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORDS_SQL

    def reader(self, schema) -> DataSourceReader:
        with_payload = str(self.options.get("payload", "true")).lower() == "true"
        return WarcReader(self.options["path"], int(self.options.get("split_bytes", SPLIT_BYTES)), with_payload)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], self.options["date"])


# Writing


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Tasks write under a temporary folder; the files of the tasks that count are moved into place at the end."""

    def __init__(self, path: str, date: str):
        self.path, self.date, self.job = path, date, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = fs.FileSystem.from_uri(self.path)
        folder, part = f"{folder}/_temporary/{self.job}", TaskContext.get().partitionId()
        store.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                columns = [batch.column(name) for name in ("key", "url", "body", "sha1", "refers_to")]
                for k in range(batch.num_rows):
                    if out is None or size >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        files.append(f"part-{part:05}-{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                        size += out.write(member(warcinfo(files[-1], self.date)))
                    data = member(page_record(*[c[k].as_py() for c in columns], self.date))
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = fs.FileSystem.from_uri(self.path)
        store.create_dir(folder, recursive=True)
        for message in messages:
            for name in message.files if message else []:
                store.move(f"{folder}/_temporary/{self.job}/{name}", f"{folder}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = fs.FileSystem.from_uri(self.path)
        if store.get_file_info(f"{folder}/_temporary/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{folder}/_temporary/{self.job}")


_SPACE = re.compile(r"[\x00-\x20\x7f]")


def member(record: bytes) -> bytes:
    """The record as a gzip member of its own."""
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    named = [*((name, value) for name, value in fields if value is not None), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in named) + "\r\n"
    return b"".join((head.encode(), block, END))


def warcinfo(name: str, date: str) -> bytes:
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name)]
    return _record([*fields, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def page_record(key: int | None, url: str | None, body: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    """A response with the payload, or a revisit with the headers only; both name length and digest of the whole payload."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(key, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f\x85  ]", lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    return _record(fields, head if revisit else head + body)


# Reading


class Ranges(InputPartition):
    """Byte ranges (file, start, end) that one task reads."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        self.ranges = ranges


class WarcReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int, with_payload: bool):
        self.path, self.split_bytes, self.with_payload = path, split_bytes, with_payload

    def partitions(self) -> list[Ranges]:
        store, path = fs.FileSystem.from_uri(self.path)
        if store.get_file_info(path).type == fs.FileType.File:
            found = [store.get_file_info(path)]
        else:
            found = store.get_file_info(fs.FileSelector(path, recursive=False))
        files = sorted((x.path, x.size) for x in found if x.type == fs.FileType.File and x.path.endswith(".warc.gz"))
        parts, room = [], 0
        for name, size in files:
            for start in range(0, size, self.split_bytes):
                end = min(size, start + self.split_bytes)
                if room < end - start:
                    parts.append(Ranges([]))
                    room = self.split_bytes
                parts[-1].ranges.append((name, start, end))
                room -= end - start
        return parts or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        for name, start, end in partition.ranges:
            with store.open_input_file(name) as file:
                for offset, length, record in records(file, start, end):
                    row = described(record)
                    row |= {"file": name, "offset": offset, "length": length}
                    if not self.with_payload:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, RECORDS)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, RECORDS)


class _Source:
    """A file with one piece of it at hand."""

    def __init__(self, file):
        self.file, self.size, self.start, self.data = file, file.size(), 0, b""

    def load(self, place: int) -> None:
        self.file.seek(place)
        self.start, self.data = place, self.file.read(PIECE)

    def at(self, place: int) -> memoryview:
        """Bytes from the place on; none at the end of the file."""
        if not self.start <= place < self.start + len(self.data):
            self.load(place)
        return memoryview(self.data)[place - self.start :]

    def magic(self, place: int, end: int) -> int | None:
        """The next place before `end` that holds gzip magic."""
        while place < min(end, self.size):
            self.at(place)
            found = self.data.find(MAGIC, place - self.start)
            if found >= 0:
                return self.start + found if self.start + found < end else None
            last = self.start + len(self.data)
            if last >= self.size:
                return None
            place = last - len(MAGIC) + 1
            self.load(place)
        return None

    def starts(self, place: int) -> bool:
        """Whether a member that begins like a record starts here, or the file ends."""
        if place >= self.size:
            return True
        if place + HEAD > self.start + len(self.data):
            self.load(place)
        piece = bytes(self.at(place)[:HEAD])
        try:
            first = zlib.decompressobj(31).decompress(piece, 5)
            # A file may end within a member, here one whose gzip header has no optional fields.
            return first == b"WARC/" or (len(piece) < HEAD and piece[3:4] in (b"", b"\0") and b"WARC/".startswith(first))
        except zlib.error:
            return False


def records(file, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """Offset, compressed length and bytes of every record whose member starts in the range, in order."""
    source = _Source(file)
    place, known = start, start == 0
    while (found := source.magic(place, end)) is not None:
        known = known and found == place
        whole = _inflated(source, found)
        if whole is None or not (known or source.starts(whole[1])):
            place, known = found + 1, False
            continue
        yield found, whole[1] - found, whole[0]
        place, known = whole[1], True


def _inflated(source: _Source, place: int) -> tuple[bytes, int] | None:
    """The record of the member at the place, and where the member ends; None if there is none or it is damaged."""
    unpacker, parts, size, limit, step = zlib.decompressobj(31), [], 0, None, 1 << 13
    try:
        while not unpacker.eof:
            piece = bytes(source.at(place)[:step])
            if not piece:
                return None
            place, step = place + len(piece), min(2 * step, PIECE)
            while piece and not unpacker.eof:
                parts.append(unpacker.decompress(piece, PIECE))
                size, piece = size + len(parts[-1]), unpacker.unconsumed_tail
                if limit is None:
                    head = b"".join(parts)
                    if not b"WARC/".startswith(head[:5]):
                        return None
                    if (k := head.find(END)) >= 0:
                        limit = k + len(END) + _content_length(head[: k + 2]) + len(END)
                    elif size > MOST_HEADER:
                        return None
                if limit is not None and size > limit:
                    return None
    except (zlib.error, ValueError):
        return None
    record = b"".join(parts)
    return (record, place - len(unpacker.unused_data)) if size == limit and record.endswith(END) else None


def _content_length(head: bytes) -> int:
    found = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d{1,15})[ \t]*\r\n", head)
    if not found:
        raise ValueError("no Content-Length")
    return int(found[1])


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip(" \t") for name, _, value in pairs}


def described(record: bytes) -> dict:
    """The columns of a record."""
    head, _, rest = record.partition(END)
    block, fields = rest[: -len(END)], _fields(head)
    kind, payload = fields.get("warc-type"), block
    named = (fields.get("warc-payload-digest") or "").rpartition(":")[2] or None
    if "application/http" in fields.get("content-type", ""):
        http, _, payload = block.partition(END)
    if kind == "revisit":
        length = _fields(http).get("content-length", "") if "application/http" in fields.get("content-type", "") else ""
        digest, payload, holds = named, None, None
        size = int(length) if length.isdigit() else None
    else:
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        holds = None if named is None else named.upper() == digest
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": digest,
        "digest_holds": holds,
        "payload_bytes": size,
        "payload": payload,
    }
