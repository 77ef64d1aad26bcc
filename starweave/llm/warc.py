"""WARC archives as a PySpark data source, and archiving with revisit records.

``spark.read.format("warc")`` plans one partition per group of files.
Comparisons with string literals on the header columns (``record_type``,
``record_id``, ``target_uri``, ``payload_digest``, ``refers_to``) are pushed
down: a record's headers are parsed first, and the block of a record that
they reject is skipped without decoding. So is the payload of every record if
the schema asked for has no ``payload`` column.

Archives are written with one gzip member per record. Each member carries its
compressed length in the extra field ``sl`` that the WARC standard describes,
so a reader inflates the first bytes and seeks to the next member. Members
without that field, and plain ``.warc`` files, are read too.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from starweave.llm.common import stored

#: Columns held by the headers, and their names there.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_bytes long, payload binary"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes inflated to see a record's headers, and read from a file at a time.
PEEK, READ = 4_096, 1 << 20
#: A writer starts a new file beyond this; a read partition takes files up to this.
FILE_BYTES = 64 << 20


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path or URI (local, HDFS, S3, GCS ...)."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record(row: dict) -> bytes:
    """A WARC/1.1 record: the HTTP head, and for a response the payload."""
    payload = row["payload"] or b""
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if row["record_type"] == "revisit" else head + payload
    lines = ["WARC/1.1"]
    for column, name in HEADERS.items():
        value = row[column]
        if value is not None:
            lines.append(f"{name}: {'sha1:' if column == 'payload_digest' else ''}{clean(value)}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as one gzip member that states its own length in an ``sl`` extra field."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse(head: bytes) -> dict[str, str]:
    """Header lines of a record, names in lower case."""
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, sep, value = line.partition(":")
        if sep:
            found[name.strip().lower()] = value.strip()
    return found


class Plain:
    """The bytes of a plain file, with seeking to skip."""

    def __init__(self, file):
        self.file, self.held = file, b""

    def more(self) -> bool:
        data = self.file.read(READ)
        self.held += data
        return bool(data)

    def until(self, end: bytes) -> bytes | None:
        at = 0
        while (found := self.held.find(end, at)) < 0:
            at = max(0, len(self.held) - len(end))
            if not self.more():
                return None
        out, self.held = self.held[: found + len(end)], self.held[found + len(end) :]
        return out

    def take(self, size: int) -> bytes:
        parts, need = [self.held[:size]], size - len(self.held)
        self.held = self.held[size:]
        while need > 0 and (data := self.file.read(max(need, READ))):
            parts.append(data[:need])
            self.held = data[need:]
            need -= len(data)
        return b"".join(parts)

    def skip(self, size: int) -> None:
        if size <= len(self.held):
            self.held = self.held[size:]
        else:
            self.file.seek(self.file.tell() + size - len(self.held))
            self.held = b""

    def ended(self) -> bool:
        return not self.held and not self.more()

    def pass_over(self, size: int) -> None:
        """Leave the record, of whose block ``size`` bytes are unread."""
        self.skip(size)


class Members(Plain):
    """The inflated bytes of a file of gzip members, one record each; skips whole members by ``sl``."""

    def __init__(self, file):
        super().__init__(file)
        self.raw, self.inflate, self.next_at = b"", None, None

    def _open(self) -> bool:
        start = self.file.tell() - len(self.raw)
        while len(self.raw) < 24:
            data = self.file.read(READ)
            if not data:
                break
            self.raw += data
        if len(self.raw) < 18:
            return False
        self.next_at = None
        if self.raw[3] & 4 and self.raw[12:14] == b"sl":
            self.next_at = start + struct.unpack("<I", self.raw[16:20])[0]
        self.inflate = zlib.decompressobj(31)
        return True

    def more(self) -> bool:
        while True:
            if self.inflate is None and not self._open():
                return False
            if not self.raw:
                self.raw = self.file.read(READ)
                if not self.raw:
                    return False
            out = self.inflate.decompress(self.raw, PEEK if len(self.held) < PEEK else READ)
            self.raw = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, None
            if out:
                self.held += out
                return True

    def take(self, size: int) -> bytes:
        while len(self.held) < size and self.more():
            pass
        out, self.held = self.held[:size], self.held[size:]
        return out

    def skip(self, size: int) -> None:
        while size:
            if not self.held and not self.more():
                return
            part = min(size, len(self.held))
            self.held, size = self.held[part:], size - part

    def pass_over(self, size: int) -> None:
        if self.next_at is None:
            return self.skip(size)
        # go to the next member without inflating the rest of this one
        if self.inflate is not None:
            self.file.seek(self.next_at)
            self.raw, self.inflate = b"", None
        self.held = b""


def read_records(file, zipped: bool, wanted, with_payload: bool) -> Iterator[dict]:
    """Records whose headers ``wanted`` accepts."""
    data = Members(file) if zipped else Plain(file)
    while not data.ended():
        head = data.until(b"\r\n\r\n")
        if head is None:
            return
        head = head.lstrip(b"\r\n")  # the two line ends that close the record before
        if not head:
            continue
        found = parse(head)
        row = {c: found.get(name.lower()) for c, name in HEADERS.items()}
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
        size = int(found.get("content-length", 0))
        if not wanted(row):
            data.pass_over(size)
            continue
        row["payload_bytes"] = row["payload"] = None
        left, http = size, "application/http" in found.get("content-type", "")
        if http:
            block = data.until(b"\r\n\r\n") or b""
            left -= len(block)
            stated = parse(block).get("content-length", "")
            row["payload_bytes"] = int(stated) if stated.isdigit() else left
        else:
            row["payload_bytes"] = left
        if with_payload and row["record_type"] != "revisit":
            row["payload"] = data.take(left)
        else:
            data.pass_over(left)
        yield row


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


#: How the writer's files begin, and its lists of committed ones.
PART, COMMITTED = "part-", "_committed-"


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, partition_bytes: int):
        self.columns, self.path, self.bytes = schema, path, partition_bytes
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In, IsNotNull, IsNull, StringStartsWith)):
                self.tests.append(f)
            else:
                yield f  # Spark applies it

    def wanted(self, row: dict) -> bool:
        for f in self.tests:
            value = row[f.attribute[0]]
            ok = (
                value is not None if isinstance(f, IsNotNull)
                else value is None if isinstance(f, IsNull)
                else value is not None and value.startswith(f.value) if isinstance(f, StringStartsWith)
                else value is not None and value in f.value if isinstance(f, In)
                else value is not None and value == f.value
            )
            if not ok:
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        store, top = filesystem(self.path)
        info = store.get_file_info(top)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(top, recursive=True))
        files = [f for f in found if f.is_file and not any(p.startswith(("_", ".")) for p in PurePosixPath(f.path).relative_to(top).parts)]
        if not info.is_file:
            listed: set[str] = set()
            for f in found:
                if PurePosixPath(f.path).name.startswith(COMMITTED):
                    with store.open_input_stream(f.path, compression=None) as lines:
                        folder = PurePosixPath(f.path).parent
                        listed.update(f"{folder}/{n}" for n in lines.read().decode().split())
            files = [f for f in files if not PurePosixPath(f.path).name.startswith(PART) or f.path in listed]
        groups, held = [[]], 0
        for f in sorted(files, key=lambda f: f.path):
            if held and held + f.size > self.bytes:
                groups.append([])
                held = 0
            groups[-1].append(f.path)
            held += f.size
        return [Files(tuple(g)) for g in groups]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        names = self.columns.fieldNames()
        kinds = {f.name: {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()] for f in self.columns}
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                for row in read_records(file, path.endswith(".gz"), self.wanted, "payload" in names):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if len(rows) >= 2000 or held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in names], names=names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in names], names=names)


@dataclass
class Written(WriterCommitMessage):
    paths: tuple[str, ...]


class WarcWriter(DataSourceArrowWriter):
    """Tasks write files under names of their own; the commit lists those of the attempts that won.

    Nothing is moved (on object stores a move is a copy). A reader takes a file
    with such a name only if a list has it, so what lost attempts, failed or
    running jobs leave is not read. Files under other names always count.
    """

    def __init__(self, path: str, file_bytes: int):
        self.path, self.bytes = path, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, top = filesystem(self.path)
        store.create_dir(top, recursive=True)
        paths, out, held = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or held >= self.bytes:
                    if out is not None:
                        out.close()
                    paths.append(f"{top}/{PART}{uuid.uuid4().hex}.warc.gz")
                    out, held = store.open_output_stream(paths[-1], compression=None), 0
                data = member(record(row))
                out.write(data)
                held += len(data)
        if out is not None:
            out.close()
        return Written(tuple(paths))

    def commit(self, messages: list) -> None:
        store, top = filesystem(self.path)
        store.create_dir(top, recursive=True)
        names = [PurePosixPath(path).name for message in messages if message for path in message.paths]
        # under a name that readers don't look for until it is whole
        name = uuid.uuid4().hex
        with store.open_output_stream(f"{top}/_open-{name}", compression=None) as out:
            out.write("".join(f"{n}\n" for n in names).encode())
        store.move(f"{top}/_open-{name}", f"{top}/{COMMITTED}{name}")

    def abort(self, messages: list) -> None:
        store, top = filesystem(self.path)
        for message in messages:
            for path in message.paths if message else ():
                if store.get_file_info(path).is_file:
                    store.delete_file(path)


class WarcSource(DataSource):
    """``format("warc")``: options ``path``, ``partitionBytes`` (read), ``fileBytes`` (write)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options["path"], int(self.options.get("partitionBytes", FILE_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("fileBytes", FILE_BYTES)))


def base32(hex40: Column) -> Column:
    """Base32 of a SHA-1 in hexadecimal: five hexadecimal digits are four characters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for at in range(1, 41, 5):
        bits = F.conv(F.substring(hex40, at, 5), 16, 10).cast("int")
        out += [F.substr(letters, F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """WARC records of ``pages``, one per row, with later copies of a payload standing for earlier ones.

    Of rows with equal payloads of at least ``least`` bytes the one with the
    largest id is a response, the others revisit it. Null html is the empty
    payload. Rows that tie for the largest id are all responses; a null id is
    smaller than any other, and where all are null all are responses. A very
    long payload is one record, held whole by its task. Other columns are not
    read, whatever they are called; an empty table gives no records.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    large = F.length("payload") >= least
    last = stored(rows.where(large).groupBy("sha1").agg(F.max("page_id").alias("last")), "warc-last")
    rows = rows.join(last, "sha1", "left")
    again = F.coalesce(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.lit(False))
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        named("page_id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        base32(F.col("sha1")).alias("payload_digest"),
        F.when(again, named("last")).alias("refers_to"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def archive(pages: DataFrame, path: str, **columns) -> None:
    """Write the records of ``pages`` (see ``records`` for nulls, ties and repeats) as WARC files under ``path``.

    An empty table writes no archive, and reading ``path`` gives no records.
    Files of earlier jobs stay; a job that fails adds nothing.
    """
    pages.sparkSession.dataSource.register(WarcSource)
    records(pages, **columns).write.format("warc").mode("append").save(path)


def read(spark, path: str, payload: bool = True) -> DataFrame:
    """The records under ``path``; without ``payload`` no payload is decoded."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    schema = SCHEMA if payload else SCHEMA.removesuffix(", payload binary")
    return spark.read.format("warc").schema(schema).load(path)
