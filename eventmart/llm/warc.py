"""Web archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Archives are ``.warc.gz`` files with one gzip member per record. Each member's header carries the
member's length in an extra field named ``sl``, so a record can be passed over without inflating
it. Reading plans one partition per group of files; conditions on record type, page and address
go into the reader, which inflates a member only until its record headers are complete, decides,
and decodes the payload only of records that are wanted. Foreign archives without the extra
field work too; their unwanted members are inflated and thrown away.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
    IsNotNull, StringStartsWith, WriterCommitMessage)

from eventmart.llm.common import pick
from eventmart.llm.store import Folder

SUFFIX = ".warc.gz"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A revisit needs at least so many bytes of payload.
LEAST_REVISIT_BYTES = 100
#: Archives are closed beyond this size; a reading task gets files of about this size together.
FILE_BYTES = 64 << 20
HEAD_BYTES = 4096
BATCH_BYTES = 4 << 20

#: The columns of a record, written and read.
COLUMNS = ("record_type string, page_id long, url string, refers_to long, date string, "
           "payload_digest string, payload_bytes long, payload binary")
ARROW = pa.schema([
    ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("refers_to", pa.int64()), ("date", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("payload", pa.binary())])
PUSHED = ("record_type", "page_id", "url", "refers_to", "payload_digest")


def one_line(value: str) -> str:
    """Line ends would end a header; they become their percent codes."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def encode(kind: str, page_id: int | None, url: str | None, refers_to: int | None,
           date: str | None, digest: str, n_bytes: int, payload: bytes) -> bytes:
    """A record's bytes. A revisit holds the response's headers, whose length is the full payload's."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {n_bytes}\r\n\r\n").encode()
    if kind != "revisit":
        block += payload
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    lines += [f"WARC-Date: {date or '1970-01-01T00:00:00Z'}",
              f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    """One gzip member whose extra field ``sl`` holds its length and the record's."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(record) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", len(extra)) + extra
            + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


class Members:
    """The records of one archive: headers first, the rest on demand."""

    def __init__(self, file: BinaryIO) -> None:
        self.file, self.held, self.at = file, b"", 0

    def _fill(self, n: int) -> bool:
        while len(self.held) < n:
            more = self.file.read(max(1 << 20, n - len(self.held)))
            if not more:
                return False
            self.held += more
        return True

    def records(self, wanted: Callable[[dict[str, str]], bool]) -> Iterator[tuple[dict[str, str], bytes]]:
        """Headers and block of each wanted record."""
        while self._fill(24) or self.held:
            known = self.held[2:4] == b"\x08\x04" and self.held[12:14] == b"sl"
            size = struct.unpack("<I", self.held[16:20])[0] if known else 0
            if known:
                self._fill(size)
            inflate = zlib.decompressobj(31)
            head, rest = b"", self.held[:size] if known else self.held
            while b"\r\n\r\n" not in head and not inflate.eof:
                if not rest and (known or not self._more()):
                    break
                rest = rest or self._taken
                head += inflate.decompress(rest, HEAD_BYTES)
                rest = inflate.unconsumed_tail
            fields = headers_of(head.partition(b"\r\n\r\n")[0])
            take = wanted(fields)
            parts = [head]
            if take or not known:
                while not inflate.eof:
                    if not rest:
                        if known or not self._more():
                            raise EOFError("an archive ends inside a record")
                        rest = self._taken
                    out = inflate.decompress(rest, 1 << 20)
                    rest = inflate.unconsumed_tail
                    if take:
                        parts.append(out)
            self.held = self.held[size:] if known else inflate.unused_data
            if take:
                body = b"".join(parts).partition(b"\r\n\r\n")[2]
                yield fields, body[:int(fields.get("content-length", len(body)))]

    def _more(self) -> bool:
        """The next bytes of the file in ``_taken``, for members of unknown length."""
        self._taken = self.file.read(1 << 20)
        return bool(self._taken)


def decoded(fields: dict[str, str], block: bytes) -> tuple:
    """A record as a row of COLUMNS."""
    kind = fields.get("warc-type")
    head, _, payload = block.partition(b"\r\n\r\n")
    if not fields.get("content-type", "").startswith("application/http"):
        head, payload = b"", block
    told = headers_of(head).get("content-length", "")
    n_bytes = int(told) if kind == "revisit" and told.isdigit() else len(payload)
    digest = fields.get("warc-payload-digest")
    return (kind, page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"),
            page_of(fields.get("warc-refers-to")), fields.get("warc-date"),
            digest and digest.removeprefix("sha256:"), n_bytes,
            None if kind == "revisit" else payload)


def from_headers(fields: dict[str, str]) -> dict[str, Any]:
    digest = fields.get("warc-payload-digest")
    return {"record_type": fields.get("warc-type"), "page_id": page_of(fields.get("warc-record-id")),
            "url": fields.get("warc-target-uri"), "refers_to": page_of(fields.get("warc-refers-to")),
            "payload_digest": digest and digest.removeprefix("sha256:")}


def holds(test: Filter, values: dict[str, Any]) -> bool:
    value = values[test.attribute[0]]
    if isinstance(test, IsNotNull):
        return value is not None
    if value is None:
        return False
    if isinstance(test, EqualTo):
        return value == test.value
    if isinstance(test, In):
        return value in test.value
    return value.startswith(test.value)


@dataclass
class Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, file_bytes: int) -> None:
        self.path, self.file_bytes, self.tests = path, file_bytes, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for test in filters:
            if isinstance(test, (EqualTo, In, IsNotNull, StringStartsWith)) and (
                    len(test.attribute) == 1 and test.attribute[0] in PUSHED):
                self.tests.append(test)
            else:
                yield test

    def partitions(self) -> list[InputPartition]:
        groups, size = [[]], 0
        for name, n_bytes in Folder(self.path).files(SUFFIX):
            if groups[-1] and size + n_bytes > self.file_bytes:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += n_bytes
        return [Files(names) for names in groups]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows, size, folder = [], 0, Folder(self.path)
        for name in partition.names:
            with folder.read(name) as file:
                for fields, block in Members(file).records(
                        lambda f: all(holds(t, from_headers(f)) for t in self.tests)):
                    rows.append(decoded(fields, block))
                    size += len(block)
                    if size > BATCH_BYTES:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)],
            schema=ARROW)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each attempt of a task writes to a folder of its own; the commit moves the files of the
    attempts that count into place, so a repeated task leaves nothing twice."""

    def __init__(self, path: str, file_bytes: int, overwrite: bool) -> None:
        self.path, self.file_bytes, self.overwrite = path, file_bytes, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done = Written(f"_attempt-{uuid.uuid4().hex}", [])
        folder, file, size = Folder(self.path), None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if file is None or size > self.file_bytes:
                    if file is not None:
                        file.close()
                    done.names.append(f"part-{uuid.uuid4().hex}{SUFFIX}")
                    file, size = folder.write(f"{done.folder}/{done.names[-1]}"), 0
                    file.write(self._info())
                payload = row["payload"] or b""
                data = member(encode(
                    row["record_type"], row["page_id"], row["url"], row["refers_to"], row["date"],
                    row["payload_digest"] or hashlib.sha256(payload).hexdigest(),
                    len(payload) if row["payload_bytes"] is None else row["payload_bytes"], payload))
                file.write(data)
                size += len(data)
        if file is not None:
            file.close()
        return done

    @staticmethod
    def _info() -> bytes:
        text = b"format: WARC File Format 1.1\r\n"
        return member("\r\n".join([
            VERSION, "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/warc-fields",
            f"Content-Length: {len(text)}"]).encode() + b"\r\n\r\n" + text + b"\r\n\r\n")

    def commit(self, messages: list[Written | None]) -> None:
        folder = Folder(self.path)
        old = [name for name, _ in folder.files(SUFFIX)] if self.overwrite else []
        for done in filter(None, messages):
            for name in done.names:
                folder.move(f"{done.folder}/{name}", name)
            folder.remove(done.folder)
        for name in old:
            folder.fs.delete_file(folder.at(name))

    def abort(self, messages: list[Written | None]) -> None:
        for done in filter(None, messages):
            Folder(self.path).remove(done.folder)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def _options(self) -> tuple[str, int]:
        return self.options["path"], int(self.options.get("fileBytes", FILE_BYTES))

    def reader(self, schema: Any) -> WarcReader:
        return WarcReader(*self._options())

    def writer(self, schema: Any, overwrite: bool) -> WarcWriter:
        return WarcWriter(*self._options(), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records(pages: DataFrame) -> DataFrame:
    """The record of each page, in COLUMNS.

    Of pages with equal payloads of at least 100 bytes, that with the smallest id is the
    response and the others revisit it. A null html is an empty payload; rows that repeat the
    smallest id are responses all; a null id is never the smallest unless all are null, and then
    all are responses. Only page_id, url and html are read. Payloads meet the first id of their
    digest in a join, which Spark splits where one digest has many pages; digests that occur once
    or are short take no part in the lookup.
    """
    made = pick(pages, page_id="page_id", url="url", html="html").select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")).select(
        "*", F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"))
    first = made.where(F.col("payload_bytes") >= LEAST_REVISIT_BYTES).groupBy(
        "payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where(
        "n > 1").drop("n")
    later = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False)) & F.col(
        "first_id").isNotNull()
    return made.join(first, "payload_digest", "left").select(
        F.when(later, "revisit").otherwise("response").alias("record_type"), "page_id", "url",
        F.when(later, F.col("first_id")).alias("refers_to"),
        F.lit(None).cast("string").alias("date"), "payload_digest", "payload_bytes",
        F.when(~later, F.col("payload")).alias("payload"))


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    register(pages.sparkSession)
    records(pages).write.format("warc").option("fileBytes", file_bytes).mode("append").save(folder)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").load(folder)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Pages written as archives and read back: digest and size of a response come from the payload
    that was read, those of a revisit from its headers."""
    write_archives(pages, folder)
    found = read_archives(pages.sparkSession, folder).where(
        F.col("record_type").isin("response", "revisit"))
    revisit = F.col("record_type") == "revisit"
    return found.select(
        "page_id",
        F.when(revisit, F.col("payload_bytes")).otherwise(
            F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(
            F.sha2("payload", 256)).alias("payload_digest"),
        "record_type", "refers_to")
