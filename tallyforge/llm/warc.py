"""WARC files: a writer, and a Python data source that reads them (operator 2).

The source plans a partition per file, and for a large gzip file one per range
of bytes: a range has the members that start in it, of which the first is found
by the mark of a member whose content begins with a WARC record. (A file that is
one member has one range with records; plain files are not cut.) Filters on record_type, on the
other header columns and on ``page_id`` are pushed to the reader, which parses
a record's headers first and steps over the block of a record that it does not
want without decoding it; the payload is decoded only if a column needs it
(``columns`` of ``read``, or the schema that the source is loaded with: Spark tells
a Python source nothing else of the columns that a plan needs).
Files are sequences of gzip members, one per record, or plain.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull
from pyspark.sql.types import StructType

from tallyforge.llm.storage import bound_batches, filesystem, fresh_dir, publish, stored

# Fixed values of the format.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
#: smaller payloads are never revisits
LEAST_REVISIT = 100

SCHEMA = "record_type string, record_id string, target_uri string, warc_date string, payload_digest string, page_id long, refers_to long, payload_bytes long, payload binary"
#: header of each column
HEADER = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "page_id": "x-page-id",
    "refers_to": "x-refers-to-page-id",
}
NUMBERS = ("page_id", "refers_to", "payload_bytes")


def _clean(value: str) -> str:
    """A header value on one line: controls and blanks are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; ``refers_to`` makes it a revisit, whose block has no payload."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\0{url}\0{digest}")
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        headers.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        headers += [("WARC-Profile", IDENTICAL), ("X-Refers-To-Page-Id", str(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    head = b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in headers)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _write_files(where: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        count = 0

        def write(out) -> None:
            nonlocal count
            for batch in batches:
                for page_id, url, payload, digest, refers_to in zip(*batch.columns, strict=True):
                    out.write(_member(record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py()), level))
                    count += 1

        uri = f"{where}/part-{number:06d}.warc.gz"
        publish(uri, write)
        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([count], pa.int64())], names=["file", "records"])

    return run


def write(pages: DataFrame, where: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", level: int = 1) -> DataFrame:
    """Write a record per row to files below ``where``; returns (file, records).

    Of rows with equal payloads of at least ``LEAST_REVISIT`` bytes the one
    with the smallest id is a response and the others revisit it; rows that
    repeat that id are responses as well. Null html is an empty payload. A row
    without id is a response, as it has no id to be told by. The work is done
    when this returns.
    """
    bound_batches(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    large = source.where((F.octet_length("payload") >= LEAST_REVISIT) & F.col("page_id").isNotNull())
    firsts = stored(large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "warc-firsts")
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    rows = source.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))
    return stored(rows.mapInArrow(_write_files(where, level), "file string, records long"), "warc-files")


class _Stream:
    """Reads, or steps over, the bytes of a file that may be gzip members."""

    def __init__(self, raw, chunk: int = 1 << 20, stop: int | None = None):
        """``stop``: members that start there, counted from where ``raw`` stands, or later are not read."""
        self.raw, self.chunk, self.held, self.at = raw, chunk, b"", 0
        self.stop, self.ended = stop, False
        first = raw.read(chunk)
        self.read = len(first)
        self.inflate = zlib.decompressobj(31) if first[:2] == b"\x1f\x8b" else None
        self.packed, self.fresh = first, True  # fresh: between members
        self._more()

    def _more(self) -> bool:
        """Put more plain bytes behind those held; False at the end."""
        rest = self.held[self.at :]
        self.at = 0
        while True:
            if not self.packed:
                self.packed = b"" if self.ended else self.raw.read(self.chunk)
                self.read += len(self.packed)
                if self.packed and self.inflate is not None and self.stop is not None and self.fresh and self.read - len(self.packed) >= self.stop:
                    self.ended, self.packed = True, b""
                if not self.packed:
                    self.held = rest
                    return False
            if self.inflate is None:
                new, self.packed = self.packed, b""
            else:
                new = self.inflate.decompress(self.packed, self.chunk)
                self.packed, self.fresh = self.inflate.unconsumed_tail, False
                if self.inflate.eof:
                    self.packed, self.fresh = self.inflate.unused_data, True
                    self.inflate = zlib.decompressobj(31)
                    if self.packed and self.stop is not None and self.read - len(self.packed) >= self.stop:
                        self.ended, self.packed = True, b""
            if new:
                self.held = rest + new
                return True

    def line(self) -> bytes | None:
        while (end := self.held.find(b"\n", self.at)) < 0:
            if not self._more():
                return None
        line, self.at = self.held[self.at : end + 1], end + 1
        return line

    def take(self, n: int) -> bytes:
        parts, left = [], n
        while True:
            have = self.held[self.at : self.at + left]
            self.at += len(have)
            left -= len(have)
            parts.append(have)
            if not left:
                return b"".join(parts)
            if not self._more():
                raise ValueError("a WARC record ends before its block does")

    def skip(self, n: int) -> None:
        while n:
            step = min(n, len(self.held) - self.at)
            self.at += step
            n -= step
            if n and not self._more():
                raise ValueError("a WARC record ends before its block does")


MEMBER = b"\x1f\x8b\x08"


def first_member(raw, start: int, stop: int, block: int = 1 << 20) -> int | None:
    """Where the first gzip member in ``start`` to ``stop`` begins whose content begins with a WARC record; None without one."""
    at, held = start, b""
    raw.seek(start)
    while True:
        new = raw.read(block)
        held += new
        k = held.find(MEMBER)
        while 0 <= k and (len(held) - k >= 512 or not new):
            if at + k >= stop:
                return None
            try:
                if zlib.decompressobj(31).decompress(held[k : k + 4096], 64).startswith(b"WARC/"):
                    return at + k
            except zlib.error:
                pass
            k = held.find(MEMBER, k + 1)
        if not new or at + len(held) - 512 >= stop and k < 0:
            return None
        keep = len(held) - k if k >= 0 else min(len(held), len(MEMBER) - 1)
        at, held = at + len(held) - keep, held[len(held) - keep :]


def read_records(raw, wanted, payload: bool, stop: int | None = None) -> Iterator[tuple]:
    """(record's values in the order of SCHEMA); ``wanted`` sees headers only, ``stop`` is as for ``_Stream``."""
    stream = _Stream(raw, stop=stop)
    while True:
        line = stream.line()
        if line is None:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.line()) is not None and line.strip():
            key, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            headers[key.strip().lower()] = value.strip()
        length = int(headers.get("content-length", 0))
        values: dict = {c: headers.get(h) for c, h in HEADER.items()}
        for c in ("page_id", "refers_to"):
            values[c] = int(values[c]) if values[c] is not None else None
        if not wanted(values):
            stream.skip(length)
            continue
        http: dict[str, str] = {}
        if headers.get("content-type", "").startswith("application/http"):
            used = 0
            while used < length:
                line = stream.line()
                if line is None:
                    raise ValueError("a WARC record ends before its block does")
                used += len(line)
                if not line.strip():
                    break
                key, _, value = line.decode("latin-1").partition(":")
                http[key.strip().lower()] = value.strip()
            length -= used
        values["payload_bytes"] = int(http.get("content-length", length))
        if payload and values["record_type"] != "revisit":
            values["payload"] = stream.take(length)
        else:
            values["payload"] = None
            stream.skip(length)
        yield tuple(values[c] for c in (*HEADER, "payload_bytes", "payload"))


@dataclass
class WarcFile(InputPartition):
    """A file, or the members of it that start in a range of bytes."""

    path: str
    start: int = 0
    stop: int | None = None


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns = schema.fieldNames()
        self.where = options["path"]
        self.payload = "payload" in self.columns and options.get("payload", "true").lower() != "false"
        self.split = int(options.get("splitBytes", 64 << 20))
        self.filters: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality, IN and not-null tests of header columns are done by the reader."""
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column in HEADER and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.filters.append((column, (f.value,)))
            elif column in HEADER and isinstance(f, In):
                self.filters.append((column, tuple(v for v in f.value if v is not None)))
            elif column in HEADER and isinstance(f, IsNotNull):
                self.filters.append((column, ()))
            else:
                yield f
                continue

    def partitions(self) -> list[WarcFile]:
        system, path = filesystem(self.where)
        info = system.get_file_info(path)
        if info.type == fs.FileType.File:
            return self._ranges(self.where, info.size)
        found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith((".warc", ".warc.gz")))
        return [r for name, size in files for r in self._ranges(self.where.rstrip("/") + name.removeprefix(path.rstrip("/")), size)] or [WarcFile("")]

    def _ranges(self, path: str, size: int) -> list[WarcFile]:
        if size <= self.split or not path.endswith(".gz"):
            return [WarcFile(path)]
        return [WarcFile(path, a, min(a + self.split, size)) for a in range(0, size, self.split)]

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        tests = [(c, frozenset(v)) for c, v in self.filters]

        def wanted(values: dict) -> bool:
            return all(values[c] is not None and (not v or values[c] in v) for c, v in tests)

        names = [*HEADER, "payload_bytes", "payload"]
        kinds = {n: pa.int64() if n in NUMBERS else pa.binary() if n == "payload" else pa.string() for n in names}
        at = [names.index(c) for c in self.columns]
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[k], kinds[names[k]]) for k in at], names=self.columns)

        system, path = filesystem(partition.path)
        with system.open_input_file(path) as raw:
            start, stop = partition.start, partition.stop
            if start:
                start = first_member(raw, start, stop)
                if start is None:
                    return
                raw.seek(start)
            for row in read_records(raw, wanted, self.payload, None if stop is None else stop - start):
                rows.append(row)
                size += 300 + len(row[-1] or b"")
                if size >= 4 << 20:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)``; option payload=false never decodes payloads, splitBytes is the length of a range."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)


def read(spark: SparkSession, where: str, *, payload: bool = True, columns: tuple[str, ...] | None = None, split_bytes: int = 64 << 20) -> DataFrame:
    """All records below ``where``, with filters pushed to the reader; of ``columns`` only, if given.

    Without the column ``payload`` no payload is decoded. The session's setting that
    lets Spark push filters to Python sources is set.
    """
    bound_batches(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").option("payload", str(payload).lower()).option("splitBytes", split_bytes)
    if columns is not None:
        kinds = dict(part.split() for part in SCHEMA.split(", "))
        reader = reader.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return reader.load(where)


def archived(pages: DataFrame, *, where: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages as WARC and read them back; one row per page.

    page_id, payload_bytes, payload_digest (bare hexadecimal SHA-256),
    record_type, refers_to. Responses are measured on the payload that was
    read; revisits carry the figures of the full payload in their headers.
    """
    spark = pages.sparkSession
    where = where or fresh_dir(spark, "warc")
    write(pages, where, id_col=id_col, url_col=url_col, html_col=html_col)
    records = read(spark, where)
    response = F.col("record_type") == "response"
    return records.where(F.col("record_type").isin("response", "revisit")).select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.regexp_replace("payload_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "target_uri",
    )


def digest_of(payload: bytes) -> str:
    return hashlib.sha256(payload).hexdigest()
