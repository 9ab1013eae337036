"""Grace hash deduplication by complete content (operator 5).

1. Each task passes over its rows once and keeps, in an open-addressing table
   that compares complete contents, one record per distinct content: the best
   row and the count. Copies therefore meet before the shuffle, and a content
   that a third of all rows share costs one record per task.
2. Those records are partitioned by hash. Where a bucket exceeds its memory
   it is partitioned again, by other bits of the hash, to spill files in the
   shared folder, until each part fits a table.
3. The rows are joined with the small table of groups on their content key.

The key is (SHA-256, XXH3-128). Two different contents with one key, which
nobody has ever seen, raise an error instead of being merged.
"""

from __future__ import annotations

import contextlib
import hashlib
import pickle
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tallyforge.llm.storage import bound_batches, filesystem, lean, session_dir, stored

#: fixed values: the characters deleted before texts are compared
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"

RECORDS = "sha256 binary, xxh128 binary, content binary, chars long, doc_id long, rows long"
GROUPS = "sha256 binary, xxh128 binary, keep_id long, keep_chars long, group_size long"
ROWS = "doc_id long, sha256 binary, xxh128 binary, chars long"


def normalised(text: str | None) -> bytes:
    """UTF-8 of the text without the blanks; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(None, BLANKS)


#: bytes of a record's objects and slots beside its content: three byte strings, four numbers, the record, four slots
OVERHEAD = 512


@dataclass(slots=True)
class Record:
    sha256: bytes
    xxh128: bytes
    content: bytes
    chars: int
    doc_id: int | None
    rows: int
    row: tuple | None = None  # all columns of the best row, where whole rows are wanted
    row_bytes: int = 0

    @property
    def size(self) -> int:
        return len(self.content) + self.row_bytes + OVERHEAD

    def merge(self, other: Record) -> None:
        self.rows += other.rows
        if better(other.chars, other.doc_id, self.chars, self.doc_id):
            self.chars, self.doc_id, self.row, self.row_bytes = other.chars, other.doc_id, other.row, other.row_bytes


def better(chars: int, doc_id: int | None, than_chars: int, than_id: int | None) -> bool:
    """More characters win, then the smaller id; a null id comes last."""
    if chars != than_chars:
        return chars > than_chars
    return doc_id is not None and (than_id is None or doc_id < than_id)


class ContentTable:
    """Open addressing with linear probing; equality is of complete contents."""

    def __init__(self, slots: int = 1 << 10):
        self.slots: list[Record | None] = [None] * slots
        self.used = self.bytes = 0

    def _find(self, record: Record) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(record.xxh128[:8], "little") & mask
        while (other := self.slots[at]) is not None:
            if other.xxh128 == record.xxh128 and other.sha256 == record.sha256:
                if other.content != record.content:
                    raise ValueError("two different contents have the same SHA-256 and XXH3-128")
                return at
            at = (at + 1) & mask
        return at

    def add(self, record: Record) -> None:
        at = self._find(record)
        if (other := self.slots[at]) is not None:
            self.bytes -= other.row_bytes
            other.merge(record)
            self.bytes += other.row_bytes
            return
        self.slots[at] = record
        self.used += 1
        self.bytes += record.size
        if 2 * self.used > len(self.slots):
            old, self.slots = self.slots, [None] * (2 * len(self.slots))
            for r in old:
                if r is not None:
                    self.slots[self._find(r)] = r

    def drain(self) -> Iterator[Record]:
        slots, self.slots = self.slots, [None] * (1 << 10)
        self.used = self.bytes = 0
        return (r for r in slots if r is not None)


class SpillFiles:
    """Partitions of a bucket, in files that only this task attempt uses."""

    def __init__(self, where: str, fan_out: int):
        self.system, path = filesystem(where)
        self.path, self.fan_out = f"{path}/spill-{uuid.uuid4().hex}", fan_out
        self.system.create_dir(self.path, recursive=True)
        self.out = [self.system.open_output_stream(f"{self.path}/{k}") for k in range(fan_out)]

    def add(self, k: int, record: Record) -> None:
        pickle.dump((record.sha256, record.xxh128, record.content, record.chars, record.doc_id, record.rows, record.row, record.row_bytes), self.out[k], protocol=5)

    def done(self) -> None:
        for f in self.out:
            f.close()

    def read(self, k: int) -> Iterator[Record]:
        with self.system.open_input_stream(f"{self.path}/{k}", buffer_size=1 << 20) as f:
            while True:
                try:
                    yield Record(*pickle.load(f))
                except EOFError:
                    return

    def remove(self, k: int) -> None:
        self.system.delete_file(f"{self.path}/{k}")

    def close(self) -> None:
        for f in self.out:
            with contextlib.suppress(OSError, ValueError):
                f.close()
        if self.system.get_file_info(self.path).type != fs.FileType.NotFound:
            self.system.delete_dir(self.path)


def grace(records: Iterable[Record], where: str, memory: int, fan_out: int = 16, level: int = 0) -> Iterator[Record]:
    """One record per distinct content; recursion reads other hash bits.

    A part whose distinct contents exceed ``memory`` is split; after 15 levels
    of four bits each the hash is spent, and a part holds one content, which
    always fits since equal contents share one record.
    """
    table, files = ContentTable(), None
    try:
        for record in records:
            table.add(record)
            if table.bytes > memory and table.used > 1 and level < 15:
                files = files or SpillFiles(where, fan_out)
                for r in table.drain():
                    files.add((r.sha256[level] ^ r.sha256[16 + level]) % fan_out, r)
        if files is None:
            yield from table.drain()
            return
        for r in table.drain():
            files.add((r.sha256[level] ^ r.sha256[16 + level]) % fan_out, r)
        files.done()
        for k in range(fan_out):
            yield from grace(files.read(k), where, memory, fan_out, level + 1)
            files.remove(k)
    finally:
        if files is not None:
            files.close()


def _record(doc_id: int | None, text: str | None) -> Record:
    content = normalised(text)
    return Record(hashlib.sha256(content).digest(), xxhash.xxh3_128_digest(content), content, len(text or ""), doc_id, 1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha, xxh, chars = [], [], []
        for text in batch[1]:
            r = _record(None, text.as_py())
            sha.append(r.sha256)
            xxh.append(r.xxh128)
            chars.append(r.chars)
        yield pa.RecordBatch.from_arrays([batch[0], pa.array(sha, pa.binary()), pa.array(xxh, pa.binary()), pa.array(chars, pa.int64())], names=["doc_id", "sha256", "xxh128", "chars"])


def _to_batches(records: Iterator[Record], columns: list[tuple[str, str, pa.DataType]], most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    held: list[Record] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([getattr(r, a) for r in held], k) for _, a, k in columns], names=[n for n, _, _ in columns])

    for r in records:
        held.append(r)
        size += r.size
        if size >= most:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _local_records(memory: int):
    columns = [("sha256", "sha256", pa.binary()), ("xxh128", "xxh128", pa.binary()), ("content", "content", pa.binary()), ("chars", "chars", pa.int64()), ("doc_id", "doc_id", pa.int64()), ("rows", "rows", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for doc_id, text in zip(batch[0], batch[1], strict=True):
                table.add(_record(doc_id.as_py(), text.as_py()))
                if table.bytes > memory:  # the rest meets after the shuffle
                    yield from _to_batches(table.drain(), columns)
        yield from _to_batches(table.drain(), columns)

    return run


def _groups(where: str, memory: int):
    columns = [("sha256", "sha256", pa.binary()), ("xxh128", "xxh128", pa.binary()), ("keep_id", "doc_id", pa.int64()), ("keep_chars", "chars", pa.int64()), ("group_size", "rows", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (Record(*(c[i].as_py() for c in batch.columns)) for batch in batches for i in range(batch.num_rows))
        yield from _to_batches(grace(records, where, memory), columns)

    return run


#: bytes of records that a task holds before it sends them on, and that a bucket may hold before it is partitioned again
LOCAL_MEMORY, BUCKET_MEMORY = 24 << 20, 48 << 20


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", local_memory: int = LOCAL_MEMORY, bucket_memory: int = BUCKET_MEMORY) -> DataFrame:
    """One row per distinct normalised content (see GROUPS)."""
    spark = docs.sparkSession
    bound_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    local = source.mapInArrow(lean(_local_records(local_memory)), RECORDS)
    dealt = local.repartition(F.col("sha256"), F.col("xxh128"))
    return dealt.mapInArrow(lean(_groups(session_dir(spark), bucket_memory)), GROUPS)


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", local_memory: int = LOCAL_MEMORY, bucket_memory: int = BUCKET_MEMORY) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without blanks (``BLANKS``). The row with
    the most code points in its original text stays, then the smallest id; a
    null id comes after all others. Null text counts as empty, so all empty
    texts form one group. Rows that repeat an id and a text are separate rows
    of one group and are all ``kept`` if that id stays. Other columns are not
    read. An empty table gives no rows.
    """
    found = stored(groups(docs, id_col=id_col, text_col=text_col, local_memory=local_memory, bucket_memory=bucket_memory), "dedup-groups")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = source.mapInArrow(lean(_rows), ROWS)
    return rows.join(found, ["sha256", "xxh128"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def _whole_rows(batches: Iterator[pa.RecordBatch], id_at: int, text_at: int) -> Iterator[Record]:
    """A record with all columns of each row; the id is the last column, as a long."""
    for batch in batches:
        share = batch.nbytes // max(batch.num_rows, 1)
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            r = _record(row[id_at], row[text_at])
            r.row, r.row_bytes = row, share + len(row[text_at] or "")
            yield r


def _row_batches(records: Iterator[Record], schema: pa.Schema | None, keys: bool, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    held: list[Record] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*(r.row for r in held), strict=True), schema.types, strict=True)]
        names = list(schema.names)
        if keys:
            columns += [pa.array([r.sha256 for r in held], pa.binary()), pa.array([r.xxh128 for r in held], pa.binary())]
            names += ["sha256", "xxh128"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for r in records:
        held.append(r)
        size += r.size
        if size >= most:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _typed(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Schema | None, Iterator[pa.RecordBatch]]:
    first = next(batches, None)
    return (None, iter(())) if first is None else (first.schema, chain([first], batches))


def _best_rows(id_at: int, text_at: int, memory: int):
    """Of a task's rows the best of each content, with its keys; a full table is sent on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, batches = _typed(batches)
        table = ContentTable()
        for record in _whole_rows(batches, id_at, text_at):
            table.add(record)
            if table.bytes > memory:
                yield from _row_batches(table.drain(), schema, True)
        yield from _row_batches(table.drain(), schema, True)

    return run


def _best_of_bucket(id_at: int, text_at: int, where: str, memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, batches = _typed(batches)
        yield from _row_batches(grace(_whole_rows(batches, id_at, text_at), where, memory), schema, False)

    return run


def without_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", local_memory: int = LOCAL_MEMORY, bucket_memory: int = BUCKET_MEMORY) -> DataFrame:
    """One row of each group of equal texts, all columns.

    Of rows that repeat the id that stays and its text one is kept. Whole rows
    are shuffled once, after a task's copies have met; any column names are
    allowed. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    names = docs.columns
    text_at, id_at = names.index(text_col), len(names)
    plain = docs.select("*", F.col(id_col).cast("long").alias("own id")).toDF(*(f"c{k}" for k in range(len(names) + 1)))
    keyed = StructType([*plain.schema.fields, StructField("sha256", BinaryType()), StructField("xxh128", BinaryType())])
    local = plain.mapInArrow(lean(_best_rows(id_at, text_at, local_memory)), keyed)
    dealt = local.repartition(F.col("sha256"), F.col("xxh128")).drop("sha256", "xxh128")
    kept = dealt.mapInArrow(lean(_best_of_bucket(id_at, text_at, session_dir(spark), bucket_memory)), plain.schema)
    return kept.select(*(F.col(f"c{k}").alias(name) for k, name in enumerate(names)))
