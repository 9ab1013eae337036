"""Files of token ids with Elias-Fano coded boundaries (operator 12).

A file is the ids of its documents, one after another, in the narrowest
unsigned type that holds the vocabulary; then two Elias-Fano sequences, the
document ids and the boundaries (0, the end of each document), and a footer of
fixed size. Documents stand in ascending order of their id, in each file and
from file to file. A folder also has the table ``_manifest``, a row for each
file. Documents are read through ``TokenFile`` by selection in the boundaries;
nothing holds an offset of each document.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.eliasfano import EliasFano
from tallyforge.llm.storage import Batches, bound_batches, filesystem, fresh_dir, lean, publish
from tallyforge.llm.tokens import encoder, tokenizer_path

MAGIC = b"TFIDS001"
#: bytes of an id, documents, ids, documents of null id, smallest id, length of the two sequences
FOOTER = struct.Struct("<QQQQqQQ8s")
#: a file ends after the document that reaches one of these
FILE_IDS, FILE_DOCS = 1 << 27, 1 << 20
#: ids read by a task at once, and in each step of a long document
SPAN_IDS, STEP_IDS = 1 << 22, 1 << 20
MANIFEST = "file string, n_docs long, n_ids long, n_bytes long"


class TokenFile:
    """One file; only the footer, the sequences and the ids asked for are read."""

    def __init__(self, uri: str):
        system, path = filesystem(uri)
        self._file = system.open_input_file(path)
        size = self._file.size()
        self.width, self.n_docs, self.n_ids, self.n_null, self.base, docs, bounds, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC or size != len(MAGIC) + self.width * self.n_ids + docs + bounds + FOOTER.size:
            raise ValueError(f"{uri} is no whole token file")
        at = size - FOOTER.size - bounds - docs
        self.docs, self.bounds = EliasFano(self._at(at, docs)), EliasFano(self._at(at + docs, bounds))

    def _at(self, start: int, length: int) -> bytes:
        self._file.seek(start)
        return self._file.read(length)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self._file.close()

    def __len__(self) -> int:
        return self.n_docs

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (without it) of the file."""
        return np.frombuffer(self._at(len(MAGIC) + start * self.width, (stop - start) * self.width), f"<u{self.width}")

    def document(self, k: int) -> np.ndarray:
        """Ids of the document at place ``k``, its end id included."""
        start, stop = self.bounds.between(k, k + 2).tolist()
        return self.ids(start, stop)

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        null = max(0, min(last, self.n_null) - first)
        known = self.docs.between(max(first, self.n_null) - self.n_null, max(last, self.n_null) - self.n_null)
        return [None] * null + [self.base + v for v in known.tolist()]

    def find(self, doc_id: int) -> int | None:
        """Place of the first document of that id, or None."""
        k = self.docs.find(doc_id - self.base) if doc_id >= self.base else len(self.docs)
        return self.n_null + k if k < len(self.docs) and self.base + self.docs.select(k) == doc_id else None


def _written(out, rows: Iterator[tuple[int | None, str | None]], first: tuple, encode, end_id: int, width: int, most_ids: int, most_docs: int) -> tuple[dict, tuple | None]:
    """Writes documents from ``first`` on until the file is full; its manifest row, and the row that follows."""
    ids, bounds, null, row = array("q"), array("Q", [0]), 0, first
    out.write(MAGIC)
    while row is not None and bounds[-1] < most_ids and len(bounds) <= most_docs:
        found = np.append(encode(row[1]), end_id).astype(f"<u{width}")
        out.write(found.tobytes())
        bounds.append(bounds[-1] + len(found))
        if row[0] is None:
            null += 1
        else:
            ids.append(row[0])
        row = next(rows, None)
    base = ids[0] if ids else 0
    docs = EliasFano.encoded(np.frombuffer(ids, np.int64).view(np.uint64) - np.uint64(base % 2**64) if ids else np.empty(0))
    ends = EliasFano.encoded(np.frombuffer(bounds, np.uint64))
    out.write(docs)
    out.write(ends)
    out.write(FOOTER.pack(width, len(bounds) - 1, bounds[-1], null, base, len(docs), len(ends), MAGIC))
    return {"n_docs": len(bounds) - 1, "n_ids": bounds[-1], "n_bytes": len(MAGIC) + width * bounds[-1] + len(docs) + len(ends) + FOOTER.size}, row


def _write(path: str, where: str, end_id: int, most_ids: int, most_docs: int):
    def run(batches: Batches) -> Batches:
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        tokenizer = encoder(path)
        width = 2 if max(tokenizer.whole.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        rows = ((i.as_py(), t.as_py()) for b in batches for i, t in zip(b[0], b[1], strict=True))
        row, number = next(rows, None), 0
        while row is not None:
            name, said = f"part-{part:06d}-{number:05d}.ids", {}

            def write(out, row=row, said=said) -> None:
                said["is"] = _written(out, rows, row, tokenizer.encode, end_id, width, most_ids, most_docs)

            publish(f"{where}/{name}", write)
            file, row = said["is"]
            number += 1
            yield pa.RecordBatch.from_pylist([{"file": name} | file])

    return lean(run)


def write_ids(docs: DataFrame, where: str, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 0, file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS) -> DataFrame:
    """Write the ids of each whole text and ``end_id`` to files below ``where``; the manifest.

    Documents are written in ascending order of their id (null ids first, equal
    ids by a hash of their text and then the text). Null text is empty: its
    document is ``end_id`` alone. Repeated rows are documents of their own. Other
    columns are not read. An empty table gives no files. Rows are dealt by range
    of id and hash, so an id of many different texts is split; rows alike in
    both stream through one task. The work is done when this returns.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    run = _write(path or tokenizer_path(), where, end_id, file_ids, file_docs)
    rows.mapInArrow(run, MANIFEST).write.parquet(f"{where}/_manifest")
    return manifest(spark, where)


def manifest(spark: SparkSession, where: str) -> DataFrame:
    """A row for each file of the folder: file, n_docs, n_ids, n_bytes and ``start``, the ids of the files before it."""
    files = spark.read.schema(MANIFEST).parquet(f"{where}/_manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are files
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _crc32(file: TokenFile, start: int, stop: int) -> int:
    crc = 0
    for a in range(start, stop, STEP_IDS):
        crc = zlib.crc32(file.ids(a, min(stop, a + STEP_IDS)).astype("<u4"), crc)
    return crc


def _read(where: str, with_ids: bool):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for name, base, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with TokenFile(f"{where}/{name}") as file:
                    for a in range(first, last, 1024):
                        b = min(last, a + 1024)
                        bounds = file.bounds.between(a, b + 1).astype(np.int64)
                        columns = [pa.array(file.doc_ids(a, b), pa.int64()), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds))]
                        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                        if not with_ids:
                            columns.append(pa.array(_crcs(file, bounds.tolist()), pa.int64()))
                            yield pa.RecordBatch.from_arrays(columns, names=names)
                            continue
                        for k in range(b - a):  # a document at a time: its ids may be many
                            ids = file.ids(int(bounds[k]), int(bounds[k + 1])).astype("<u4").tobytes()
                            row = [c.slice(k, 1) for c in columns] + [pa.array([zlib.crc32(ids)], pa.int64()), pa.array([ids], pa.binary())]
                            yield pa.RecordBatch.from_arrays(row, names=[*names, "ids"])

    return lean(run)


def _crcs(file: TokenFile, bounds: list[int]) -> list[int]:
    """The crc32 of each document; neighbours are read together in bounded pieces."""
    found, k = [], 0
    while k < len(bounds) - 1:
        m = k + 1
        while m < len(bounds) - 1 and bounds[m + 1] - bounds[k] <= STEP_IDS:
            m += 1
        if bounds[m] - bounds[k] > STEP_IDS:
            found.append(_crc32(file, bounds[k], bounds[m]))
        else:
            ids = file.ids(bounds[k], bounds[m]).astype("<u4")
            found += [zlib.crc32(ids[a - bounds[k] : b - bounds[k]]) for a, b in zip(bounds[k:m], bounds[k + 1 : m + 1], strict=True)]
        k = m
    return found


def read_ids(spark: SparkSession, where: str, *, with_ids: bool = True, span_ids: int = SPAN_IDS) -> DataFrame:
    """The documents of a folder: doc_id, start, n_tokens, ids_crc32, and ids unless ``with_ids`` is False.

    ``start`` counts the ids of all documents before it, over all files. A file
    is read in spans of about ``span_ids`` ids, each by whichever task gets it: a
    task finds its documents by selection in the boundaries. ``ids`` are
    little-endian unsigned 32-bit integers.
    """
    bound_batches(spark)
    files = manifest(spark, where)
    step = F.greatest(F.lit(1).cast("long"), F.expr(f"n_docs * {span_ids} div n_ids"))
    spans = files.withColumn("step", step).select("file", "start", "n_docs", "step", F.explode(F.expr("sequence(0L, n_docs - 1, step)")).alias("first"))
    spans = spans.select("file", "start", "first", F.least("n_docs", F.col("first") + F.col("step")).alias("last"))
    names = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    # by number: rows of spans are small, so Spark would join them all into one task, but their ids are not
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spans.repartition(tasks, "file", "first").mapInArrow(_read(where, with_ids), names)


def token_table(docs: DataFrame, *, where: str | None = None, **options) -> DataFrame:
    """Write ``docs`` (options as ``write_ids`` has them) and read the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    where = where or fresh_dir(spark, "token-files")
    write_ids(docs, where, **options)
    return read_ids(spark, where, with_ids=False)
