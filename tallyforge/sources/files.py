"""Downloaded files: kinds, inventory and archives (S13-S15), and sinks of whole tables (K1, K4, K9)."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.shared import bounded_batches, filesystem
from tallyforge.sources.ranges import files_below

# First bytes of archives.
ZIP_MAGIC = ("504B0304", "504B0506", "504B0708")
RAR_MAGIC = ("526172211A0700", "526172211A070100")
MIME = {".pdf": "application/pdf", ".rtf": "application/rtf", ".html": "text/html", ".htm": "text/html", ".zip": "application/zip", ".txt": "text/plain", ".xml": "application/xml", ".doc": "application/msword"}


def archive_kind(path: Column, content: Column) -> Column:
    """By suffix, else by the first bytes."""
    low, head = F.lower(path), F.hex(F.substring(content, 1, 8))

    def begins(magic: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for m in magic:
            out = out | F.startswith(head, F.lit(m))
        return out

    return F.when(low.endswith(".zip"), "zip").when(low.endswith(".rar"), "rar").when(begins(ZIP_MAGIC), "zip").when(begins(RAR_MAGIC), "rar")


#: bytes of a file that are read at once
BLOCK = 1 << 20


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Each file with its digest and kind; archives and partial downloads are left out.

    Only names and sizes are listed, empty files too; a task reads a file's
    blocks into the digest, so memory does not depend on the size of a file,
    which may exceed what fits a column. Files are dealt over tasks one by one.
    """
    authority = "/".join(folder.split("/", 3)[:3]) if "://" in folder else "file:"
    listed = spark.createDataFrame([(authority + path, size) for path, size in files_below(folder).items()], "path string, length long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, where = filesystem(path)
                digest, head = hashlib.sha256(), b""
                with system.open_input_stream(where) as f:
                    while block := f.read(BLOCK):
                        head = head or block[:8]
                        digest.update(block)
                yield pa.RecordBatch.from_pydict({"path": [path], "length": [length], "head": [head], "file_hash": [digest.hexdigest()]})

    # by number: rows of names are small, so Spark would join them all into one task, but the files are not
    dealt = listed.where(~F.col("path").endswith(".partial")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    files = dealt.mapInArrow(run, "path string, length long, head binary, file_hash string")
    wanted = files.where(archive_kind(F.col("path"), F.col("head")).isNull())
    suffix = F.regexp_extract(F.lower("path"), r"(\.[a-z0-9]+)$", 1)
    table = F.create_map(*(F.lit(x) for kv in MIME.items() for x in kv))
    name = F.regexp_extract("path", r"[^/]*$", 0)
    return wanted.select("path", name.alias("name"), "length", "file_hash", F.try_element_at(table, suffix).alias("mime_type"))


MEMBERS = "path string, member string, file_hash string, size long, content binary, error string"


def unpack(archives: DataFrame, max_bytes: int = 500 << 20, with_content: bool = True) -> DataFrame:
    """Members of zip archives (path, content). An archive with an unsafe path, of too large a
    total or that cannot be read gives one row with its error and no members (W8).

    Archives come in batches bounded by bytes, and a member is read in blocks, so
    without contents memory is a batch's and a block's.
    """
    bounded_batches(archives.sparkSession)

    def members(path: str, content: bytes) -> list[tuple]:
        out, total = [], 0
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for m in z.infolist():
                if m.is_dir():
                    continue
                parts = m.filename.replace("\\", "/").split("/")
                if not m.filename or parts[0] == "" or ".." in parts:
                    raise ValueError(f"unsafe member {m.filename!r}")
                total += m.file_size
                if total > max_bytes:
                    raise ValueError(f"more than {max_bytes} bytes")
                data, digest, size = [], hashlib.sha256(), 0
                with z.open(m) as f:
                    while block := f.read(BLOCK):
                        digest.update(block)
                        size += len(block)
                        if with_content:
                            data.append(block)
                out.append((path, m.filename, digest.hexdigest(), size, b"".join(data) if with_content else None, None))
        return out

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in MEMBERS.split(", ")]
        for p in parts:
            for path, content in zip(p["path"], p["content"], strict=True):
                try:
                    rows = members(path, bytes(content))
                except (ValueError, OSError, zipfile.BadZipFile, NotImplementedError, RuntimeError) as e:
                    rows = [(path, None, None, None, None, str(e))]
                yield pd.DataFrame(rows, columns=names)

    return archives.select("path", "content").mapInPandas(run, MEMBERS)


def write_sheets(sheets: dict[str, DataFrame], folder: str, kind: str = "parquet") -> None:
    """K1, K9: each sheet to a folder of its own; an old one is replaced when the new one is whole."""
    for name, df in sheets.items():
        df.write.mode("overwrite").format(kind).option("header", "true").save(f"{folder}/{name}")


def nested_extracts(pages: DataFrame) -> DataFrame:
    """One row per document with its pages in order."""
    return pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_number", F.col("page").alias("text")))).alias("pages"))


def write_extracts(pages: DataFrame, folder: str) -> None:
    """K4."""
    nested_extracts(pages).write.mode("overwrite").parquet(folder)
