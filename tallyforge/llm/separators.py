"""Token counts from flat token files without an index (operator 4).

Documents are token ids with an end-of-document id after each, one after
another in binary files. Blocks of bounded size are searched for that id with
vector operations; a prefix scan over the blocks of a file then gives each
block the number of documents before it and the tokens that an open document
has so far, which stitches documents across block boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.storage import bound_batches, filesystem, fresh_dir, publish, stored
from tallyforge.llm.tokens import encoder, tokenizer_path

#: <|endoftext|> of the default tokenizer
END_ID = 50256


def _write(path: str, where: str, end_id: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        encode, ids = encoder(path, True).encode, []

        def write(out) -> None:
            for batch in batches:
                for doc_id, text in zip(batch[0], batch[1], strict=True):
                    out.write(encode(text.as_py()).astype(dtype).tobytes())
                    out.write(np.array([end_id], dtype).tobytes())
                    ids.append(doc_id.as_py())

        name = f"part-{number:06d}.bin"
        publish(f"{where}/{name}", write)
        for k in range(0, len(ids), 65_536):
            part = ids[k : k + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(range(k, k + len(part)), pa.int64()), pa.array(part, pa.int64())], names=["file", "ordinal", "doc_id"])

    return run


def write_tokens(docs: DataFrame, where: str, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID, dtype: str = "<u2") -> DataFrame:
    """Write the ids of each text and ``end_id``; returns (file, ordinal, doc_id).

    The string of a special token within a text is ordinary text, so that
    ``end_id`` stands between documents only. Null text is empty. The work is
    done when this returns.
    """
    if end_id > np.iinfo(dtype).max:
        raise ValueError(f"{end_id} does not fit {dtype}")
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(_write(path or tokenizer_path(), where, end_id, dtype), "file string, ordinal long, doc_id long"), "token-manifest")


def _scan(where: str, end_id: int, dtype: str):
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = filesystem(where)
        for batch in batches:
            for name, block, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with system.open_input_file(f"{top}/{name}") as f:
                    f.seek(start)
                    ids = np.frombuffer(f.read(length), dtype)
                at = np.flatnonzero(ids == end_id)
                # row 0: the whole block; then one row for each document after its first separator
                inner = np.diff(at) - 1
                n = len(inner) + 1
                head = int(at[0]) if len(at) else length // width
                tail = length // width - int(at[-1]) - 1 if len(at) else length // width
                columns = [
                    pa.array([name] * n),
                    pa.array([block] * n, pa.int64()),
                    pa.array(np.arange(n), pa.int64()),
                    pa.array(np.concatenate([[head], inner]).astype(np.int64)),
                    pa.array([len(at)] + [0] * (n - 1), pa.int64()),
                    pa.array([tail] + [0] * (n - 1), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "k", "tokens", "separators", "tail"])

    return run


def _blocks(spark: SparkSession, where: str, block_tokens: int, width: int) -> DataFrame:
    """The blocks of all files; only names and sizes come to the driver."""
    system, top = filesystem(where)
    found = system.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True))
    files = sorted((f.path.removeprefix(top).lstrip("/"), f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(".bin"))
    for name, size in files:
        if size % width:
            raise ValueError(f"{name}: {size} bytes are no whole number of ids")
    step = block_tokens * width
    table = spark.createDataFrame([f for f in files if f[1]], "file string, size long")
    blocks = table.select("file", "size", F.explode(F.sequence(F.lit(0), F.expr(f"(size - 1) div {step}"))).alias("block"))
    start = F.col("block") * step
    return blocks.select("file", F.col("block").cast("long").alias("block"), start.cast("long").alias("start"), F.least(F.lit(step), F.col("size") - start).cast("long").alias("length"))


def documents_of(spark: SparkSession, where: str, *, end_id: int = END_ID, dtype: str = "<u2", block_tokens: int = 1 << 22) -> DataFrame:
    """One row per document of the files below ``where``: file, ordinal, n_tokens, ended.

    ``n_tokens`` is without the separator. Adjacent separators are an empty
    document. Tokens after a file's last separator are a document that has not
    ``ended``. A file of a size that is no whole number of ids raises
    ValueError; empty files and folders give no rows.
    """
    bound_batches(spark)
    blocks = _blocks(spark, where, block_tokens, np.dtype(dtype).itemsize)
    # by number: rows of blocks are small, so Spark would join them all into one task, but their ids are not
    dealt = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("file"), F.col("block"))
    found = stored(dealt.mapInArrow(_scan(where, end_id, dtype), "file string, block long, k long, tokens long, separators long, tail long"), "token-scan")
    order = Window.partitionBy("file").orderBy("block")
    before, so_far = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    # prefix scan: a block with a separator starts a new run, blocks without one add to it
    scan = found.where("k = 0").withColumn("ordinal", F.coalesce(F.sum("separators").over(before), F.lit(0)))
    scan = scan.withColumn("length_before", F.coalesce(F.sum(F.when(F.col("separators") > 0, 0).otherwise(F.col("tail"))).over(before), F.lit(0)))
    opened = F.when(F.col("separators") > 0, F.struct("tail", (F.col("length_before")).alias("base")))
    last = F.last(opened, ignorenulls=True)
    scan = scan.withColumn("open", last.over(before)).withColumn("open_now", last.over(so_far)).withColumn("is_last", F.row_number().over(Window.partitionBy("file").orderBy(F.desc("block"))) == 1)
    carried = F.coalesce(F.col("open.tail") + F.col("length_before") - F.col("open.base"), F.col("length_before"))
    first = scan.where("separators > 0").select("file", "ordinal", (F.col("tokens") + carried).alias("n_tokens"), F.lit(True).alias("ended"))
    rest = F.when(F.col("separators") > 0, F.col("tail")).otherwise(carried + F.col("tail"))
    open_end = scan.where("is_last").select("file", (F.col("ordinal") + F.col("separators")).alias("ordinal"), rest.alias("n_tokens"), F.lit(False).alias("ended")).where("n_tokens > 0")
    base = stored(scan.select("file", "block", "ordinal"), "token-bases")
    inner = found.where("k > 0").join(base, ["file", "block"]).select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), F.col("tokens").alias("n_tokens"), F.lit(True).alias("ended"))
    return first.unionByName(inner).unionByName(open_end)


def token_counts(docs: DataFrame, *, where: str | None = None, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID, dtype: str = "<u2", block_tokens: int = 1 << 22) -> DataFrame:
    """Write token files and count each document's tokens in them: doc_id, n_tokens.

    A row per input row; null and empty texts have 0 tokens. Other columns are
    not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    where = where or fresh_dir(spark, "tokens")
    manifest = write_tokens(docs, where, id_col=id_col, text_col=text_col, path=path, end_id=end_id, dtype=dtype)
    counted = documents_of(spark, where, end_id=end_id, dtype=dtype, block_tokens=block_tokens)
    return manifest.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")
