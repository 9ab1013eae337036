"""The folder that driver and executors share, and file systems by URI."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder of ``spark.checkpoint.dir``, without a slash at its end.

    Where that is unset (tests on one machine) a folder below the warehouse is
    set for the session.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """The part of the shared folder that this application writes to."""
    return f"{shared_dir(spark)}/tallyforge-{spark.sparkContext.applicationId}"


def fresh_dir(spark: SparkSession, tag: str) -> str:
    return f"{session_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str, **options: object) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    This cuts the lineage, survives lost executors, and lets the next join
    shuffle both of its sides, so that Spark may split a skewed partition.
    """
    path = fresh_dir(df.sparkSession, tag)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a bare path is a local one."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


#: bytes of an Arrow batch that is sent to a Python worker
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_BYTES``; bounded by rows alone, they grow with the texts. A smaller bound stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(key).rstrip("b"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")
