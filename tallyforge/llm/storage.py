"""Tables and files in the folder that driver and executors share.

The folder is the one named by ``spark.checkpoint.dir``; where that is unset
(tests on one machine) a folder below the warehouse is set for the session.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

from tallyforge.shared import filesystem, fresh_dir, session_dir, shared_dir, stored  # noqa: F401  used by the operators



def remove_intermediates(spark: SparkSession) -> None:
    """Delete what this application stored; only when no result is still to be read."""
    system, path = filesystem(session_dir(spark))
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_dir(path)


#: largest Arrow batch of texts that passes between Spark and Python
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_BYTES``, whatever the length of their texts.

    The default bounds rows; 10,000 long texts are hundreds of megabytes in
    each task, on both sides. A smaller setting of the session stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(key).rstrip("b"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for mapInArrow, after which the worker gives its free memory back.

    Workers are used again, and the C library keeps what was freed: without
    this each holds the largest of all its tasks for the rest of the job.
    """

    def held(batches: Batches) -> Batches:
        c = _c_library()
        if c is not None:
            c.mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD: large arrays are mapped, and unmapped when freed
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if c is not None:
                c.malloc_trim(0)

    return held


def _c_library():
    try:
        c = ctypes.CDLL(None)
        return c if hasattr(c, "malloc_trim") and hasattr(c, "mallopt") else None
    except OSError:
        return None


def publish(uri: str, write) -> None:
    """Write a file under a name of its own, then move it into place.

    A task that runs twice leaves one whole file with the same content.
    """
    system, path = filesystem(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.attempt"
    try:
        with system.open_output_stream(attempt) as out:
            write(out)
        system.move(attempt, path)
    except BaseException:
        if system.get_file_info(attempt).type != fs.FileType.NotFound:
            system.delete_file(attempt)
        raise
