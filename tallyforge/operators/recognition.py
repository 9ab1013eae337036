"""OCR of scanned pages as a Spark stage (S8, F14): a row a page, dealt over tasks, failures kept apart.

The engine is injected. A page whose first reading is short, or mid-sized with
few digits (a table read as prose), is read again with another segmentation of
the page; the longer text stays. Long pages are not read twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.stages import FAILURE, Stage


class Engine(Protocol):
    """Renders and reads one page; ``segmentation`` says how the page is laid out."""

    def recognize(self, path: str, page: int, languages: str, segmentation: int, resolution: int) -> str: ...


@dataclass(frozen=True)
class Reading:
    """How pages are read, and when once more."""

    languages: str = "rus+eng"
    resolution: int = 400
    segmentation: int = 6
    again: int | None = 4
    short_chars: int = 80
    enough_chars: int = 800
    digit_share: float = 0.05

    def needs_retry(self, text: str) -> bool:
        """F14."""
        s = text.strip()
        if len(s) < self.short_chars:
            return True
        return len(s) < self.enough_chars and sum(c.isdigit() for c in s) / len(s) < self.digit_share

    def read(self, engine: Engine, path: str, page: int) -> dict:
        text = engine.recognize(path, page, self.languages, self.segmentation, self.resolution) or ""
        if self.again is None or not self.needs_retry(text):
            return {"text": text, "retried": False, "won": False}
        second = engine.recognize(path, page, self.languages, self.again, self.resolution) or ""
        won = len(second.strip()) > len(text.strip())
        return {"text": second if won else text, "retried": True, "won": won}


PAGES = f"document_id string, page_number int, text string, retried boolean, won boolean, failure {FAILURE}"


def recognized(pages: DataFrame, engine: Callable[[], Engine], reading: Reading = Reading()) -> DataFrame:
    """Text of each page of ``pages`` (document_id, path, page_number): PAGES.

    Pages, not documents, are dealt over tasks, so one long scan is read by
    many; an engine is made once a task. A page that cannot be read, or whose
    path or number is null, has a failure and no text; the others go on.
    Repeated rows are read each time. Other columns are not read.
    """
    spark = pages.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[Engine] = []

        def read(path: str | None, page: int | None) -> dict:
            if path is None or page is None:
                raise ValueError("no path or page")
            if not own:
                own.append(engine())
            return reading.read(own[0], path, page)

        stage = Stage("ocr", ("path", "page_number"), "text string, retried boolean, won boolean", read)
        for batch in batches:
            rows = []
            for document, path, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                done = stage.attempt(path, page)
                result = done["result"] or {"text": None, "retried": None, "won": None}
                rows.append({"document_id": document, "page_number": page, **result, "failure": done["failure"]})
            for k in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[k : k + 64], schema=kind)

    kind = pa.schema([("document_id", pa.string()), ("page_number", pa.int32()), ("text", pa.string()), ("retried", pa.bool_()), ("won", pa.bool_()), ("failure", pa.struct([("stage", pa.string()), ("kind", pa.string()), ("message", pa.string())]))])
    # by number: rows of pages are small, so Spark would join them all into one task, but reading them is not
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(F.col("document_id").cast("string").alias("document_id"), "path", F.col("page_number").cast("int").alias("page_number"))
    return rows.repartition(tasks, "document_id", "page_number").mapInArrow(run, PAGES)


def counts(read: DataFrame) -> DataFrame:
    """Per document: pages, failed, retried, won, and the characters of its text."""
    return read.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("failure").isNotNull()).alias("failed"),
        F.count_if("retried").alias("retried"),
        F.count_if("won").alias("won"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"),
    )
