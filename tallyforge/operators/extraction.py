"""Model-assisted extraction: requests, a provider protocol, answers to metric rows, event fallbacks.

A provider is called in mapInPandas behind a table of answers keyed by the
request's digest, so that a retried task or a later run asks nothing twice.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import cache_key, in_unit
from tallyforge.operators.quality_rules import dedup_rows
from tallyforge.sources.repair import repaired_column


class Provider(Protocol):
    """Answers one prompt with JSON text; raises Unavailable when it cannot be reached."""

    def complete(self, prompt: str) -> str: ...


class Unavailable(RuntimeError):
    pass


class FixedProvider:
    """A deterministic provider for tests: numbers from the prompt's digest."""

    def complete(self, prompt: str) -> str:
        n = int.from_bytes(hashlib.sha256(prompt.encode()).digest()[:4], "big")
        if n % 17 == 0:
            raise Unavailable("HTTP 402: no credits")
        metrics = {"revenue": {"value": n % 1000 + 1.0, "source_quote": "q"}, "net_income": {"value": None if n % 3 == 0 else n % 77 - 5.0, "source_quote": None}}
        block = {"reporting_date": "2024-12-31", "period_type": "FY", "reporting_standard": "IFRS", "currency": "RUB", "unit": "thousands", "metrics": metrics}
        return json.dumps({"extractions": [block, {**block, "period_type": "H1"}]})


ANSWERS = "request_key string, answer string, error string, unavailable boolean"
RESULT = "extractions array<struct<reporting_date:string,period_type:string,reporting_standard:string,currency:string,unit:string,metrics:map<string,struct<value:double,source_quote:string>>>>"


def keyed(requests: DataFrame, *parts: str) -> DataFrame:
    """a digest of everything that shapes the answer."""
    return requests.withColumn("request_key", cache_key(*(F.col(p) for p in parts)))


def ask(requests: DataFrame, provider: Callable[[], Provider], known: DataFrame | None = None) -> DataFrame:
    """Answers of ``requests(request_key, prompt)`` that are not ``known``; W8: a failure is a row with its error."""
    new = requests.select("request_key", "prompt").dropDuplicates(["request_key"])
    if known is not None:
        new = new.join(known.select("request_key"), "request_key", "left_anti")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = provider()
        for p in parts:
            rows = []
            for key, prompt in zip(p["request_key"], p["prompt"], strict=True):
                try:
                    rows.append((key, model.complete(prompt), None, False))
                except Unavailable as e:
                    rows.append((key, None, str(e), True))
                except Exception as e:  # noqa: BLE001  one bad answer must not fail the stage
                    rows.append((key, None, str(e), False))
            yield pd.DataFrame(rows, columns=["request_key", "answer", "error", "unavailable"])

    return new.mapInPandas(run, ANSWERS)


def extracted_metrics(answers: DataFrame) -> DataFrame:
    """One row per metric of each answer; ``answers``: ticker, publication_id, expected_type, answer.

    Blocks of another period type than the publication's are comparative and
    dropped. Values are in ones. Of a key several times the last value stays.
    An answer that does not parse is repaired (F22); one beyond repair has no
    rows. Only answers that do not parse reach the repair, which is in Python;
    it reads brackets ``repair.DEEPEST`` deep, and deeper answers are beyond it.
    """
    keys = ["ticker", "publication_id", "expected_type"]
    read = answers.select(*keys, "answer", F.from_json("answer", RESULT)["extractions"].alias("found"))
    broken = read.where("found is null").select(*keys, repaired_column(F.col("answer")).alias("answer"))
    mended = broken.select(*keys, F.from_json("answer", RESULT)["extractions"].alias("found"))
    parsed = read.where("found is not null").select(*keys, "found").unionByName(mended)
    e = parsed.select(*keys, F.posexplode("found").alias("at", "x"))
    kept = e.where(F.col("expected_type").isNull() | (F.col("x.period_type") == F.col("expected_type")))
    m = kept.select("ticker", "publication_id", "x.reporting_date", "x.period_type", "x.reporting_standard", "x.currency", "x.unit", "at", F.explode("x.metrics").alias("metric_name", "item"))
    rows = m.withColumn("value", in_unit(F.col("item.value"), F.col("unit"), F.lit("ones"))).drop("item", "unit")
    return dedup_rows(rows, ("ticker", "publication_id", "reporting_date", "period_type", "reporting_standard", "metric_name"), "at")


def event_fields(event_type: Column, event_date: Column, publication_date: Column, summary: Column, params: Column, codes: tuple[str, ...], longest: int = 600) -> dict[str, Column]:
    """fallbacks of an extracted event."""
    return {
        "event_type": F.when(event_type.isin(*codes), event_type).otherwise("other"),
        "event_date": F.coalesce(F.nullif(event_date, F.lit("")), publication_date),
        "summary": F.left(F.coalesce(summary, F.lit("")), F.lit(longest)),
        "key_params_json": F.when(~F.coalesce(params, F.lit("")).isin("", "{}", "null"), params),
    }
