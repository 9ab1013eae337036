"""Line formats: JSON logs (S4), model event streams (S21), the change log (S20), JSON inside text."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "event string, level string, ticker string, publication_id string, status string, detail string, error string, found string, new string, exc_type string"


def log_lines(lines: DataFrame, column: str = "value", schema: str = LOG) -> DataFrame:
    """Objects only; blank, malformed and other lines are left out."""
    text = F.regexp_replace(F.col(column), r"^\s+|\s+$", "")
    parsed = F.from_json(text, f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.where(text.startswith("{")).withColumn("_row", parsed).where("_row is not null and _row._bad is null")
    names = [f.split()[0] for f in schema.split(", ")]
    return rows.select(*(c for c in lines.columns if c != column), *(F.col("_row")[n].alias(n) for n in names))


STREAM = "type string, message struct<id:string,content:array<struct<type:string,text:string>>>, is_error boolean, result string, usage struct<input_tokens:bigint,output_tokens:bigint>"


def stream_answers(lines: DataFrame, by: str, seq: str) -> DataFrame:
    """Per stream the text of its last message, the number of messages, usage and a lasting error."""
    e = F.from_json("value", STREAM)
    rows = lines.select(by, seq, e.alias("e")).where("e.type in ('assistant', 'result')")
    text = F.array_join(F.transform(F.filter("e.message.content", lambda b: b["type"] == "text"), lambda b: b["text"]), "")
    message = F.when(F.col("e.type") == "assistant", F.col("e.message.id"))
    parts = rows.select(by, seq, message.alias("id"), text.alias("text"), "e.is_error", "e.result", "e.usage")
    # a message may come in several lines
    messages = parts.where("id is not null").groupBy(by, "id").agg(F.max(seq).alias("last"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(seq, F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"]), "").alias("text"))
    answers = messages.groupBy(by).agg(F.max_by("text", "last").alias("answer"), F.count("*").alias("messages"))
    results = parts.groupBy(by).agg(
        F.coalesce(F.bool_or("is_error"), F.lit(False)).alias("is_error"),
        F.coalesce(F.max_by("usage.input_tokens", F.when(F.col("usage.input_tokens").isNotNull(), F.col(seq))), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.max_by("usage.output_tokens", F.when(F.col("usage.output_tokens").isNotNull(), F.col(seq))), F.lit(0)).alias("output_tokens"),
    )
    return results.join(answers, by, "left").select(by, F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("messages", F.lit(0)).alias("messages"), "is_error", "input_tokens", "output_tokens")


#: fixed value: the heading of an entry, with tick, date and failure class
ENTRY = r"(?m)^###\s+evolve\((\d+)\)\s+—\s+\d{4}-\d{2}-\d{2}\s+—\s+([A-Za-z0-9_]+)\s*$"


def change_log_digest(text: Column, entry: str = ENTRY) -> Column:
    """struct(entries, last_tick, classes, anti_patterns) of a whole change log."""
    ticks = F.transform(F.regexp_extract_all(text, F.lit(entry), F.lit(1)), lambda t: t.try_cast("int"))
    section = F.regexp_extract(F.concat(text, F.lit("\n## .")), r"(?sm)^##\s+Anti-patterns\b(.*?)^##[^#]", 1)
    return F.struct(
        F.size(ticks).alias("entries"),
        F.array_max(ticks).alias("last_tick"),
        F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(entry), F.lit(2)))).alias("classes"),
        F.regexp_count(section, F.lit(r"(?m)^\s*[-*]\s+\S")).alias("anti_patterns"),
    )


def outer_object(text: str | None) -> str | None:
    """the first object of a text that parses; braces in strings do not count."""
    if not text:
        return None
    decoder, at = json.JSONDecoder(), text.find("{")
    while at >= 0:
        try:
            value, end = decoder.raw_decode(text, at)
        except (ValueError, RecursionError):
            at = text.find("{", at + 1)
            continue
        if isinstance(value, dict):
            return text[at:end]
        at = text.find("{", end)
    return None


def outer_object_column(text: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(outer_object)

    return run(text)


def issue_codes(text: Column) -> Column:
    """codes named in a text as ``code: X`` or ``code=X``, each once."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?iU)\bcode\s*[:=]\s*(\w+)"), F.lit(1))))
