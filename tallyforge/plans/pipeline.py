"""The status-driven pipeline over publications: each stage reads its targets by status and returns new state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import documents, extraction, mart, quality_rules, state
from tallyforge.operators.extraction import Provider


@dataclass(frozen=True)
class State:
    publications: DataFrame
    documents: DataFrame
    metrics: DataFrame
    issues: DataFrame


#: status that a stage takes -> status that it leaves
ORDER = (("discovered", "downloaded"), ("downloaded", "unpacked"), ("unpacked", "classified"), ("classified", "extracted"))


def discover(s: State, found: DataFrame) -> State:
    """Found publications after each ticker's watermark are inserted; known ids stay as they are."""
    new = mart.incremental(found, mart.watermarks(found.select("ticker").distinct(), s.publications))
    return replace(s, publications=state.insert_new(s.publications, new, ("publication_id",), "seq"))


def advance(s: State) -> State:
    """The file stages; a publication without documents stops before classification."""
    has = s.documents.select("publication_id").distinct().withColumn("_has", F.lit(True))
    j = s.publications.join(has, "publication_id", "left")
    at = F.array_position(F.lit([a for a, _ in ORDER]), F.col("status"))
    moved = F.when(at > 0, F.when(F.col("_has"), "extracted").otherwise("skipped")).otherwise(F.col("status"))
    return replace(s, publications=j.withColumn("status", moved).select(*s.publications.columns))


def requests(s: State) -> DataFrame:
    """One request per extracted report: its preferred documents' names and standard."""
    targets = s.publications.where("status = 'extracted' and publication_type = 'report'")
    chosen = documents.preferred_standard(s.documents.join(targets.select("publication_id"), "publication_id", "left_semi"))
    per = chosen.groupBy("publication_id").agg(F.min("document_id").alias("document_id"), F.first("reporting_standard").alias("standard"), F.array_join(F.array_sort(F.collect_list("relative_path")), ",").alias("files"))
    j = targets.join(per, "publication_id")
    return extraction.keyed(j.withColumn("prompt", F.concat_ws("\n", "ticker", "standard", "files", "publication_id")), "prompt", "standard")


def extract(s: State, provider: Callable[[], Provider], known: DataFrame | None, store: Callable[[DataFrame], DataFrame]) -> tuple[State, DataFrame, DataFrame]:
    """(state, answers, unavailable ids). Answers are stored before use, so that a retry asks nothing again."""
    asked = store(requests(s))
    answers = store(extraction.ask(asked, provider, known))
    every = answers if known is None else known.unionByName(answers)
    joined = asked.join(every, "request_key").withColumn("expected_type", F.lit("FY"))
    rows = extraction.extracted_metrics(joined.where("answer is not null").select("ticker", "publication_id", "expected_type", "answer"))
    rows = rows.join(asked.select("publication_id", F.col("document_id").alias("source_document_id")), "publication_id")
    new = rows.select(
        F.md5(F.concat_ws("|", "ticker", "reporting_date", "period_type", "reporting_standard", "metric_name", "publication_id")).alias("metric_id"),
        "ticker", F.col("reporting_date").cast("date").alias("reporting_date"), "period_type", "reporting_standard", "metric_name", "value", "currency", F.lit("RUB").alias("unit"), "source_document_id",
    )
    done = joined.where("answer is not null").select("publication_id")
    metrics = store(state.replace_metrics(s.metrics, new, s.documents, done))
    away = store(joined.where("unavailable").select("publication_id"))
    failed = joined.where("answer is null and not unavailable").select("publication_id", F.lit("failed").alias("status"), F.col("error").alias("last_error"), F.lit(None).cast("string").alias("file_hash"))
    return replace(s, metrics=metrics, publications=state.mark_status(s.publications, failed)), answers, away


def validate(s: State, unavailable: DataFrame) -> State:
    """Rules over extracted reports (those whose model was away wait); issues are replaced, statuses set."""
    targets = s.publications.where("status = 'extracted' and publication_type = 'report'").join(unavailable, "publication_id", "left_anti").select("publication_id", "ticker")
    owned = s.documents.join(targets.select("publication_id"), "publication_id", "left_semi").select("publication_id", F.col("document_id").alias("source_document_id"))
    m = s.metrics.join(owned, "source_document_id")
    by = ("publication_id", "ticker")
    found = quality_rules.balance_mismatch(m, (*by, "reporting_date", "period_type", "reporting_standard")).select(*by, "code")
    found = found.unionByName(quality_rules.negative_signs(m, by).select(*by, "code"))
    yoy = quality_rules.suspicious_change(s.metrics).join(owned, "source_document_id").select(*by, F.lit("suspicious_yoy").alias("code"))
    found = found.unionByName(yoy).unionByName(quality_rules.mixed(m, "currency", "currency_mixed", by).select(*by, "code"))
    issues = found.distinct().withColumn("message", F.col("code"))
    status = targets.select("publication_id", F.lit("validated").alias("status"), F.lit(None).cast("string").alias("last_error"), F.lit(None).cast("string").alias("file_hash"))
    return replace(s, issues=state.replace_owned(s.issues, issues, targets, "publication_id"), publications=state.mark_status(s.publications, status))


def run(s: State, found: DataFrame, provider: Callable[[], Provider], store: Callable[[DataFrame], DataFrame], known: DataFrame | None = None, full_reload: str | None = None) -> tuple[State, DataFrame]:
    """A whole run; each stage's state is stored once, the driver moves no rows. Returns (state, new answers)."""
    if full_reload:
        s = replace(s, publications=state.reset_since(s.publications, full_reload))
    s = discover(s, found)
    s = advance(s)
    s = replace(s, publications=store(state.reset_unavailable(s.publications)))
    s, answers, away = extract(s, provider, known, store)
    s = validate(s, away)
    s = replace(s, publications=store(state.promote_validated(s.publications)))
    return replace(s, issues=store(state.failure_issues(s.publications, s.issues))), answers
