"""State changes as pure functions: new state = f(old state, delta).

Parquet tables have no MERGE; each function is one or two equi-joins on the
table's key, and the caller writes the result as a new snapshot. Where a delta
may hold a key twice, the row of the largest ``seq`` wins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("discovered", "downloaded", "unpacked", "classified", "extracted", "validated", "written", "failed", "skipped")
METRIC_KEY = ("ticker", "reporting_date", "period_type", "reporting_standard", "metric_name")
#: failures are counted up to this number
GIVE_UP = 10


def latest(delta: DataFrame, key: tuple[str, ...], seq: str) -> DataFrame:
    """One row per key: that of the largest ``seq``; aggregated before the shuffle."""
    rest = [c for c in delta.columns if c not in key]
    best = delta.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_best"))
    return best.select(*key, *(F.col("_best")[c].alias(c) for c in rest)).select(*delta.columns)


def first(delta: DataFrame, key: tuple[str, ...], seq: str) -> DataFrame:
    rest = [c for c in delta.columns if c not in key]
    best = delta.groupBy(*key).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_best"))
    return best.select(*key, *(F.col("_best")[c].alias(c) for c in rest)).select(*delta.columns)


def insert_new(state: DataFrame, delta: DataFrame, key: tuple[str, ...], seq: str) -> DataFrame:
    """Rows with new keys are added, known keys are left as they are."""
    new = first(delta, key, seq).join(state.select(*key), list(key), "left_anti")
    return state.unionByName(new.select(*state.columns))


def inserted(state: DataFrame, delta: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """D1's answer for each delta key: whether it was inserted."""
    known = state.select(*key).distinct().withColumn("_known", F.lit(True))
    return delta.select(*key).distinct().join(known, list(key), "left").select(*key, F.col("_known").isNull().alias("inserted"))


def upsert(state: DataFrame, delta: DataFrame, key: tuple[str, ...], seq: str, preserve: tuple[str, ...] = ()) -> DataFrame:
    """The delta's values win, columns in ``preserve`` keep the old one."""
    new = latest(delta, key, seq)
    given = set(new.columns)
    changed = new.select(*key, *(F.col(c).alias(f"_new_{c}") for c in state.columns if c in given and c not in key), F.lit(True).alias("_given"))
    known = state.withColumn("_old", F.lit(True))
    joined = known.join(changed, list(key), "full_outer")

    def value(c: str) -> Column:
        if c in key:
            return F.col(c)
        if c not in given:
            return F.col(c)
        old_wins = F.col("_given").isNull() | (F.col("_old").isNotNull() if c in preserve else F.lit(False))
        return F.when(old_wins, F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c)

    return joined.select(*(value(c) for c in state.columns))


def update_given(state: DataFrame, delta: DataFrame, key: tuple[str, ...], columns: tuple[str, ...], keep_when_null: tuple[str, ...] = ()) -> DataFrame:
    """Set ``columns`` of known keys; those in ``keep_when_null`` only if given."""
    changed = delta.select(*key, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_given"))
    joined = state.join(changed, list(key), "left")

    def value(c: str) -> Column:
        if c not in columns:
            return F.col(c)
        new = F.coalesce(F.col(f"_new_{c}"), F.col(c)) if c in keep_when_null else F.col(f"_new_{c}")
        return F.when(F.col("_given"), new).otherwise(F.col(c)).alias(c)

    return joined.select(*(value(c) for c in state.columns))


def mark_status(publications: DataFrame, delta: DataFrame) -> DataFrame:
    """Status, and last_error even if null; file_hash only if given. Unknown statuses raise."""
    known = F.when(F.col("status").isin(*STATUSES), F.col("status")).otherwise(F.raise_error(F.concat(F.lit("unknown status: "), F.coalesce("status", F.lit("null"))))).cast("string")
    return update_given(publications, delta.withColumn("status", known), ("publication_id",), ("status", "last_error", "file_hash"), ("file_hash",))


def set_where(state: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Conditional update without a join."""
    return state.select(*(F.when(condition, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in state.columns))


def reset_since(publications: DataFrame, cutoff: str) -> DataFrame:
    """All publications from ``cutoff`` on are discovered again, whatever their ticker."""
    since = F.col("publication_date") >= F.lit(cutoff).cast("date")
    return set_where(publications, since, status=F.lit("discovered"), last_error=F.lit(None).cast("string"))


def reset_unavailable(publications: DataFrame) -> DataFrame:
    """Failures with HTTP 402 in any case of letters are extracted again."""
    failed = (F.col("status") == "failed") & F.coalesce(F.col("last_error").ilike("%HTTP 402%"), F.lit(False))
    return set_where(publications, failed, status=F.lit("extracted"), last_error=F.lit(None).cast("string"))


def promote_validated(publications: DataFrame) -> DataFrame:
    """D17."""
    return set_where(publications, F.col("status") == "validated", status=F.lit("written"))


def replace_owned(state: DataFrame, delta: DataFrame, processed: DataFrame, owner: str) -> DataFrame:
    """Drop the rows of every processed owner, then add the delta (an empty one clears)."""
    return state.join(processed.select(owner).distinct(), owner, "left_anti").unionByName(delta.select(*state.columns))


def not_sourced(rows: DataFrame, documents: DataFrame, publication_ids: DataFrame) -> DataFrame:
    """Rows whose source is no document of the publications; those without a source stay."""
    gone = documents.join(publication_ids.select("publication_id").distinct(), "publication_id", "left_semi").select(F.col("document_id").alias("source_document_id")).distinct()
    return rows.join(gone, "source_document_id", "left_anti").select(*rows.columns)


def _winners(delta: DataFrame) -> DataFrame:
    return latest(delta, METRIC_KEY, "_seq" if "_seq" in delta.columns else "metric_id")


def replace_metrics(metrics: DataFrame, delta: DataFrame, documents: DataFrame, publication_ids: DataFrame) -> DataFrame:
    """Drop metrics sourced from the publications' documents, then insert or replace by key.

    A key of the delta takes over the row of another publication; within the
    delta the largest ``_seq`` (or metric_id) wins.
    """
    kept = not_sourced(metrics, documents, publication_ids)
    new = _winners(delta).select(*metrics.columns)
    return kept.join(new.select(*METRIC_KEY), list(METRIC_KEY), "left_anti").select(*metrics.columns).unionByName(new)


def replace_of_periods(periods: DataFrame, spread: Callable[[DataFrame, str], DataFrame], delta: DataFrame, documents: DataFrame, publication_ids: DataFrame) -> DataFrame:
    """D9 as ``replace_metrics``, where ``spread`` makes metrics of a row a period and carries a column along.

    Joins are of periods: each meets the names of its metrics that the delta
    replaces, and metrics are made of what is left.
    """
    period = [c for c in METRIC_KEY if c != "metric_name"]
    new = _winners(delta)
    names = new.groupBy(*period).agg(F.collect_set("metric_name").alias("_replaced"))
    kept = not_sourced(periods.join(names, period, "left"), documents, publication_ids)
    metrics = spread(kept, "_replaced").where(~F.coalesce(F.array_contains("_replaced", F.col("metric_name")), F.lit(False))).drop("_replaced")
    return metrics.unionByName(new.select(*metrics.columns))


def bump_failures(skiplist: DataFrame, failures: DataFrame) -> DataFrame:
    """Count failures up to GIVE_UP; manual and overlap entries keep their reason.

    ``failures``: company_id, tick_id; each row is one failure.
    """
    n = failures.groupBy("company_id").agg(F.count("*").cast("int").alias("_n"), F.max("tick_id").alias("_tick"))
    joined = skiplist.join(n, "company_id", "full_outer")
    bumped = F.col("_n").isNotNull()
    old = F.coalesce("failure_count", F.lit(0))
    count = F.when(bumped, F.least(old + F.col("_n"), F.lit(GIVE_UP))).otherwise(F.col("failure_count"))
    keeps = F.coalesce(F.col("reason").isin("manual_blacklist", "moex_overlap"), F.lit(False)) | ~bumped
    return joined.select("company_id", F.when(keeps, F.col("reason")).otherwise("give_up").alias("reason"), count.cast("int").alias("failure_count"), F.coalesce("_tick", "last_tick_id").alias("last_tick_id"))


def blacklist(skiplist: DataFrame, ids: DataFrame) -> DataFrame:
    """Manual entries replace others but keep their count and last tick."""
    given = ids.select("company_id").distinct().withColumn("_given", F.lit(True))
    joined = skiplist.join(given, "company_id", "full_outer")
    return joined.select("company_id", F.when(F.col("_given"), "manual_blacklist").otherwise(F.col("reason")).alias("reason"), F.coalesce("failure_count", F.lit(0)).alias("failure_count"), "last_tick_id")


def reset_skiplist(skiplist: DataFrame, ids: DataFrame) -> DataFrame:
    """Delete."""
    return skiplist.join(ids.select("company_id").distinct(), "company_id", "left_anti")


def failure_issues(publications: DataFrame, issues: DataFrame) -> DataFrame:
    """Every failed publication's issues are replaced by one publication_failed."""
    failed = publications.where(F.col("status") == "failed")
    new = failed.select("publication_id", "ticker", F.lit("publication_failed").alias("code"), F.coalesce("last_error", F.lit("unknown error")).alias("message"))
    kept = issues.join(failed.select("publication_id"), "publication_id", "left_anti").select("publication_id", "ticker", "code", "message")
    return kept.unionByName(new)


def journal(runs: DataFrame, finished: DataFrame) -> DataFrame:
    """Append runs are unions; finishing sets what is given."""
    return update_given(runs, finished, ("run_id",), ("status", "finished_at", "error_summary"))


def snapshots(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
