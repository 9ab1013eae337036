"""Decisions of the control loop (C1-C12, J10-J13, W1): verdicts, canaries, picking, failure classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.state import GIVE_UP

EXCLUDED = 99
FAILED_VERDICTS = ("fail", "regression", "regression_tests", "regression_canary")


def signed(name: str, delta: Column) -> Column:
    return F.when(delta != 0, F.format_string(f"{name} %+d", delta))


def verdicts(before: DataFrame, after: DataFrame, least_metrics: int = 1) -> DataFrame:
    """One verdict per ticker of both snapshots (first rule that holds), with notes.

    Snapshots: ticker, publications_total, written, skipped, metrics_rows,
    qa_issues_count; ``after`` has the run's returncode too.
    """
    b = before.select("ticker", *(F.col(c).alias(f"b_{c}") for c in before.columns if c != "ticker"))
    j = after.join(b, "ticker")
    metrics = (F.col("metrics_rows") - F.col("b_metrics_rows")).cast("int")
    written = (F.col("written") - F.col("b_written")).cast("int")
    issues = (F.col("qa_issues_count") - F.col("b_qa_issues_count")).cast("int")
    clean = F.col("returncode") == 0
    had, has = F.col("b_publications_total"), F.col("publications_total")
    settled = clean & (had > 0) & (has > 0) & (F.col("metrics_rows") == 0) & (F.col("written") + F.col("skipped") == has)
    code = (
        F.when(~clean & (metrics == 0), "fail")
        .when((metrics < 0) | (written < 0), "regression")
        .when((metrics >= least_metrics) | (F.col("metrics_rows") >= least_metrics), "ok")
        .when(clean & (had == 0) & (has == 0), "ok")
        .when(settled, "ok")
        .otherwise("neutral")
    )
    notes = F.concat_ws("; ", signed("metrics", metrics), signed("publications.written", written), signed("qa_issues", issues), F.when(~clean, F.concat(F.lit("returncode="), F.col("returncode"))))
    return j.select("ticker", code.alias("code"), metrics.alias("metrics_delta"), written.alias("written_delta"), issues.alias("qa_delta"), notes.alias("notes"))


def worst(found: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Regression, then fail, then ok if all are, else neutral; nothing at all is fail."""
    def has(code: str) -> Column:
        return F.coalesce(F.bool_or(F.col("code") == code), F.lit(False))

    code = F.when(F.count("*") == 0, "fail").when(has("regression"), "regression").when(has("fail"), "fail").when(F.bool_and(F.col("code") == "ok"), "ok").otherwise("neutral")
    return found.groupBy(*by).agg(code.alias("code"))


def improved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Some ticker became ok and none regressed."""
    j = before.select("ticker", F.col("code").alias("b")).join(after.select("ticker", F.col("code").alias("a")), "ticker")
    return j.agg((F.coalesce(F.bool_or((F.col("b") != "ok") & (F.col("a") == "ok")), F.lit(False)) & F.coalesce(F.bool_and(F.col("a") != "regression"), F.lit(True))).alias("improved"))


def canaries(tickers: DataFrame, baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Counters of listed tickers must not fall; without a baseline a ticker passes with a note."""
    counters = ("publications_total", "metrics_rows", "written")
    b = baseline.select("ticker", *(F.col(c).alias(f"b_{c}") for c in counters), F.lit(True).alias("known"))
    j = tickers.join(b, "ticker", "left").join(current.select("ticker", *counters), "ticker", "left").na.fill(0, list(counters))
    falls = {c: F.coalesce(F.col(c) < F.col(f"b_{c}"), F.lit(False)) for c in counters}
    names = {"publications_total": "publications", "metrics_rows": "metrics", "written": "publications.written"}
    notes = [F.when(falls[c], F.concat(F.lit(f"{names[c]} "), F.col(f"b_{c}"), F.lit("→"), F.col(c))) for c in counters]
    missing = F.col("known").isNull()
    ok = missing | ~(falls["publications_total"] | falls["metrics_rows"] | falls["written"])
    return j.select("ticker", ok.alias("ok"), F.when(missing, F.concat("ticker", F.lit("_missing_in_baseline"))).otherwise(F.concat_ws("; ", *notes)).alias("notes"))


def latest_ticks(ticks: DataFrame) -> DataFrame:
    """The latest tick of each company, unfinished ones too; batches that are no JSON arrays are left out."""
    batch = F.from_json("batch_json", "array<struct<company_id:string>>")
    entries = ticks.select("tick_id", "verdict", "finished_at", F.explode(batch).alias("entry")).where("entry.company_id <> ''")
    best = entries.groupBy(F.col("entry.company_id").alias("company_id")).agg(F.max_by(F.struct("verdict", "finished_at", "tick_id"), "tick_id").alias("t"))
    return best.select("company_id", "t.verdict", "t.finished_at", "t.tick_id")


def priority(today: str, cooldown_days: int) -> Column:
    """C5 over company columns joined with reason, failure_count, verdict, finished_at."""
    finished = F.col("finished_at").try_cast("timestamp")
    limit = F.lit(today).cast("timestamp") - F.make_dt_interval(days=F.lit(cooldown_days))
    excluded = F.col("reason").isin("manual_blacklist", "moex_overlap") | ((F.col("reason") == "give_up") & (F.col("failure_count") >= GIVE_UP))
    return (
        F.when(F.coalesce(excluded, F.lit(False)), EXCLUDED)
        .when(F.col("verdict").isNull(), 0)
        .when(F.col("verdict").isin(*FAILED_VERDICTS), 1)
        .when((F.col("verdict") == "ok") & finished.isNotNull(), F.when(finished < limit, 2).otherwise(EXCLUDED))
        .otherwise(0)
    )


def ranked(companies: DataFrame, skiplist: DataFrame, ticks: DataFrame, today: str, cooldown_days: int = 7) -> DataFrame:
    """Each company with its priority."""
    j = companies.join(skiplist.select("company_id", "reason", "failure_count"), "company_id", "left").join(latest_ticks(ticks).drop("tick_id"), "company_id", "left")
    return j.select("company_id", "name", "type", priority(today, cooldown_days).alias("priority"))


def next_batch(companies: DataFrame, skiplist: DataFrame, ticks: DataFrame, overlap: DataFrame, today: str, size: int = 3, cooldown_days: int = 7) -> tuple[DataFrame, DataFrame]:
    """(batch, new skiplist). Overlapping companies enter the skiplist first; ids sort as strings."""
    new = companies.select("company_id").join(overlap.select("company_id"), "company_id", "left_semi").distinct().join(skiplist, "company_id", "left_anti")
    listed = skiplist.unionByName(new.select("company_id", F.lit("moex_overlap").alias("reason"), F.lit(0).alias("failure_count"), F.lit(None).cast("bigint").alias("last_tick_id")))
    batch = ranked(companies, listed, ticks, today, cooldown_days).where(F.col("priority") != EXCLUDED).orderBy("priority", "company_id").limit(max(0, size))
    return batch, listed


def failing(found: DataFrame, state: DataFrame) -> DataFrame:
    """Failed or regressed tickers, and neutral ones whose publications look stuck."""
    j = found.join(state, "ticker", "left")
    stuck = F.coalesce(F.col("llm_stuck") | F.col("no_publications") | F.col("written_no_metrics"), F.lit(True))
    return j.where(F.col("code").isin("fail", "regression") | ((F.col("code") == "neutral") & stuck)).select("ticker", "code")


def stuck_state(publications: DataFrame, metrics: DataFrame) -> DataFrame:
    """P15 per ticker: any failure with HTTP 402; none at all; all terminal without metrics."""
    n = metrics.groupBy("ticker").agg(F.count("*").alias("metrics"))
    per = publications.groupBy("ticker").agg(
        F.bool_or((F.col("status") == "failed") & F.coalesce(F.col("last_error").ilike("%http 402%"), F.lit(False))).alias("llm_stuck"),
        F.count("*").alias("publications"),
        F.bool_and(F.col("status").isin("written", "skipped")).alias("terminal"),
    )
    j = per.join(n, "ticker", "left")
    return j.select("ticker", "llm_stuck", (F.col("publications") == 0).alias("no_publications"), (F.col("terminal") & (F.coalesce("metrics", F.lit(0)) == 0)).alias("written_no_metrics"))


def log_signals(logs: DataFrame) -> DataFrame:
    """C7's inputs per ticker: what its own lines, and lines of its publications, say. One pass, pre-aggregated.

    Lines carry ``owner``, the ticker of their publication (J13), which may
    differ from ``ticker``.
    """
    def count(condition: str) -> Column:
        return F.count_if(F.coalesce(F.expr(condition), F.lit(False)))

    own = logs.where("ticker is not null").groupBy("ticker").agg(
        count("event = 'discoverer_non_200' AND status = 403").alias("n_403"),
        count("event = 'discoverer_no_publications_for_type'").alias("n_none"),
        count("event = 'discoverer_no_publications_for_type' AND status IN (404, 410)").alias("n_not_found"),
        count("event = 'ticker_type_discovered' AND found > 0").alias("n_found"),
        count("event = 'ticker_type_discovered' AND found > 0 AND coalesce(new, 0) <> 0").alias("n_new"),
        count("event = 'metric_extract_failed' AND contains(error, 'UNIQUE constraint')").alias("n_unique"),
        count("event = 'period_parser_unmatched' OR (event = 'discoverer_parse_warning' AND contains(lower(detail), 'reporting period'))").alias("n_period"),
    )
    of = logs.where("owner is not null").groupBy(F.col("owner").alias("ticker")).agg(
        count("event = 'publication_extracted'").alias("n_extracted"),
        count("startswith(event, 'metric_extract')").alias("n_metric"),
        count("event = 'metric_extract_llm_unavailable' AND contains(error, 'Argument list too long')").alias("n_too_long"),
        count("event = 'metric_extract_llm_unavailable'").alias("n_unavailable"),
    )
    return own.join(of, "ticker", "full_outer").na.fill(0)


def state_signals(publications: DataFrame, documents: DataFrame, metrics: DataFrame, issues: DataFrame) -> DataFrame:
    """C7's inputs per ticker from the stored state."""
    p = publications.groupBy("ticker").agg(
        F.count("*").alias("n_pubs"),
        F.count_if(F.col("status").isin("written", "skipped")).alias("n_terminal"),
        F.count_if((F.col("status") == "failed") & F.coalesce(F.contains("last_error", F.lit("HTTP 402")), F.lit(False))).alias("n_stuck"),
    )
    d = documents.groupBy("ticker").agg(
        F.count("*").alias("n_docs"),
        F.count_if(F.col("is_machine_readable") == 1).alias("n_readable"),
        F.count_if(F.col("reporting_standard") == "OTHER").alias("n_other"),
        F.count_if((F.col("page_count") > 0) & (F.col("text_pages_count") == 0)).alias("n_short"),
    )
    m = metrics.groupBy("ticker").agg(F.count("*").alias("n_metrics"))
    q = issues.groupBy("ticker").agg(F.count_if(F.col("code") == "incomplete").alias("n_incomplete"))
    return p.join(d, "ticker", "full_outer").join(m, "ticker", "full_outer").join(q, "ticker", "full_outer").na.fill(0)


def failure_classes(tickers: DataFrame, logs: DataFrame, state: DataFrame, returncode: int = 0) -> DataFrame:
    """The first class of the cascade that fits each ticker. Whole-log facts are one row, cross-joined."""
    whole = logs.agg(F.count("*").alias("n_log"), F.count_if(F.coalesce(F.expr("level = 'error' AND exc_type IS NOT NULL"), F.lit(False))).alias("n_crash"))
    j = tickers.join(log_signals(logs), "ticker", "left").join(state, "ticker", "left").na.fill(0).crossJoin(F.broadcast(whole))
    rules = [
        ("n_log = 0 AND n_pubs = 0 AND n_docs = 0", "cli_startup_error"),
        ("n_403 > 0", "discoverer_403_servicepipe"),
        ("n_none >= 4 AND n_not_found = n_none", "discoverer_id_not_found"),
        ("n_none >= 4", "discoverer_no_publications"),
        ("n_found > 0 AND n_new = 0 AND n_pubs = 0", "no_recent_publications"),
        ("n_unique > 0", "unique_constraint"),
        ("n_period > 0", "period_unparseable"),
        ("n_extracted > 0 AND n_metric = 0", "oom_kill" if returncode == -9 else "pipeline_timeout"),
        ("n_stuck > 0 AND n_metric = 0", "llm_failed_stuck"),
        ("n_too_long > 0", "llm_arg_too_long"),
        ("n_unavailable > 0", "llm_credits_exhausted"),
        ("n_pubs > 0 AND n_metrics = 0 AND n_terminal = n_pubs", "all_terminal_no_metrics"),
        ("n_incomplete > 0 AND n_metrics = 0", "metric_coverage_zero"),
        ("n_incomplete > 0", "metric_coverage_low"),
        ("n_metrics = 0 AND n_readable > 0", "metric_coverage_zero"),
        ("n_docs > 0 AND n_other = n_docs", "classifier_other"),
        ("n_docs > 0 AND n_short = n_docs", "extract_text_too_short"),
        ("n_crash > 0", "pipeline_crashed"),
    ]
    code = F.when(F.expr(rules[0][0]), rules[0][1])
    for condition, name in rules[1:]:
        code = code.when(F.expr(condition), name)
    return j.select("ticker", code.otherwise("unknown").alias("code"))


def owner_of(logs: DataFrame, publications: DataFrame, tickers: DataFrame) -> DataFrame:
    """The ticker of a line's publication, looked up where it is known, else the longest ticker that its id begins with.

    Candidates of an unknown id are its prefixes before each dash, an equi-join.
    """
    known = logs.join(publications.select("publication_id", F.col("ticker").alias("owner")), "publication_id", "left")
    rest = known.where("owner is null and publication_id is not null").select("seq", "publication_id")
    parts = F.split("publication_id", "-", -1)
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda k: F.array_join(F.slice(parts, 1, k), "-"))
    spread = rest.where(F.contains("publication_id", F.lit("-"))).select("seq", F.explode(prefixes).alias("ticker"))
    found = spread.join(tickers.select("ticker"), "ticker").groupBy("seq").agg(F.max_by("ticker", F.length("ticker")).alias("_owner"))
    return known.join(found, "seq", "left").withColumn("owner", F.coalesce("owner", "_owner")).drop("_owner")


def purgeable(ticks: DataFrame, cutoff: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Finished before ``cutoff`` as text, verdict not kept."""
    return ticks.where((F.col("finished_at") < cutoff) & ~F.coalesce(F.col("verdict").isin(*keep), F.lit(False))) if keep else ticks.where(F.col("finished_at") < cutoff)


def spent(ticks: DataFrame, day: str) -> DataFrame:
    """What a day's finished ticks cost."""
    return ticks.where(F.substring("finished_at", 1, 10) == day).agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("spent"))


def ranked_latest(df: DataFrame, by: str, order: Column, n: int) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("_rank") <= n).drop("_rank")
