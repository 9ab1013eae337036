"""Export mart, snapshots and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def metric_sheet(metrics: DataFrame, documents: DataFrame, publications: DataFrame) -> DataFrame:
    """Metrics with their document and publication; those without a document are not exported.

    Where metrics are made of rows that share a source, those rows may be given instead and spread afterwards.
    """
    d = documents.select("document_id", "publication_id", "relative_path")
    p = publications.select("publication_id", "publication_date", "is_incomplete")
    return metrics.join(d, metrics["source_document_id"] == d["document_id"]).drop("document_id").join(p, "publication_id")


#: The sheet's order, with tie-breakers
SHEET_ORDER = ("ticker", "reporting_date", "period_type", "metric_name", "reporting_standard", "metric_id")


def ticker_sheet(stored: DataFrame, configured: DataFrame) -> DataFrame:
    """Stored tickers with their configured profile, and configured ones not stored yet."""
    c = configured.select("ticker", F.col("profile").alias("_profile"), F.col("name").alias("_name"), F.lit(True).alias("configured"))
    j = stored.select("ticker", "name", F.lit(True).alias("in_state")).join(c, "ticker", "full_outer")
    return j.select("ticker", F.coalesce("name", "_name").alias("name"), F.coalesce("_profile", F.lit("non_bank")).alias("profile"), F.coalesce("in_state", F.lit(False)).alias("in_state"), F.coalesce("configured", F.lit(False)).alias("configured"))


def number_format(value: Column) -> Column:
    """K2."""
    return F.when(value.isNull(), None).when(value == F.floor(value), "#,##0").otherwise("#,##0.##")


def column_widths(sheet: DataFrame, columns: list[str]) -> DataFrame:
    """K3: width of each column from its longest value or its name, within 12 and 60."""
    longest = [F.max(F.length(F.col(c).cast("string"))).alias(c) for c in columns]
    wide = sheet.agg(*longest)
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.greatest(F.coalesce(c, F.lit(0)), F.lit(len(c))).alias("n")) for c in columns)))
    one = wide.select(pairs.alias("x"))
    return one.select("x.column", F.least(F.greatest(F.lit(10), F.col("x.n")) + 2, F.lit(60)).alias("width"))


def counts_map(df: DataFrame, key: str, by: str = "ticker") -> DataFrame:
    """A1-A3: a map of counts per value of ``key``."""
    n = df.groupBy(by, key).agg(F.count("*").alias("n"))
    return n.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("counts"))


def snapshot(tickers: DataFrame, publications: DataFrame, documents: DataFrame, metrics: DataFrame, issues: DataFrame) -> DataFrame:
    """A5: one row per requested ticker, zeros and empty maps for unknown ones."""
    dates = publications.groupBy("ticker").agg(F.count("*").alias("publications_total"), F.max("publication_date").alias("last_publication_date"))
    docs = documents.groupBy("ticker").agg(F.count("*").alias("documents_total"))
    rows = metrics.groupBy("ticker").agg(F.count("*").alias("metrics_rows"))
    qa = issues.groupBy("ticker").agg(F.count("*").alias("qa_issues_count"))
    maps = {"publications_by_status": (publications, "status"), "metrics_by_standard": (metrics, "reporting_standard"), "qa_issues_codes": (issues, "code")}
    out = tickers.select("ticker").distinct()
    for part in (dates, docs, rows, qa):
        out = out.join(part, "ticker", "left")
    for name, (df, key) in maps.items():
        out = out.join(counts_map(df, key).withColumnRenamed("counts", name), "ticker", "left")
    numbers = ("publications_total", "documents_total", "metrics_rows", "qa_issues_count")
    empty = F.create_map().cast("map<string,bigint>")
    return out.select("ticker", *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers), "last_publication_date", *(F.coalesce(m, empty).alias(m) for m in maps))


def watermarks(tickers: DataFrame, publications: DataFrame, bootstrap: str = "1900-01-01") -> DataFrame:
    """The last publication date of each ticker; a new one begins at ``bootstrap``."""
    last = publications.groupBy("ticker").agg(F.max("publication_date").alias("cutoff"))
    return tickers.select("ticker").join(last, "ticker", "left").select("ticker", F.coalesce("cutoff", F.lit(bootstrap).cast("date")).alias("cutoff"))


def incremental(found: DataFrame, marks: DataFrame, lookback_days: int = 0) -> DataFrame:
    """Strictly after the watermark; ``lookback_days`` moves it back."""
    j = found.join(marks, "ticker")
    return j.where(F.col("publication_date") > F.date_sub("cutoff", lookback_days)).select(*found.columns)


def status_counts(publications: DataFrame) -> DataFrame:
    """Per status, with incomplete ones counted in addition."""
    tags = F.filter(F.array("status", F.when(F.col("is_incomplete") == 1, "incomplete")), lambda x: x.isNotNull())
    return publications.select(F.explode(tags).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


def run_stats(publications: DataFrame, metrics: DataFrame, events: DataFrame) -> DataFrame:
    """Totals as one row."""
    p = publications.agg(F.count("*").alias("publications"), F.count_if(F.col("is_incomplete") == 1).alias("incomplete"), F.count_if(F.col("status") == "written").alias("written"))
    return p.crossJoin(metrics.agg(F.count("*").alias("metrics"))).crossJoin(events.agg(F.count("*").alias("events")))


def classifier_counts(documents: DataFrame) -> DataFrame:
    """Per publication its documents, readable and scanned ones, and by standard."""
    def n(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    standards = {s.lower(): n(F.col("reporting_standard") == s) for s in ("IFRS", "RSBU", "ISSUER", "OTHER")}
    return documents.groupBy("publication_id").agg(F.count("*").alias("documents"), n(F.col("is_machine_readable") == 1).alias("readable"), n(F.col("is_machine_readable") == 0).alias("scanned"), *(c.alias(k) for k, c in standards.items()))


def tick_report(ticks: DataFrame, since: str, most: int = 2000) -> DataFrame:
    """A10: per verdict (none yet: running) the latest ticks' number, cost, and mean cost."""
    latest = ticks.orderBy(F.desc("tick_id")).limit(most).where(F.col("day") >= F.lit(since).cast("date"))
    return latest.groupBy(F.coalesce("verdict", F.lit("running")).alias("verdict")).agg(F.count("*").alias("n"), F.sum("cost").alias("cost"), F.avg("cost").alias("mean_cost"))


def probe_status(http: Column, has_table: Column, has_row: Column) -> Column:
    """P14."""
    return F.when(http.isin(404, 410), "MISSING").when(http != 200, "ERROR").when(~has_table, "MISSING").when(~has_row, "EMPTY").otherwise("OK")


def probe_matrix(probes: DataFrame) -> DataFrame:
    """A row per ticker, a column per report type, and whether type 3, 4 or 5 is OK."""
    wide = probes.groupBy("ticker").pivot("type", [2, 3, 4, 5]).agg(F.max("status"))
    named = wide.select("ticker", *(F.col(str(t)).alias(f"type_{t}") for t in (2, 3, 4, 5)))
    return named.withColumn("passes", F.coalesce(F.greatest(*(F.col(f"type_{t}") == "OK" for t in (3, 4, 5))), F.lit(False)))


def probe_summary(matrix: DataFrame) -> DataFrame:
    """A18."""
    return matrix.agg(F.count_if("passes").alias("passing"), F.count("*").alias("total"))


def capped_errors(logs: DataFrame, most: int) -> DataFrame:
    """K7: error lines up to a total of characters."""
    before = F.sum(F.length("line")).over(Window.partitionBy("ticker").orderBy("seq"))
    return logs.where("level = 'error'").withColumn("total", before).where(F.col("total") <= most).drop("total")


def tail_lines(logs: DataFrame, n: int) -> DataFrame:
    """K7: the last ``n`` lines; a top-k, nothing is sorted whole."""
    return logs.orderBy(F.desc("seq")).limit(n)
