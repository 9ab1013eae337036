"""Domain tables (tickers, publications, documents, metrics, logs, ticks ...)
derived from the provided tables, as DataFrames and as SQL for the oracles.

The text of a view is common to both engines, except where a pair is given
(Spark, oracle). ``{name}`` stands for another view or a provided table.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_LINE_KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE), CAST(round(l_extendedprice * 100) AS BIGINT), CAST(l_quantity AS BIGINT)"

#: a period's sums as its metrics: columns, and the rows to multiply with
_METRIC_COLUMNS = """
        SELECT md5(concat_ws('|', ticker, reporting_date, period_type, reporting_standard, metric_name)) AS metric_id, ticker, reporting_date, period_type, reporting_standard, metric_name,
               CASE metric_name
                 WHEN 'revenue' THEN CASE WHEN k % 17 = 0 THEN -1 ELSE 1 END * CAST(net AS DOUBLE) / CAST(10000 AS DOUBLE)
                 WHEN 'net_income' THEN CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(net AS DOUBLE) / CAST(100000 AS DOUBLE) END
                 WHEN 'total_assets' THEN CASE WHEN k % 23 = 0 THEN -1 ELSE 1 END * CAST(gross AS DOUBLE) / CAST(100 AS DOUBLE)
                 WHEN 'total_equity' THEN CAST(gross AS DOUBLE) * CAST(4 AS DOUBLE) / CAST(1000 AS DOUBLE)
                 ELSE CAST(gross AS DOUBLE) * CAST(CASE WHEN k % 6 = 0 THEN 7 ELSE 6 END AS DOUBLE) / CAST(1000 AS DOUBLE) END AS value,
               CASE WHEN k % 13 = 0 AND metric_name = 'revenue' THEN 'USD' ELSE 'RUB' END AS currency,
               CASE WHEN k % 11 = 0 AND metric_name = 'total_assets' THEN 'thousands' ELSE 'RUB' END AS unit,
               CASE WHEN k % 29 = 0 THEN NULL ELSE source_document_id END AS source_document_id"""
_METRIC_NAMES = """CROSS JOIN (VALUES ('revenue'), ('net_income'), ('total_assets'), ('total_equity'), ('total_liabilities')) AS m(metric_name)
        WHERE NOT (k % 19 = 0 AND metric_name = 'total_liabilities')"""

VIEWS: dict[str, str | tuple[str, str]] = {
    "tickers": """
        SELECT concat('EDX', c_custkey) AS ticker, CAST(c_custkey AS STRING) AS e_disclosure_id, c_name AS name,
               CASE WHEN c_custkey % 4 = 0 THEN 'bank' ELSE 'non_bank' END AS profile, c_custkey % 10 = 3 AS use_vision
        FROM {customer}""",
    "publications": """
        SELECT concat('EDX', o_custkey, '-', 2 + o_orderkey % 4, '-', o_orderkey) AS publication_id, concat('EDX', o_custkey) AS ticker,
               CASE WHEN o_orderkey % 7 = 0 THEN 'event' ELSE 'report' END AS publication_type, CAST(o_orderdate AS DATE) AS publication_date,
               concat('h', o_orderkey % 1000) AS file_hash,
               CASE o_orderkey % 11 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped' WHEN 2 THEN 'discovered' WHEN 3 THEN 'downloaded' WHEN 4 THEN 'unpacked'
                    WHEN 5 THEN 'classified' WHEN 6 THEN 'extracted' WHEN 7 THEN 'validated' ELSE 'written' END AS status,
               CASE WHEN o_orderkey % 11 = 0 THEN CASE o_orderkey % 3 WHEN 0 THEN 'llm: http 402 payment required' WHEN 1 THEN 'timeout' END END AS last_error,
               CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS is_incomplete, CAST(2 + o_orderkey % 4 AS INT) AS report_type_code,
               CAST(year(o_orderdate) AS INT) AS reporting_period_year, concat('Q', quarter(o_orderdate)) AS reporting_period_type, o_orderkey AS seq
        FROM {orders}""",
    "filings": f"""
        SELECT md5(concat_ws('|', {_LINE_KEY})) AS document_id, publication_id, ticker, publication_date,
               concat('files/', l_linenumber, CASE l_partkey % 5 WHEN 0 THEN '.PDF' WHEN 1 THEN '.pdf' WHEN 2 THEN '.rtf' WHEN 3 THEN '.html' ELSE '.zip' END) AS relative_path,
               CASE l_partkey % 7 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/rtf' WHEN 2 THEN 'text/html' END AS mime_type,
               concat('f', l_partkey % 500) AS file_hash,
               CASE l_returnflag WHEN 'A' THEN 'IFRS' WHEN 'N' THEN 'RSBU' ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'ISSUER' ELSE 'OTHER' END END AS reporting_standard,
               CASE WHEN l_partkey % 9 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_machine_readable,
               CAST(l_quantity AS INT) - 1 AS page_count, CAST(least(l_linenumber, l_quantity - 1) AS INT) AS scan_pages_count,
               CAST(l_quantity - 1 - least(l_linenumber, l_quantity - 1) AS INT) AS text_pages_count, l_linenumber AS line
        FROM {{lineitem}} JOIN {{publications}} ON l_orderkey = seq""",
    # in Spark the lines of an order are summed before they meet it, most of them in the task that reads them
    "period_sums": (
        f"""
        SELECT concat('EDX', o_custkey) AS ticker,
               CAST(concat(year(o_orderdate), CASE quarter(o_orderdate) WHEN 1 THEN '-03-31' WHEN 2 THEN '-06-30' WHEN 3 THEN '-09-30' ELSE '-12-31' END) AS DATE) AS reporting_date,
               concat('Q', quarter(o_orderdate)) AS period_type, CASE o_orderkey % 3 WHEN 0 THEN 'IFRS' WHEN 1 THEN 'RSBU' ELSE 'ISSUER' END AS reporting_standard,
               max(o_custkey + year(o_orderdate) * 4 + quarter(o_orderdate) + o_orderkey % 3) AS k,
               CAST(sum(net) AS BIGINT) AS net, CAST(sum(gross) AS BIGINT) AS gross, max(source_document_id) AS source_document_id
        FROM (SELECT l_orderkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round((1 - l_discount) * 100) AS BIGINT)) AS net,
                     sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS gross, max(md5(concat_ws('|', {_LINE_KEY}))) AS source_document_id
              FROM {{lineitem}} GROUP BY l_orderkey) x
        JOIN {{orders}} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""",
        f"""
        SELECT concat('EDX', o_custkey) AS ticker,
               CAST(concat(year(o_orderdate), CASE quarter(o_orderdate) WHEN 1 THEN '-03-31' WHEN 2 THEN '-06-30' WHEN 3 THEN '-09-30' ELSE '-12-31' END) AS DATE) AS reporting_date,
               concat('Q', quarter(o_orderdate)) AS period_type, CASE o_orderkey % 3 WHEN 0 THEN 'IFRS' WHEN 1 THEN 'RSBU' ELSE 'ISSUER' END AS reporting_standard,
               max(o_custkey + year(o_orderdate) * 4 + quarter(o_orderdate) + o_orderkey % 3) AS k,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round((1 - l_discount) * 100) AS BIGINT)) AS BIGINT) AS net,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS gross,
               max(md5(concat_ws('|', {_LINE_KEY}))) AS source_document_id
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""",
    ),
    "metrics": f"{_METRIC_COLUMNS}\n        FROM {{period_sums}} {_METRIC_NAMES}",
    "disclosures": """
        SELECT seq AS event_id, ticker, publication_date AS event_date, publication_date, CASE seq % 3 WHEN 0 THEN 'dividends' WHEN 1 THEN 'management_change' ELSE 'rumour' END AS event_type,
               concat('event ', seq) AS summary, CASE WHEN seq % 2 = 0 THEN concat('{"per_share_rub":', seq % 50, '}') END AS key_params_json, publication_id AS source_publication_id
        FROM {publications} WHERE publication_type = 'event'""",
    "qa_issues": """
        SELECT seq AS issue_id, publication_id, ticker, CASE seq % 4 WHEN 0 THEN 'incomplete' WHEN 1 THEN 'balance_mismatch' WHEN 2 THEN 'suspicious_yoy' ELSE 'currency_mixed' END AS code,
               concat('issue ', seq) AS message, publication_date AS created_at
        FROM {publications} WHERE seq % 3 = 0""",
    "logs": """
        SELECT event_id AS seq, concat('EDX', user_id) AS ticker, ts,
               CASE event_id % 16 WHEN 0 THEN 'discoverer_non_200' WHEN 1 THEN 'discoverer_no_publications_for_type' WHEN 2 THEN 'ticker_type_discovered' WHEN 3 THEN 'metric_extract_failed'
                    WHEN 4 THEN 'discoverer_parse_warning' WHEN 5 THEN 'publication_extracted' WHEN 6 THEN 'metric_extract_llm_unavailable' ELSE 'heartbeat' END AS event,
               CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END AS level,
               CAST(CASE user_id % 5 WHEN 0 THEN 404 WHEN 1 THEN CASE WHEN event_id % 2 = 0 THEN 403 ELSE 410 END ELSE 200 END AS INT) AS status,
               CAST(user_id % 3 AS INT) AS found, CAST(CASE WHEN user_id % 6 = 1 THEN 0 ELSE 1 END AS INT) AS new,
               CASE WHEN user_id % 4 = 2 THEN 'UNIQUE constraint failed' WHEN user_id % 4 = 3 THEN 'Argument list too long' ELSE 'other' END AS error,
               CASE WHEN user_id % 8 = 3 THEN 'bad Reporting Period label' ELSE 'row with only 3 cells' END AS detail,
               concat('EDX', user_id, '-3-', event_id) AS publication_id, CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'ValueError' END AS exc_type
        FROM {events}""",
    "ticks": (
        """
        SELECT CAST((year(ts) * 10000 + month(ts) * 100 + day(ts)) * 100 + user_id % 16 AS BIGINT) AS tick_id, CAST(ts AS DATE) AS day, concat(CAST(CAST(ts AS DATE) AS STRING), 'T12:00:00+00:00') AS finished_at,
               CASE (day(ts) + user_id % 16) % 7 WHEN 0 THEN NULL WHEN 1 THEN 'ok' WHEN 2 THEN 'fail' WHEN 3 THEN 'regression' WHEN 4 THEN 'neutral' ELSE 'ok' END AS verdict,
               CAST(day(ts) AS DOUBLE) / CAST(4 AS DOUBLE) AS cost,
               concat('[', array_join(array_sort(collect_set(concat('{"company_id":"', user_id, '","ticker":"EDX', user_id, '"}'))), ','), ']') AS batch_json
        FROM {events} GROUP BY 1, 2, 3, 4, 5""",
        """
        SELECT CAST((year(ts) * 10000 + month(ts) * 100 + day(ts)) * 100 + user_id % 16 AS BIGINT) AS tick_id, CAST(ts AS DATE) AS day, concat(CAST(CAST(ts AS DATE) AS STRING), 'T12:00:00+00:00') AS finished_at,
               CASE (day(ts) + user_id % 16) % 7 WHEN 0 THEN NULL WHEN 1 THEN 'ok' WHEN 2 THEN 'fail' WHEN 3 THEN 'regression' WHEN 4 THEN 'neutral' ELSE 'ok' END AS verdict,
               CAST(day(ts) AS DOUBLE) / CAST(4 AS DOUBLE) AS cost,
               concat('[', array_to_string(list_sort(list(DISTINCT concat('{"company_id":"', user_id, '","ticker":"EDX', user_id, '"}'))), ','), ']') AS batch_json
        FROM {events} GROUP BY 1, 2, 3, 4, 5""",
    ),
    "companies": "SELECT CAST(c_custkey AS STRING) AS company_id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN 'bank' ELSE 'non_bank' END AS type FROM {customer}",
    "skiplist": """
        SELECT CAST(c_custkey AS STRING) AS company_id, CASE c_custkey % 3 WHEN 0 THEN 'give_up' WHEN 1 THEN 'manual_blacklist' ELSE 'moex_overlap' END AS reason,
               CAST(c_custkey % 14 AS INT) AS failure_count, CAST(NULL AS BIGINT) AS last_tick_id
        FROM {customer} WHERE c_custkey % 9 = 0""",
    "discovered": """
        SELECT concat('EDX', o_custkey, '-', 2 + o_orderkey % 4, '-', CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE o_orderkey + 1000000000 END) AS publication_id, concat('EDX', o_custkey) AS ticker,
               'report' AS publication_type, CAST(o_orderdate AS DATE) AS publication_date, 'new' AS file_hash, 'discovered' AS status, CAST(NULL AS STRING) AS last_error, 0 AS is_incomplete,
               CAST(2 + o_orderkey % 4 AS INT) AS report_type_code, CAST(year(o_orderdate) AS INT) AS reporting_period_year, concat('Q', quarter(o_orderdate)) AS reporting_period_type, o_orderkey AS seq
        FROM {orders} WHERE o_orderkey % 6 < 2""",
    "metric_delta": (
        f"""
        SELECT concat('new-', metric_id) AS metric_id, ticker, reporting_date, period_type, reporting_standard, metric_name, value + 1 AS value, currency, unit, d.document_id AS source_document_id
        FROM {{metrics}} JOIN (
            SELECT ticker AS t, max(document_id) AS document_id FROM (SELECT l_orderkey, max(md5(concat_ws('|', {_LINE_KEY}))) AS document_id FROM {{lineitem}} GROUP BY l_orderkey) x
            JOIN {{publications}} ON l_orderkey = seq GROUP BY ticker) d ON ticker = t WHERE metric_name = 'revenue' AND period_type = 'Q1'""",
        """
        SELECT concat('new-', metric_id) AS metric_id, ticker, reporting_date, period_type, reporting_standard, metric_name, value + 1 AS value, currency, unit, d.document_id AS source_document_id
        FROM {metrics} JOIN (SELECT ticker AS t, max(document_id) AS document_id FROM {filings} GROUP BY ticker) d ON ticker = t WHERE metric_name = 'revenue' AND period_type = 'Q1'""",
    ),
    "before": "SELECT ticker, 5 AS publications_total, 2 AS written, 0 AS skipped, CAST(seq % 4 AS INT) AS metrics_rows, 1 AS qa_issues_count FROM (SELECT ticker, min(seq) AS seq FROM {publications} GROUP BY ticker) x",
    "after": """SELECT ticker, CAST(CASE WHEN seq % 5 = 0 THEN 0 ELSE 5 END AS INT) AS publications_total, CAST(CASE WHEN seq % 3 = 0 THEN 5 ELSE seq % 4 END AS INT) AS written, 0 AS skipped,
               CAST(CASE WHEN seq % 3 = 0 THEN 0 ELSE seq % 5 END AS INT) AS metrics_rows, CAST(seq % 3 AS INT) AS qa_issues_count, CAST(CASE WHEN seq % 7 = 0 THEN 1 ELSE 0 END AS INT) AS returncode
        FROM (SELECT ticker, min(seq) AS seq FROM {publications} GROUP BY ticker) x""",
    # the state after a run that stopped early: what it has of each ticker differs
    "early_publications": "SELECT ticker, CASE WHEN seq % 9 < 2 THEN status WHEN seq % 9 < 5 THEN 'discovered' ELSE 'downloaded' END AS status, CASE WHEN seq % 2 = 0 THEN upper(last_error) ELSE last_error END AS last_error FROM {publications}",
    "early_filings": "SELECT ticker, is_machine_readable, reporting_standard, page_count, text_pages_count FROM {filings} WHERE line > 5",
    "early_metrics": "SELECT ticker, metric_id FROM {metrics} WHERE currency = 'USD' OR unit = 'thousands'",
    "early_issues": "SELECT ticker, CASE WHEN issue_id % 5 = 0 THEN code ELSE 'incomplete' END AS code FROM {qa_issues}",
    # one metric for each key may come several times, as from repeated extractions of one period
    "extracted_rows": """
        SELECT concat('EDX', o_custkey) AS ticker, concat('Q', quarter(o_orderdate)) AS period_type, l_linenumber AS metric_no, o_orderkey * 1000000 + l_partkey AS seq,
               CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_extendedprice END AS value, CASE WHEN o_orderkey % 4 = 0 THEN 'thousands' WHEN o_orderkey % 4 = 1 THEN 'millions' ELSE 'ones' END AS unit,
               concat('Q', 1 + o_custkey % 4) AS expected_type
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "pages_of": (
        "SELECT doc_id, CAST(pos + 1 AS INT) AS page_number, page FROM {documents} LATERAL VIEW posexplode(split(text, '\n')) p AS pos, page",
        "SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INT) AS page_number, unnest(string_split(text, chr(10))) AS page FROM {documents}",
    ),
}


def _needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{([a-z_]+)\}", text)))


def _over(spark: SparkSession, text: str, parts: dict[str, DataFrame]) -> DataFrame:
    for n, df in parts.items():
        df.createOrReplaceTempView(f"_tf_{n}")
    return spark.sql(re.sub(r"\{([a-z_]+)\}", lambda m: f"_tf_{m[1]}", text))


def table(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """A provided table, or a domain view over them; ``given`` frames stand for the tables or views of their names."""
    if name in given:
        return given[name]
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    text = text if isinstance(text, str) else text[0]
    return _over(spark, text, {n: table(spark, sf_dir, n, **given) for n in _needs(text)})


def sourced_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``period_sums`` with the source that its metrics name, null where they name none."""
    return table(spark, sf_dir, "period_sums").withColumn("source_document_id", F.expr("CASE WHEN k % 29 = 0 THEN NULL ELSE source_document_id END"))


def spread_metrics(spark: SparkSession, periods: DataFrame, *carried: str) -> DataFrame:
    """The metrics of rows of ``period_sums``, with the columns of those rows that are ``carried`` along."""
    more = "".join(f", {c}" for c in carried)
    return _over(spark, f"{_METRIC_COLUMNS}{more} FROM {{periods}} {_METRIC_NAMES}", {"periods": periods})


@cache
def _ordered(names: tuple[str, ...]) -> tuple[str, ...]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in VIEWS and n not in out:
            text = VIEWS[n]
            for m in _needs(text if isinstance(text, str) else text[1]):
                visit(m)
            out.append(n)

    for n in names:
        visit(n)
    return tuple(out)


def oracle(names: str, body: str) -> str:
    """``body`` after WITH clauses for the named views and what they need."""
    clauses = []
    for n in _ordered(tuple(names.split())):
        text = VIEWS[n]
        text = text if isinstance(text, str) else text[1]
        clauses.append(f"d_{n} AS (" + re.sub(r"\{([a-z_]+)\}", lambda m: f"d_{m[1]}" if m[1] in VIEWS else m[1], text) + ")")
    body = body.strip()
    joined = ",\n".join(clauses)
    if body.upper().startswith("WITH "):
        return f"WITH {joined},\n{body[5:]}"
    return f"WITH {joined}\n{body}"
