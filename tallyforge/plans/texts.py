"""Text, date and page functions (F, J8, J9, W5, A16), HTML (S), logs, extraction, and streams."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions import classify, markup, period, text
from tallyforge.operators import control, documents, extraction
from tallyforge.plans.domain import oracle, table
from tallyforge.plans.registry import query
from tallyforge.sources import files, listings, logs
from tallyforge.streaming import incremental

WS = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


@query("f1_normalised", f"SELECT doc_id, {_strip(f'''regexp_replace(text, '{WS}+', ' ', 'g')''')} AS text FROM documents")
def f1(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalised(F.col("text")).alias("text"))


_LABELS = "SELECT seq, CASE seq % 14 WHEN 0 THEN concat(y, ', 3 месяца') WHEN 1 THEN concat(y, ', 6 месяцев') WHEN 2 THEN concat('II квартал ', y) WHEN 3 THEN concat(y, ',  1 квартал') WHEN 4 THEN concat('первое полугодие ', y) WHEN 5 THEN CAST(y AS STRING) WHEN 6 THEN concat('Отчёт за 3 квартал ', y, ' года') WHEN 7 THEN concat('итоги за ', y, ' год') WHEN 8 THEN concat('Бухгалтерская отчетность за ', y) WHEN 9 THEN concat('Информация о компании ', y) WHEN 10 THEN '' WHEN 11 THEN concat('за 2 полугодие ', y) WHEN 12 THEN concat(y, ', 12 мес.') ELSE concat('четвёртый квартал ', y) END AS label FROM (SELECT o_orderkey AS seq, year(o_orderdate) AS y FROM {0}) x"


@query(
    "f2_reporting_period",
    f"""SELECT seq, CASE WHEN seq % 14 IN (9, 10) THEN NULL ELSE CAST(regexp_extract(label, '(\\d{{4}})', 1) AS INT) END AS year, CASE seq % 14 WHEN 0 THEN 'Q1' WHEN 1 THEN 'H1' WHEN 2 THEN 'Q2' WHEN 3 THEN 'Q1' WHEN 4 THEN 'H1' WHEN 5 THEN 'FY' WHEN 6 THEN 'Q3' WHEN 7 THEN 'FY' WHEN 8 THEN 'FY' WHEN 11 THEN 'H2' WHEN 12 THEN 'FY' WHEN 13 THEN 'Q4' END AS period FROM ({_LABELS.format('orders')})""",
)
def f2(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("_tf_orders")
    labels = spark.sql(_LABELS.format("_tf_orders")).withColumn("p", period.reporting_period(F.col("label")))
    return labels.select("seq", "p.year", "p.period")


_DATES = "SELECT o_orderkey AS seq, CASE o_orderkey % 6 WHEN 0 THEN concat(day(o_orderdate), '.', month(o_orderdate), '.', year(o_orderdate)) WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 2 THEN concat(' ', day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate)) WHEN 3 THEN concat(day(o_orderdate), '-', month(o_orderdate), '-', year(o_orderdate)) WHEN 4 THEN '31.02.2024' ELSE concat(day(o_orderdate), '.', month(o_orderdate), '.24') END AS value, CAST(o_orderdate AS DATE) AS day FROM {0}"


@query("f3_parsed_date", f"SELECT seq, CASE WHEN seq % 6 < 4 THEN day END AS parsed FROM ({_DATES.format('orders')})")
def f3(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("_tf_orders")
    return spark.sql(_DATES.format("_tf_orders")).select("seq", text.parsed_date(F.col("value")).alias("parsed"))


@query("f4_short", f"SELECT doc_id, CASE WHEN length(s) <= 80 THEN s ELSE s[1:80] || '…' END AS short FROM (SELECT doc_id, {_strip('text')} AS s FROM documents)")
def f4(spark, d):
    return table(spark, d, "documents").select("doc_id", text.short(F.col("text")).alias("short"))


MARKERS = {"IFRS": ("the", "and"), "RSBU": ("de", "la"), "ISSUER": ("der", "ung")}


def _score(markers: tuple[str, ...]) -> str:
    return " + ".join(f"(length(t) - length(replace(t, '{m}', ''))) // {len(m)}" for m in markers)


_SCORED = "s AS (SELECT doc_id, " + ", ".join(f"{_score(m)} AS {k}" for k, m in MARKERS.items()) + " FROM (SELECT doc_id, lower(text) AS t FROM documents)), b AS (SELECT *, greatest(IFRS, RSBU, ISSUER) AS best FROM s)"


@query("f5_reporting_standard", f"WITH {_SCORED} SELECT doc_id, CASE WHEN best = 0 OR (IFRS = best)::INT + (RSBU = best)::INT + (ISSUER = best)::INT > 1 THEN 'OTHER' WHEN IFRS = best THEN 'IFRS' WHEN RSBU = best THEN 'RSBU' ELSE 'ISSUER' END AS standard FROM b")
def f5(spark, d):
    return table(spark, d, "documents").select("doc_id", classify.reporting_standard(F.col("text"), MARKERS).alias("standard"))


@query("f6_report_form", f"WITH {_SCORED} SELECT doc_id, CASE WHEN best = 0 THEN 'other' WHEN IFRS = best THEN 'IFRS' WHEN RSBU = best THEN 'RSBU' ELSE 'ISSUER' END AS form FROM b")
def f6(spark, d):
    return table(spark, d, "documents").select("doc_id", classify.report_form(F.col("text"), MARKERS).alias("form"))


@query("f7_standard_of_type", oracle("publications", "SELECT publication_id, CASE report_type_code WHEN 2 THEN 'ANNUAL' WHEN 3 THEN 'RSBU' WHEN 4 THEN 'IFRS' WHEN 5 THEN 'ISSUER' END AS standard FROM d_publications"))
def f7(spark, d):
    return table(spark, d, "publications").select("publication_id", classify.standard_of_type(F.col("report_type_code")).alias("standard"))


@query("f8_page_kind", oracle("pages_of", f"SELECT doc_id, page_number, CASE WHEN length({_strip('page')}) >= 40 THEN 'text' ELSE 'scan' END AS kind FROM d_pages_of"))
def f8(spark, d):
    return table(spark, d, "pages_of").select("doc_id", "page_number", text.page_kind(F.col("page"), 40).alias("kind"))


_FILING = "SELECT doc_id, concat('Cover of ', doc_id, chr(10)) AS cover, CASE doc_id % 4 WHEN 1 THEN concat('  БУХГАЛТЕРСКИЙ  баланс ', chr(10)) WHEN 2 THEN concat('Форма по ОКУД 0710001', chr(10)) WHEN 3 THEN concat('Отчет о финансовых результатах', chr(10)) ELSE 'в бухгалтерский баланс входит ' END AS heading, concat(repeat(text, CASE WHEN doc_id % 50 = 1 THEN 40 ELSE 1 END), chr(10), 'Бухгалтерский баланс за год') AS rest FROM {0}"


@query("f9_from_anchor", f"WITH f AS ({_FILING.format('documents')}) SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN length(cover) + 1 END::INT AS anchor_at, CASE WHEN doc_id % 4 <> 0 THEN '{classify.LEAD}' || substr(heading || rest, 1, 200000) END AS content, coalesce(doc_id % 4 <> 0 AND length(heading || rest) > 200000, false) AS capped FROM f")
def f9(spark, d):
    """Filings with a cover, one of the three headings or a sentence that is none, and the whole text of a document."""
    table(spark, d, "documents").createOrReplaceTempView("_tf_documents")
    filings = spark.sql(_FILING.format("_tf_documents").replace("chr(10)", "'\\n'"))
    return filings.withColumn("c", classify.from_anchor(F.concat("cover", "heading", "rest"))).select("doc_id", "c.anchor_at", "c.content", "c.capped")


@query("f10_section")
def f10(spark, d):
    body = F.concat(F.lit("содержание\n1.4. Основные финансовые показатели\n"), "text", F.lit("\n1.5. Прочее\n"))
    found = table(spark, d, "documents").select("doc_id", classify.section(body, 20_000, 500, 3000).alias("s"))
    return found.select("doc_id", F.length("s.content").alias("n"), "s.label", "s.end_anchor", F.array_join("s.warnings", ",").alias("warnings"))


@query("f11_cleaned")
def f11(spark, d):
    return table(spark, d, "documents").select("doc_id", text.cleaned(text.compatible(F.col("text"))).alias("text"))


#: characters of a page, and of all pages of a document that go into a prompt
_PAGE, _BUDGET = 2000, 50_000
_PARTS = f"parts AS (SELECT doc_id, CAST(unnest(range(1, CAST(greatest(1, ceil(length(text) / {_PAGE}.0)) AS BIGINT) + 1)) AS INT) AS page_number, text FROM documents), p AS (SELECT doc_id, page_number, 'HEAD ' || (doc_id % 3) || chr(10) || substr(text, (page_number - 1) * {_PAGE} + 1, {_PAGE}) || CASE WHEN page_number < 3 THEN chr(10) || 'odd' ELSE '' END AS page FROM parts)"


def _parts(spark, d):
    """Each document's whole text as pages, with a line that recurs on all and one that does on two."""
    n = F.greatest(F.lit(1), F.ceil(F.length("text") / _PAGE)).cast("int")
    docs = table(spark, d, "documents").select("doc_id", "text", F.explode(F.sequence(F.lit(1), n)).alias("page_number"))
    odd = F.when(F.col("page_number") < 3, F.lit("\nodd")).otherwise("")
    return docs.select("doc_id", "page_number", F.concat(F.lit("HEAD "), F.col("doc_id") % 3, F.lit("\n"), F.substring("text", (F.col("page_number") - 1) * _PAGE + 1, F.lit(_PAGE)), odd).alias("page"))


_LINES = f"l AS (SELECT DISTINCT doc_id, page_number, {_strip('line')} AS line FROM (SELECT doc_id, page_number, unnest(string_split(page, chr(10))) AS line FROM p)), c AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id), f AS (SELECT doc_id, line, n, count(DISTINCT page_number) AS pages FROM l JOIN c USING (doc_id) WHERE line <> '' AND length(line) <= 120 GROUP BY ALL)"


@query("a16_line_frequency", f"WITH {_PARTS}, {_LINES} SELECT doc_id, line, pages FROM f")
def a16(spark, d):
    return documents.line_frequency(_parts(spark, d))


@query("f12_without_recurring", f"WITH {_PARTS}, {_LINES}, o AS (SELECT doc_id, page_number, generate_subscripts(string_split(page, chr(10)), 1) AS pos, unnest(string_split(page, chr(10))) AS line FROM p), k AS (SELECT o.* FROM o LEFT JOIN f ON f.doc_id = o.doc_id AND f.line = {_strip('o.line')} AND f.pages >= greatest(3, f.n // 2 + 1) WHERE f.line IS NULL) SELECT p.doc_id, p.page_number, coalesce({_strip('''string_agg(k.line, chr(10) ORDER BY pos)''')}, '') AS page FROM p LEFT JOIN k USING (doc_id, page_number) GROUP BY ALL")
def f12(spark, d):
    return documents.without_recurring(_parts(spark, d))


@query("w5_page_budget", f"WITH {_PARTS}, b AS (SELECT *, coalesce(sum(length(page)) OVER (PARTITION BY doc_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p), t AS (SELECT *, max(before >= {_BUDGET} OR before + length(page) > {_BUDGET}) OVER (PARTITION BY doc_id) AS truncated FROM b) SELECT doc_id, page_number, substr(page, 1, CAST({_BUDGET} - before AS BIGINT)) AS page, truncated FROM t WHERE before < {_BUDGET}")
def w5(spark, d):
    return documents.within_budget(_parts(spark, d), _BUDGET)


@query("f13_max_chars", f"WITH {_PARTS} SELECT doc_id, least(sum(length(page)), {_BUDGET})::BIGINT AS chars FROM p GROUP BY doc_id")
def f13(spark, d):
    return documents.within_budget(_parts(spark, d), _BUDGET).groupBy("doc_id").agg(F.sum(F.length("page")).alias("chars"))


@query("j8_overlay_pages", f"WITH {_PARTS}, o AS (SELECT doc_id, page_number, reverse(page) AS ocr FROM p WHERE (doc_id + page_number) % 4 = 0) SELECT doc_id, page_number, coalesce(ocr, page) AS page, CASE WHEN ocr IS NULL THEN 't' || page_number END AS tables FROM p LEFT JOIN o USING (doc_id, page_number)")
def j8(spark, d):
    p = _parts(spark, d).withColumn("tables", F.concat(F.lit("t"), "page_number"))
    ocr = p.where("(doc_id + page_number) % 4 = 0").select("doc_id", "page_number", F.reverse("page").alias("page"))
    return documents.overlay_pages(p, ocr)


@query("j9_page_tables", f"WITH {_PARTS} SELECT doc_id, page_number, CASE WHEN page_number % 2 = 0 THEN 'table' END AS tables FROM p")
def j9(spark, d):
    p = _parts(spark, d).select("doc_id", "page_number")
    return documents.with_tables(p, p.where("page_number % 2 = 0").withColumn("tables", F.lit("table")))


@query("f14_needs_retry", f"SELECT doc_id, CASE WHEN length(s) < 80 THEN true WHEN length(s) >= 800 THEN false ELSE len(regexp_extract_all(s, '\\d')) / length(s)::DOUBLE < 0.05 END AS retry FROM (SELECT doc_id, {_strip('text')} AS s FROM documents)")
def f14(spark, d):
    return table(spark, d, "documents").select("doc_id", text.needs_retry(F.col("text")).alias("retry"))


@query("f15_in_unit", oracle("extracted_rows", "SELECT seq, period_type, ticker, value * CASE unit WHEN 'ones' THEN 1.0::DOUBLE WHEN 'thousands' THEN 1000.0::DOUBLE ELSE 1000000.0::DOUBLE END / 1000.0::DOUBLE AS value FROM d_extracted_rows"))
def f15(spark, d):
    return table(spark, d, "extracted_rows").select("seq", "period_type", "ticker", text.in_unit(F.col("value"), F.col("unit"), F.lit("thousands")).alias("value"))


@query("f16_file_name", "SELECT page_id, coalesce(nullif(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z]+://[^/]*', ''), '([^/]*)/*$', 1), ''), 'file') AS name FROM pages")
def f16(spark, d):
    return table(spark, d, "pages").select("page_id", text.file_name(F.col("url")).alias("name"))


@query("f17_looks_like_html", oracle("filings", "SELECT document_id, coalesce(contains(mime_type, 'text/html'), false) OR ends_with(relative_path, '.html') AS html FROM d_filings"))
def f17(spark, d):
    return table(spark, d, "filings").select("document_id", text.looks_like_html(F.col("mime_type"), F.col("relative_path")).alias("html"))


@query("f18_digest", "SELECT doc_id, sha256(text) AS digest FROM documents")
def f18(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query("f19_unsafe_member", "SELECT page_id, coalesce(p = '' OR starts_with(p, '/') OR regexp_matches(p, '^[A-Za-z]:') OR list_contains(string_split(p, '/'), '..'), true) AS unsafe FROM (SELECT page_id, replace(CASE page_id % 5 WHEN 0 THEN '/etc/x' WHEN 1 THEN 'a/../b' WHEN 2 THEN 'a\\..\\b' WHEN 3 THEN '' ELSE url END, '\\', '/') AS p FROM pages)")
def f19(spark, d):
    path = F.when(F.col("page_id") % 5 == 0, "/etc/x").when(F.col("page_id") % 5 == 1, "a/../b").when(F.col("page_id") % 5 == 2, "a\\..\\b").when(F.col("page_id") % 5 == 3, "").otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", text.unsafe_member(path).alias("unsafe"))


@query("f20_cache_key", "SELECT conv_id, turn, sha256(concat('=', role, chr(0), '=', text, chr(0), '-')) AS key FROM conversations")
def f20(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.cache_key(F.col("role"), F.col("text"), F.lit(None)).alias("key"))


@query("f23_issue_codes", "SELECT event_id, 'c' || (event_id % 7) || ',' || 'd' AS codes FROM events")
def f23(spark, d):
    said = F.concat(F.lit("warning code: c"), F.col("event_id") % 7, F.lit("; again CODE=d code:d"))
    return table(spark, d, "events").select("event_id", F.array_join(logs.issue_codes(said), ",").alias("codes"))


@query("f24_safe_int", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id % 1000 AS INT) WHEN 1 THEN 1 ELSE 0 END AS n FROM events")
def f24(spark, d):
    v = F.when(F.col("event_id") % 4 == 0, (F.col("event_id") % 1000).cast("string")).when(F.col("event_id") % 4 == 1, "true").when(F.col("event_id") % 4 == 2, "x7")
    return table(spark, d, "events").select("event_id", text.safe_int(v).alias("n"))


@query("f27_backfill_cutoff", "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 365 * CAST(1 + o_orderkey % 3 AS INT) AS cutoff FROM orders")
def f27(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.date_sub(F.col("o_orderdate").cast("date"), (365 * (1 + F.col("o_orderkey") % 3)).cast("int")).alias("cutoff"))


@query("f28_archive_name", "SELECT event_id, 'mart-' || strftime(ts, '%Y-%m-%d-%H%M') || '.xlsx' AS name FROM events")
def f28(spark, d):
    return table(spark, d, "events").select("event_id", F.concat(F.lit("mart-"), F.date_format("ts", "yyyy-MM-dd-HHmm"), F.lit(".xlsx")).alias("name"))


@query("f29_event_fallbacks", oracle("disclosures", "SELECT event_id, CASE WHEN event_type IN ('dividends', 'management_change') THEN event_type ELSE 'other' END AS event_type, event_date, substr(summary, 1, 8) AS summary, key_params_json FROM d_disclosures"))
def f29(spark, d):
    e = table(spark, d, "disclosures")
    given = F.when(F.col("event_id") % 2 == 0, F.col("event_date").cast("string")).otherwise("")
    c = extraction.event_fields(F.col("event_type"), given, F.col("publication_date").cast("string"), F.col("summary"), F.coalesce("key_params_json", F.lit("{}")), ("dividends", "management_change"), 8)
    return e.select("event_id", c["event_type"].alias("event_type"), c["event_date"].cast("date").alias("event_date"), c["summary"].alias("summary"), c["key_params_json"].alias("key_params_json"))


@query("f30_prompt_text", f"WITH {_PARTS} SELECT doc_id, 'Document ' || doc_id || chr(10) || string_agg('--- page ' || page_number || ' ---' || chr(10) || page, chr(10) ORDER BY page_number) AS prompt FROM p GROUP BY doc_id")
def f30(spark, d):
    return documents.prompt_text(_parts(spark, d), F.concat(F.lit("Document "), "doc_id"))


@query("f33_synthetic_ticker", "SELECT c_custkey, 'EDX' || c_custkey AS ticker FROM customer")
def f33(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.concat(F.lit("EDX"), "c_custkey").alias("ticker"))


@query("p13_path_globs", "SELECT page_id, (regexp_full_match(url, 'https://.*') OR regexp_full_match(url, '.*example\\.org.*')) AND NOT regexp_full_match(url, '.*\\?page=[0-9].*') AS allowed FROM pages")
def p13(spark, d):
    # globs as patterns: * is any run, ? any character; deny wins
    def pattern(glob: str) -> str:
        return "^" + "".join(".*" if c == "*" else "." if c == "?" else c if c in "[]-" else f"\\Q{c}\\E" for c in glob) + "$"

    url = F.col("url")
    allowed = url.rlike(pattern("https://*")) | url.rlike(pattern("*example.org*"))
    return table(spark, d, "pages").select("page_id", (allowed & ~url.rlike("^.*\\Q?page=\\E[0-9].*$")).alias("allowed"))


@query("s4_log_lines", "SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN event_type END AS event, 'EDX' || user_id AS ticker FROM events WHERE event_id % 5 > 1")
def s4(spark, d):
    value = F.expr("CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN '{broken' ELSE concat('{\"ticker\":\"EDX', user_id, '\"', IF(event_id % 2 = 0, concat(',\"event\":\"', event_type, '\"'), ''), '}') END")
    lines = table(spark, d, "events").select(F.col("event_id").alias("seq"), value.alias("value"))
    return logs.log_lines(lines).select("seq", "event", "ticker")


@query(
    "s21_stream_answers",
    "WITH t AS (SELECT conv_id, turn, text FROM conversations), last AS (SELECT conv_id, max_by(text, turn) AS answer, count(*) AS messages, max(turn) AS m FROM t GROUP BY conv_id) SELECT conv_id, answer, messages, conv_id % 3 = 0 AS is_error, m AS input_tokens FROM last",
)
def s21(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    message = F.to_json(F.struct(F.lit("assistant").alias("type"), F.struct(F.concat(F.lit("m"), "turn").alias("id"), F.array(F.struct(F.lit("text").alias("type"), F.col("text"))).alias("content")).alias("message")))
    result = F.to_json(F.struct(F.lit("result").alias("type"), (F.col("conv_id") % 3 == 0).alias("is_error"), F.struct(F.col("m").alias("input_tokens")).alias("usage")))
    lines = c.select("conv_id", F.col("turn").alias("at"), message.alias("value"))
    ends = c.groupBy("conv_id").agg(F.max("turn").alias("m")).select("conv_id", (F.col("m") + 1).alias("at"), result.alias("value"))
    return logs.stream_answers(lines.unionByName(ends), "conv_id", "at").select("conv_id", "answer", "messages", "is_error", "input_tokens")


@query("s10_message_text")
def s10(spark, d):
    return table(spark, d, "pages").select("page_id", markup.message_text_column(F.col("html")).alias("text"))


@query("s11_document_links")
def s11(spark, d):
    page = F.concat("html", F.lit('<a href="/files/report.pdf?x=1">r</a><a href="#top">t</a><a href="other.html">o</a>'))
    return table(spark, d, "pages").select("page_id", F.array_join(markup.document_links_column(page, F.col("url")), " ").alias("links"))


@query("s12_search_results")
def s12(spark, d):
    page = F.concat(F.lit('<body><a class="companyLink" href="/portal/company.aspx?id='), "page_id", F.lit('">Company</a></body>'))
    found = table(spark, d, "pages").select("page_id", F.explode(markup.search_results_column(page)).alias("r"))
    return found.select("page_id", F.col("r")[0].alias("id"), F.col("r")[1].alias("name"), F.col("r")[2].alias("href"))


#: a label of each form, # for the year, and its period
_FORMS = [
    ("#, 3 месяца", "Q1"), ("#, 6 месяцев", "H1"), ("#, 9 месяцев", "9M"), ("#, 12 мес.", "FY"), ("#, 1 квартал", "Q1"),
    ("#, III квартал", "Q3"), ("II квартал #", "Q2"), ("четвёртый квартал #", "Q4"), ("первое полугодие #", "H1"), ("II полугодие, #", "H2"),
    ("#", "FY"), ("Отчёт за 3 квартал # года", "Q3"), ("за 2 полугодие # год", "H2"), ("итоги за # год", "FY"), ("Бухгалтерская отчётность за #", "FY"),
]
_LISTED = "SELECT ticker || '-' || report_type_code || '-' || seq AS publication_id, ticker, publication_date, reporting_period_year, CASE seq % 15 " + " ".join(f"WHEN {k} THEN '{p}'" for k, (_, p) in enumerate(_FORMS)) + " END AS reporting_period_type FROM d_publications WHERE report_type_code IN (3, 4)"


def _listing_pages(spark, d):
    """A listing page per ticker and type, in the layout of seven cells."""
    p = table(spark, d, "publications").where("report_type_code IN (3, 4)")
    day = F.date_format("publication_date", "dd.MM.yyyy")
    label = F.expr("CASE seq % 15 " + " ".join(f"WHEN {k} THEN replace('{form}', '#', reporting_period_year)" for k, (form, _) in enumerate(_FORMS)) + " END")
    cells = F.concat(F.lit("<tr><td>1</td><td>Report</td><td>"), label, F.lit("</td><td>x</td><td>"), day, F.lit('</td><td class="file-cell"><a class="file-link" data-fileid="'), "seq", F.lit('" href="/f?id='), "seq", F.lit('">f</a></td><td></td></tr>'))
    rows = p.groupBy("ticker", F.col("report_type_code").alias("type_code")).agg(F.array_join(F.array_sort(F.collect_list(cells)), "").alias("rows"))
    return rows.select("ticker", "type_code", F.concat(F.lit('<table class="files-table"><tr><th>h</th></tr>'), "rows", F.lit("</table>")).alias("html"))


@query("s1_listing_rows", oracle("publications", _LISTED))
def s1(spark, d):
    return _listed(_listing_pages(spark, d))


@query("s2_view_source", oracle("publications", _LISTED))
def s2(spark, d):
    escaped = F.replace(F.replace(F.col("html"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return _listed(_listing_pages(spark, d).withColumn("html", F.concat(F.lit('<html><body><span id="line1">'), escaped, F.lit("</span></body></html>"))))


def _listed(pages):
    return listings.publications(pages).select("publication_id", "ticker", "publication_date", "reporting_period_year", "reporting_period_type")


@query("s13_archive_kind", oracle("filings", "SELECT document_id, CASE WHEN ends_with(relative_path, '.zip') THEN 'zip' WHEN line = 1 THEN 'rar' WHEN line = 2 THEN 'zip' END AS kind FROM d_filings"))
def s13(spark, d):
    head = F.when(F.col("line") == 1, F.unhex(F.lit("526172211A070000"))).when(F.col("line") == 2, F.unhex(F.lit("504B030414"))).otherwise(F.unhex(F.lit("25504446")))
    return table(spark, d, "filings").select("document_id", files.archive_kind(F.col("relative_path"), head).alias("kind"))


@query("s20_change_log", "SELECT doc_id, 2 AS entries, CAST(7 + doc_id % 5 AS INT) AS last_tick, 'oom_kill,unknown' AS classes, 2 AS anti_patterns FROM documents")
def s20(spark, d):
    body = F.concat(F.lit("# log\n### evolve(3) — 2024-01-01 — unknown\ntext\n### evolve("), 7 + F.col("doc_id") % 5, F.lit(") — 2024-01-02 — oom_kill\n## Anti-patterns\n- one\n* two\n-none\n## Next\n- three\n"))
    return table(spark, d, "documents").select("doc_id", logs.change_log_digest(body).alias("g")).select("doc_id", "g.entries", "g.last_tick", F.array_join("g.classes", ",").alias("classes"), "g.anti_patterns")


@query("f21_outer_object", "SELECT event_id, '{\"a\": \"}{\", \"b\": {\"c\": ' || event_id || '}}' AS found FROM events")
def f21(spark, d):
    said = F.concat(F.lit('I say {not json} and ```json {"a": "}{", "b": {"c": '), "event_id", F.lit("}} ``` {}"))
    return table(spark, d, "events").select("event_id", logs.outer_object_column(said).alias("found"))


@query("j14_best_names")
def j14(spark, d):
    names = table(spark, d, "supplier").select(F.col("s_suppkey").alias("position"), F.col("s_name").alias("name"))
    return listings.best_of_all(table(spark, d, "customer").select(F.col("c_name").alias("target")), names)


@query("x1_tumbling_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 3) AS value FROM events GROUP BY ALL")
def x1(spark, d):
    return incremental.tumbling(table(spark, d, "events")).withColumn("value", F.round("value", 3))


@query("x2_sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS \"end\", count(*) AS n FROM s GROUP BY user_id, k")
def x2(spark, d):
    return incremental.sessions(table(spark, d, "events"))


@query("a15_marker_occurrences", f"SELECT doc_id, CAST({_score(('the', 'de'))} AS INT) AS n FROM (SELECT doc_id, lower(text) AS t FROM documents)")
def a15(spark, d):
    return table(spark, d, "documents").select("doc_id", text.marker_score(F.col("text"), ("the", "de")).alias("n"))


@query("f25_trimmed_evidence", oracle("logs", """SELECT ticker, string_agg(j, ';' ORDER BY seq) AS evidence FROM (SELECT ticker, seq, to_json({'event': event, 'level': level, 'status': status}) AS j, row_number() OVER (PARTITION BY ticker ORDER BY seq) AS r FROM d_logs WHERE level = 'error') WHERE r <= 5 GROUP BY ticker"""))
def f25(spark, d):
    """The first five lines of each ticker as JSON of whitelisted fields, in the order of their names."""
    lines = table(spark, d, "logs").where("level = 'error'").select("ticker", "seq", F.to_json(F.struct("event", "level", "status"), {"ignoreNullFields": "false"}).alias("j"))
    few = control.ranked_latest(lines, "ticker", F.asc("seq"), 5)
    return few.groupBy("ticker").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "j"))), lambda x: x["j"]), ";").alias("evidence"))


@query("s14_unpack", "SELECT doc_id || '.zip' AS path, 'a/text.txt' AS member, strlen(text) AS size, sha256(text) AS file_hash FROM documents")
def s14(spark, d):
    @F.pandas_udf(T.BinaryType())
    def packed(texts: pd.Series) -> pd.Series:
        def one(t: str) -> bytes:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("a/text.txt", t)
            return out.getvalue()

        return texts.map(one)

    archives = table(spark, d, "documents").select(F.concat("doc_id", F.lit(".zip")).alias("path"), packed("text").alias("content"))
    return files.unpack(archives, with_content=False).select("path", "member", "size", "file_hash")


@query("k4_nested_extracts", f"WITH {_PARTS} SELECT doc_id, count(*) AS pages, CAST(sum(length(page)) AS BIGINT) AS chars FROM p GROUP BY doc_id")
def k4(spark, d):
    nested = files.nested_extracts(_parts(spark, d))
    return nested.select("doc_id", F.size("pages").cast("bigint").alias("pages"), F.aggregate("pages", F.lit(0).cast("bigint"), lambda n, p: n + F.length(p["text"])).alias("chars"))


@query("m1_model_extraction")
def m1(spark, d):
    """Requests to the deterministic provider, answers, and deduplicated metric rows."""
    docs = table(spark, d, "documents").select(F.concat(F.lit("EDX"), F.col("doc_id") % 100).alias("ticker"), F.col("doc_id").cast("string").alias("publication_id"), "text")
    asked = extraction.keyed(docs.withColumn("prompt", F.col("text")), "prompt", "ticker", "publication_id")
    answers = extraction.ask(asked, extraction.FixedProvider)
    joined = asked.join(answers.where("answer is not null"), "request_key").select("ticker", "publication_id", F.lit("FY").alias("expected_type"), "answer")
    return extraction.extracted_metrics(joined)
