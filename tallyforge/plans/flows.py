"""Queries of whole flows: stages with failures, sources by ranges, changes of several tables."""

from __future__ import annotations

import io
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from tallyforge.operators import page_tables, requests, snapshots, stages
from tallyforge.plans.domain import oracle, table
from tallyforge.plans.registry import query
from tallyforge.shared import filesystem, fresh_dir, stored
from tallyforge.sources import logs, members, ranges

#: characters beyond which a document's text counts as cut (W8's planted stage)
LONG_TEXT = 4000


def _read_text(raw: bytes | None) -> dict:
    """Text of a downloaded file; raises where it is missing or no UTF-8."""
    if raw is None:
        raise FileNotFoundError("no file")
    text = bytes(raw).decode("utf-8")
    return {"chars": len(text), "pages": text.count("\n") + 1, "truncated": len(text) > LONG_TEXT}


READ_TEXT = stages.Stage("text", ("raw",), "chars long, pages long, truncated boolean", _read_text)


@query(
    "w8_stage_outcomes",
    f"""WITH t AS (
  SELECT 'p' || (doc_id // 3) AS publication_id, doc_id, text, text IS NULL OR doc_id % 7 = 5 AS missing, doc_id % 7 = 3 AS broken FROM documents
), o AS (
  SELECT publication_id, doc_id, CASE WHEN missing THEN 'FileNotFoundError' WHEN broken THEN 'UnicodeDecodeError' END AS kind,
         CASE WHEN missing THEN 'no file' WHEN broken THEN '''utf-8'' codec can''t decode byte 0xff in position ' || strlen(text) || ': invalid start byte' END AS message,
         length(text) AS chars, length(text) - length(replace(text, chr(10), '')) + 1 AS pages, length(text) > {LONG_TEXT} AS truncated
  FROM t
)
SELECT publication_id, CASE WHEN count(kind) > 0 THEN 'failed' ELSE 'extracted' END AS status,
       arg_min(kind, doc_id) FILTER (kind IS NOT NULL) AS error_kind, arg_min(message, doc_id) FILTER (kind IS NOT NULL) AS last_error,
       CASE WHEN count(kind) = 0 THEN count(*) END AS parts, CASE WHEN count(kind) = 0 THEN CAST(sum(chars) AS BIGINT) END AS chars,
       CASE WHEN count(kind) = 0 THEN CAST(sum(pages) AS BIGINT) END AS pages, CASE WHEN count(kind) = 0 THEN bool_or(truncated) END AS truncated
FROM o GROUP BY publication_id""",
)
def w8(spark, d):
    """Every seventh document has a byte that is no UTF-8, every seventh no file; their publications fail, the others go on."""
    bad = F.concat(F.encode("text", "utf-8"), F.unhex(F.lit("FF")))
    raw = F.when(F.col("doc_id") % 7 == 3, bad).when(F.col("doc_id") % 7 != 5, F.encode("text", "utf-8"))
    docs = table(spark, d, "documents").select(F.concat(F.lit("p"), F.expr("doc_id div 3")).alias("publication_id"), "doc_id", raw.alias("raw"))
    done = stages.attempted(docs, READ_TEXT).drop("raw")
    return stages.unit_outcomes(done, "publication_id", "doc_id", ("chars", "pages"), ("truncated",))


@query("s4_log_ranges", "SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN event_type END AS event, 'EDX' || user_id AS ticker FROM events WHERE event_id % 5 > 1")
def s4_ranges(spark, d):
    """The log of ``s4_log_lines`` as files, read in ranges of bytes that are cut anywhere."""
    value = F.expr("CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN '{broken' ELSE concat('{\"ticker\":\"EDX', user_id, '\",\"found\":', event_id, IF(event_id % 2 = 0, concat(',\"event\":\"', event_type, '\"'), ''), '}') END")
    folder = fresh_dir(spark, "logs")
    table(spark, d, "events").select(value).write.text(folder)
    found = logs.log_lines(ranges.lines(spark, folder, range_bytes=1 << 16))
    return found.select(F.col("found").cast("long").alias("seq"), "event", "ticker")


#: documents of an archive of ``s14_member_runs``
ARCHIVED = 100


def _archives(docs, folder):
    """Zip files of ``ARCHIVED`` documents each, a member a document; their URIs. The archives of every fifth are cut off or hold an unsafe name."""

    def packed(part: pa.Table) -> pa.Table:
        number, out = part["archive"][0].as_py(), io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for doc_id, text in sorted(zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True)):
                z.writestr(f"a/{doc_id}.txt", text or "", (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2)[doc_id % 3])
            if number % 5 == 4:
                z.writestr("../out.txt", "x")
        data, path = out.getvalue(), f"{folder}/{number}.zip"
        system, where = filesystem(path)
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        attempt = f"{where}.{uuid.uuid4().hex}"
        with system.open_output_stream(attempt) as f:
            f.write(data[: len(data) // 2] if number % 5 == 3 else data)
        system.move(attempt, where)
        return pa.table({"path": [path]})

    numbered = docs.select(F.expr(f"doc_id div {ARCHIVED}").alias("archive"), "doc_id", "text")
    return stored(numbered.groupBy("archive").applyInArrow(packed, "path string"), "archives")


@query(
    "s14_member_runs",
    f"""SELECT doc_id // {ARCHIVED} AS archive, 'a/' || doc_id || '.txt' AS member, strlen(coalesce(text, '')) AS size, sha256(coalesce(text, '')) AS file_hash, false AS failed
FROM documents WHERE doc_id // {ARCHIVED} % 5 < 3
UNION ALL SELECT DISTINCT doc_id // {ARCHIVED}, NULL, NULL, NULL, true FROM documents WHERE doc_id // {ARCHIVED} % 5 >= 3""",
)
def s14_runs(spark, d):
    """Archives written to the shared folder, their directories indexed, runs of members unpacked in tasks of their own."""
    archives = _archives(table(spark, d, "documents"), fresh_dir(spark, "zips"))
    found = members.read_members(archives, run_bytes=1 << 16)
    number = F.regexp_extract("path", r"(\d+)\.zip$", 1).cast("long")
    return found.select(number.alias("archive"), "member", "size", "file_hash", F.col("error").isNotNull().alias("failed"))


@query(
    "s7_page_tables",
    """WITH t AS (
  SELECT l_orderkey AS doc_id, l_linenumber, l_partkey, l_returnflag, l_quantity, count(*) OVER w AS n, count(*) FILTER (l_returnflag <> 'N') OVER w AS flags, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS INTEGER) AS row_no
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)
)
SELECT doc_id, 1 AS table_no, row_no, l_linenumber || '|' || l_partkey || CASE WHEN flags = 0 THEN '' WHEN l_returnflag = 'N' THEN '|' ELSE '|' || l_returnflag END || '|' || CAST(l_quantity AS BIGINT) AS cells FROM t WHERE n >= 2""",
)
def s7(spark, d):
    """A page of each order, its lines set in columns with blanks; the cell of the return flag N is left blank."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), "l_linenumber", "l_partkey", "l_suppkey", F.concat(F.rpad(F.col("l_linenumber").cast("string"), 4, " "), F.rpad(F.col("l_partkey").cast("string"), 12, " "), F.rpad(F.expr("IF(l_returnflag = 'N', '', l_returnflag)"), 5, " "), F.col("l_quantity").cast("long")).alias("line"))
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "line")))
    pages = items.groupBy("doc_id").agg(F.concat(F.lit("Lines of an order\n"), F.array_join(F.transform(lines, lambda x: x["line"]), "\n"), F.lit("\nend of the page")).alias("page")).withColumn("page_number", F.lit(1))
    found = page_tables.page_tables(pages)
    return found.select("doc_id", "table_no", "row_no", F.array_join("cells", "|", "").alias("cells"))


@query(
    "d2_d10_one_change",
    oracle(
        "publications qa_issues",
        """WITH p AS (SELECT publication_id, status AS old_status, CASE WHEN status = 'validated' THEN 'written' ELSE status END AS new_status FROM d_publications),
        i AS (SELECT publication_id, count(*) AS n FROM d_qa_issues GROUP BY 1)
        SELECT publication_id, old_status, new_status, coalesce(n, 0) AS old_issues, CASE WHEN old_status = 'validated' THEN 0 ELSE coalesce(n, 0) END AS new_issues FROM p LEFT JOIN i USING (publication_id)""",
    ),
)
def one_change(spark, d):
    """Publications are marked and their issues replaced in one change; the version before it is read beside the new one."""
    store = snapshots.Store(spark, fresh_dir(spark, "store"))
    publications, issues = table(spark, d, "publications").select("publication_id", "status"), table(spark, d, "qa_issues").select("publication_id", "code")
    old = store.pin(store.commit({"publications": publications, "qa_issues": issues}))
    done = old["publications"].where("status = 'validated'")
    marked = old["publications"].withColumn("status", F.when(F.col("status") == "validated", "written").otherwise(F.col("status")))
    new = store.pin(store.commit({"publications": marked, "qa_issues": old["qa_issues"].join(done, "publication_id", "left_anti")}, old))

    def side(version, name):
        n = version["qa_issues"].groupBy("publication_id").agg(F.count("*").alias(f"{name}_issues"))
        return version["publications"].withColumnRenamed("status", f"{name}_status").join(n, "publication_id", "left").fillna(0, [f"{name}_issues"])

    return side(old, "old").join(side(new, "new"), "publication_id").select("publication_id", "old_status", "new_status", "old_issues", "new_issues")


@query(
    "m2_usage",
    """WITH t AS (SELECT conv_id % 5 AS batch, coalesce(length(text), 0) AS n, turn FROM conversations),
    s AS (SELECT batch, count(*) AS calls, CAST(sum(n) AS BIGINT) AS input, CAST(sum(n // 7) AS BIGINT) AS output, CAST(sum(CASE WHEN turn % 2 = 1 THEN n // 2 ELSE 0 END) AS BIGINT) AS cache_read, CAST(sum(CASE WHEN turn % 2 = 0 THEN n // 3 ELSE 0 END) AS BIGINT) AS cache_creation FROM t GROUP BY batch)
    SELECT *, CASE WHEN input + cache_read + cache_creation > 0 THEN cache_read / (input + cache_read + cache_creation) END AS hit_ratio,
           ((input + cache_read * 0.1::DOUBLE + cache_creation * 1.25::DOUBLE) * 3.0::DOUBLE + output * 15.0::DOUBLE) / 1000000 AS cost FROM s""",
)
def m2(spark, d):
    """Tokens by the lengths of turns: answers of odd turns read the cache, those of even turns write it."""
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    said = F.struct(n.alias("input_tokens"), F.floor(n / 7).alias("output_tokens"), F.when(F.col("turn") % 2 == 1, F.floor(n / 2)).alias("cache_read_input_tokens"), F.when(F.col("turn") % 2 == 0, F.floor(n / 3)).alias("cache_creation_input_tokens"))
    calls = table(spark, d, "conversations").select((F.col("conv_id") % 5).alias("batch"), said.alias("usage"))
    return requests.usage(calls, "batch")
