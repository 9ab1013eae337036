"""Documents and their pages: kinds, routing, joins of page sources, budgets, recurring lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.text import strip

CLASSIFICATION = "array<struct<page:int,chars:int,kind:string>>"


def _kind(mime: Column, path: Column, mimes: tuple[str, ...], suffixes: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for m in mimes:
        found = found | F.coalesce(F.startswith(F.lower(mime), F.lit(m)), F.lit(False))
    for s in suffixes:
        found = found | F.coalesce(F.endswith(F.lower(path), F.lit(s)), F.lit(False))
    return found


def is_pdf(mime: Column, path: Column) -> Column:
    return _kind(mime, path, ("application/pdf",), (".pdf",))


def is_rtf(mime: Column, path: Column) -> Column:
    return _kind(mime, path, ("application/rtf", "text/rtf"), (".rtf",))


def kind_for_extraction(mime: Column, path: Column) -> Column:
    """Pdf is asked before rtf."""
    return F.when(is_pdf(mime, path), "pdf").when(is_rtf(mime, path), "rtf")


def kind_for_classification(mime: Column, path: Column) -> Column:
    """Rtf is asked before pdf."""
    return F.when(is_rtf(mime, path), "rtf").when(is_pdf(mime, path), "pdf")


def scan_pages(classification: Column) -> Column:
    """P10: pages of kind scan from the stored JSON; anything else gives none."""
    parsed = F.from_json(classification, CLASSIFICATION)
    kept = F.filter(parsed, lambda p: (p["kind"] == "scan") & p["page"].isNotNull())
    return F.coalesce(F.transform(kept, lambda p: p["page"]), F.array().cast("array<int>"))


def extraction_method(documents: DataFrame) -> DataFrame:
    """How each document is read; other kinds, unclassified and missing files are skipped with a reason.

    Columns: mime_type, relative_path, is_machine_readable, scan_pages_count, exists.
    """
    kind = kind_for_extraction(F.col("mime_type"), F.col("relative_path"))
    method = (
        F.when(kind.isNull(), "skip:kind")
        .when((kind == "pdf") & F.col("is_machine_readable").isNull(), "skip:unclassified")
        .when(~F.col("exists"), "skip:missing")
        .when(kind == "rtf", "rtf_native")
        .when((F.col("is_machine_readable") == 1) & (F.coalesce("scan_pages_count", F.lit(0)) > 0), "native+ocr")
        .when(F.col("is_machine_readable") == 1, "native")
        .otherwise("ocr")
    )
    return documents.withColumn("method", method)


def request_route(documents: DataFrame, threshold: float = 0.1, pdf_standards: tuple[str, ...] = ("IFRS",)) -> DataFrame:
    """Vision, pdf or text for a publication's first document.

    Columns: use_vision, reporting_standard, n_chosen, is_machine_readable,
    page_count, scan_pages_count, exists. Without pages all count as scans.
    """
    ratio = F.coalesce(F.try_divide(F.coalesce("scan_pages_count", F.lit(0)), F.coalesce("page_count", F.lit(0))), F.lit(1.0))
    single = (F.col("n_chosen") == 1) & F.col("exists")
    vision = F.coalesce(F.col("use_vision"), F.lit(False)) & F.col("reporting_standard").isin("RSBU", "ISSUER") & single
    pdf = single & (F.coalesce("is_machine_readable", F.lit(0)) == 1) & (ratio <= threshold) & F.col("reporting_standard").isin(*pdf_standards)
    return documents.withColumn("scan_ratio", ratio).withColumn("route", F.when(vision, "vision").when(pdf, "pdf").otherwise("text"))


def preferred_standard(documents: DataFrame, order: tuple[str, ...] = ("IFRS", "RSBU", "ISSUER")) -> DataFrame:
    """All documents of a publication's first standard in ``order``."""
    at = F.array_position(F.lit(list(order)), F.col("reporting_standard"))
    listed = documents.where(F.col("reporting_standard").isin(*order)).withColumn("_at", at)
    best = listed.groupBy("publication_id").agg(F.min("_at").alias("_best"))
    return listed.join(best, "publication_id").where("_at = _best").drop("_at", "_best")


def primary_flags(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """The least chosen document of a publication is its only primary one; other publications keep theirs."""
    best = chosen.groupBy("publication_id").agg(F.min("document_id").alias("_primary"))
    j = documents.join(best, "publication_id", "left")
    return j.withColumn("is_primary", F.when(F.col("_primary").isNotNull(), F.col("document_id") == F.col("_primary")).otherwise(F.col("is_primary"))).drop("_primary")


def overlay_pages(native: DataFrame, ocr: DataFrame) -> DataFrame:
    """Pages that were read by OCR replace the native ones, and lose their tables."""
    o = ocr.select("doc_id", "page_number", F.col("page").alias("_ocr"))
    j = native.join(o, ["doc_id", "page_number"], "left")
    return j.select("doc_id", "page_number", F.coalesce("_ocr", "page").alias("page"), F.when(F.col("_ocr").isNull(), F.col("tables")).alias("tables"))


def with_tables(pages: DataFrame, tables: DataFrame) -> DataFrame:
    """J9."""
    return pages.join(tables, ["doc_id", "page_number"], "left")


def within_budget(pages: DataFrame, max_chars: int) -> DataFrame:
    """Pages up to a total of characters; the page that crosses it is cut, later ones go.

    ``truncated`` is true for all pages of a document that lost anything.
    """
    before = F.coalesce(F.sum(F.length("page")).over(Window.partitionBy("doc_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = Window.partitionBy("doc_id")
    used = pages.withColumn("before", before)
    gone = (F.col("before") >= max_chars) | (F.col("before") + F.length("page") > max_chars)
    marked = used.withColumn("truncated", F.max(gone).over(every))
    return marked.where(F.col("before") < max_chars).select("doc_id", "page_number", F.left("page", (F.lit(max_chars) - F.col("before")).cast("int")).alias("page"), "truncated")


def line_frequency(pages: DataFrame, longest: int = 120) -> DataFrame:
    """On how many pages of its document each short line stands."""
    lines = pages.select("doc_id", "page_number", F.explode(F.array_distinct(F.transform(F.split("page", "\n"), strip))).alias("line"))
    short = lines.where((F.col("line") != "") & (F.length("line") <= longest))
    return short.groupBy("doc_id", "line").agg(F.count_distinct("page_number").alias("pages"))


def without_recurring(pages: DataFrame, least_pages: int = 3, longest: int = 120) -> DataFrame:
    """lines on more than half of the pages, and on ``least_pages``, are headers and footers."""
    n = pages.groupBy("doc_id").agg(F.count("*").alias("n"))
    recurring = line_frequency(pages, longest).join(n, "doc_id").where((F.col("n") >= least_pages) & (F.col("pages") >= F.greatest(F.lit(least_pages), F.floor(F.col("n") / 2) + 1)))
    dropped = recurring.groupBy("doc_id").agg(F.collect_set("line").alias("recurring"))
    j = pages.join(dropped, "doc_id", "left")
    kept = F.filter(F.split("page", "\n"), lambda x: ~F.array_contains(F.col("recurring"), strip(x)))
    page = F.when(F.col("recurring").isNull(), F.col("page")).otherwise(strip(F.array_join(kept, "\n")))
    return j.select("doc_id", "page_number", page.alias("page"))


def prompt_text(pages: DataFrame, head: Column) -> DataFrame:
    """a head line, then each page after its number."""
    one = F.concat(F.lit("--- page "), F.col("page_number"), F.lit(" ---\n"), F.col("page"))
    ordered = F.array_sort(F.collect_list(F.struct("page_number", one.alias("t"))))
    per = pages.groupBy("doc_id").agg(ordered.alias("parts"))
    return per.select("doc_id", F.concat_ws("\n", head, F.array_join(F.transform("parts", lambda p: p["t"]), "\n")).alias("prompt"))
