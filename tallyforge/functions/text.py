"""Text functions. Patterns take (?U) so that letters and blanks are Unicode's."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOFT_HYPHEN = "­"


def strip(value: Column) -> Column:
    """Without white space at both ends (trim() knows only spaces)."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def normalised(value: Column) -> Column:
    """narrow and fixed spaces become spaces, runs of blanks one, none at the ends. Composed input is assumed."""
    return strip(F.regexp_replace(F.translate(value, "   ", "   "), r"(?U)\s+", " "))


def short(value: Column, limit: int = 80) -> Column:
    """F4."""
    s = strip(value)
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.left(s, F.lit(limit)), F.lit("…")))


def occurrences(text: Column, marker: str) -> Column:
    """Number of occurrences that do not overlap."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(marker)))) / len(marker)).cast("int")


def marker_score(text: Column, markers: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    total = F.lit(0)
    for m in markers:
        total = total + occurrences(low, m)
    return total


def page_kind(text: Column, least: int) -> Column:
    """F8: a page with enough characters (blanks within count) has text, others are scans."""
    return F.when(F.length(strip(F.coalesce(text, F.lit("")))) >= least, "text").otherwise("scan")


def needs_retry(text: Column, short_chars: int = 80, enough_chars: int = 800, digit_share: float = 0.05) -> Column:
    """short pages, and mid-sized ones with few digits, are read again."""
    s = strip(F.coalesce(text, F.lit("")))
    n = F.length(s)
    digits = F.regexp_count(s, F.lit(r"\p{Nd}"))
    return F.when(n < short_chars, True).when(n >= enough_chars, False).otherwise(digits / n < digit_share)


def is_better(new: Column, old: Column) -> Column:
    return F.length(strip(F.coalesce(new, F.lit("")))) > F.length(strip(F.coalesce(old, F.lit(""))))


@F.pandas_udf(T.StringType())
def compatible(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """NFKC, which no built-in function gives."""
    for s in parts:
        yield s.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def cleaned(text: Column) -> Column:
    """F11 on NFKC text: hyphenated breaks joined, blanks and empty lines reduced, lines stripped."""
    t = F.coalesce(text, F.lit(""))
    t = F.regexp_replace(F.replace(t, F.lit(SOFT_HYPHEN)), "\r\n?", "\n")
    for pattern, by in ((r"(?U)(\w)[-‐-—]\n(\w)", "$1$2"), (r"[ \t]+\n", "\n"), (r"[ \t]{2,}", " "), (r"\n{3,}", "\n\n"), (r"(?Um)^[^\S\n]+|[^\S\n]+$", "")):
        t = F.regexp_replace(t, pattern, by)
    return strip(t)


def file_name(url: Column, default: str = "file") -> Column:
    """F16: last path segment, decoded; other characters than letters, digits, _ . - become _."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    last = F.regexp_extract(path, r"([^/]*)/*$", 1)
    safe = F.regexp_replace(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), r"(?U)[^\w.\-Ѐ-ӿ]", "_")
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit(default))


def looks_like_html(content_type: Column, path: Column) -> Column:
    """F17."""
    named = F.contains(F.lower(content_type), F.lit("text/html")) | F.contains(F.lower(content_type), F.lit("application/xhtml"))
    return F.coalesce(named, F.lit(False)) | F.coalesce(F.lower(path).rlike(r"\.html?$"), F.lit(False))


def unsafe_member(path: Column) -> Column:
    """empty or absolute paths and those with a parent segment."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.coalesce((p == "") | p.rlike(r"^(?:/|[A-Za-z]:)") | F.exists(F.split(p, "/"), lambda x: x == ".."), F.lit(True))


def safe_int(value: Column) -> Column:
    """whole numbers and booleans, else 0."""
    return F.coalesce(value.try_cast("int"), value.try_cast("boolean").try_cast("int"), F.lit(0))


def cache_key(*parts: Column) -> Column:
    """digest of all parts of a request; a null part differs from an empty one."""
    marked = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    return F.sha2(F.concat_ws("\u0000", *marked), 256)


def parsed_date(value: Column) -> Column:
    """the first of four layouts that fits; years have four digits."""
    v = strip(value)
    layouts = ("d.M.yyyy", "yyyy-M-d", "d/M/yyyy", "d-M-yyyy")
    checked = F.when(v.rlike(r"^(?:\d{1,2}[./-]\d{1,2}[./-]\d{4}|\d{4}-\d{1,2}-\d{1,2})$"), v)
    return F.coalesce(*(F.to_date(F.try_to_timestamp(checked, F.lit(x))) for x in layouts))


#: fixed values: units and their multipliers
UNITS = {"ones": 1.0, "thousands": 1e3, "millions": 1e6, "billions": 1e9}


def in_unit(value: Column, source: Column, target: Column) -> Column:
    """null stays null; an unknown unit of a value raises."""
    table = F.create_map(*(x for k, v in UNITS.items() for x in (F.lit(k), F.lit(v))))

    def multiplier(unit: Column) -> Column:
        return F.coalesce(F.try_element_at(table, unit), F.raise_error(F.concat(F.lit("unknown unit: "), F.coalesce(unit, F.lit("null")))).cast("double"))

    return F.when(value.isNotNull(), value * multiplier(source) / multiplier(target))
