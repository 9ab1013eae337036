"""Discovery: listing pages to publication rows (S1), company lists (S3), name candidates."""

from __future__ import annotations

import difflib
import heapq
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.markup import listing_column
from tallyforge.functions.period import reporting_period
from tallyforge.functions.text import parsed_date


def parsed(pages: DataFrame) -> DataFrame:
    """One row per listing page with the parsed cells; columns: ticker, type_code, html."""
    return pages.select("ticker", "type_code", listing_column(F.col("html")).alias("listing"))


def publications(pages: DataFrame) -> DataFrame:
    """Rows with a date, keyed ticker-type-file; the period falls back on the link's text, title and label."""
    r = parsed(pages).select("ticker", "type_code", F.explode("listing.rows").alias("r"))
    dated = r.withColumn("publication_date", parsed_date(F.col("r.date_text"))).where("publication_date is not null")
    period = F.coalesce(reporting_period(F.col("r.period_text")), reporting_period(F.col("r.fallback_label")))
    p = dated.withColumn("period", period)
    return p.select(
        F.concat_ws("-", "ticker", "type_code", "r.file_id").alias("publication_id"),
        "ticker",
        F.lit("report").alias("publication_type"),
        "publication_date",
        F.col("r.href").alias("source_url"),
        F.col("type_code").alias("report_type_code"),
        F.nullif(F.col("r.type_label"), F.lit("")).alias("report_type_label"),
        F.col("period.year").alias("reporting_period_year"),
        F.col("period.period").alias("reporting_period_type"),
    )


def warnings(pages: DataFrame) -> DataFrame:
    """Structural warnings, unreadable dates and unknown periods."""
    p = parsed(pages)
    structural = p.select("ticker", "type_code", F.explode("listing.warnings").alias("warning"))
    r = p.select("ticker", "type_code", F.explode("listing.rows").alias("r"))
    date = parsed_date(F.col("r.date_text"))
    undated = r.where(date.isNull()).select("ticker", "type_code", F.concat(F.lit("unparseable publication_date for fileid="), F.col("r.file_id")).alias("warning"))
    known = F.coalesce(reporting_period(F.col("r.period_text")), reporting_period(F.col("r.fallback_label")))
    period = r.where(date.isNotNull() & known.isNull() & (F.col("r.period_text") != "")).select("ticker", "type_code", F.concat(F.lit("unrecognised reporting period for fileid="), F.col("r.file_id")).alias("warning"))
    return structural.unionByName(undated).unionByName(period)


COMPANY = "company_id string, name string, type string"


def companies(spark: SparkSession, path: str) -> DataFrame:
    """S3: id, name, type of a CSV; a row that is empty, unknown or malformed raises with its line."""
    body = spark.read.text(path).where(F.lower(F.trim("value")) != "id,name,type")
    row = F.from_csv("value", COMPANY, {"mode": "FAILFAST"})
    r = body.where(F.trim("value") != "").select("value", row.alias("r"))
    clean = r.select("value", F.trim("r.company_id").alias("company_id"), F.trim("r.name").alias("name"), F.lower(F.trim("r.type")).alias("type"))
    good = (F.coalesce("company_id", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != "") & F.coalesce(F.col("type").isin("bank", "non_bank"), F.lit(False))
    checked = F.when(good, F.col("company_id")).otherwise(F.raise_error(F.concat(F.lit("bad company row: "), "value")).cast("string"))
    return clean.select(checked.alias("company_id"), "name", "type", F.concat(F.lit("EDX"), "company_id").alias("ticker"))


def name_similarity(left: F.Column, right: F.Column) -> F.Column:
    """Ratio of matching blocks of two names; no built-in distance equals it."""

    @F.pandas_udf(T.DoubleType())
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in parts:
            yield pd.Series([difflib.SequenceMatcher(None, (x or "").lower().strip(), (y or "").lower().strip()).ratio() for x, y in zip(a, b, strict=True)], dtype=float)

    return run(left, right)


def best_names(pairs: DataFrame, n: int = 3) -> DataFrame:
    """Of each target's candidates (target, position, name) the ``n`` most alike, earlier ones first among equals."""
    scored = pairs.withColumn("score", name_similarity(F.col("target"), F.col("name")))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "position", "name"))), 1, n)
    per = scored.groupBy("target").agg(best.alias("best"))
    x = per.select("target", F.posexplode("best").alias("place", "b"))
    return x.select("target", (F.col("place") + 1).alias("place"), "b.name", "b.position", (-F.col("b.minus")).alias("score"))


class NameIndex:
    """Names in lower case as a tree of prefixes, a tree for each length, grown where a search comes.

    Matching blocks of two names follow one another in both, so they are a
    common subsequence: twice the length of the longest one over both lengths
    is never below the ratio. Of a node only the prefix is known; each character
    that a name may still have, or the target's at its end, counts as matched.
    Nodes are taken by this bound, those of earlier names first among equals, so
    a search ends once no name left can be among the best.
    """

    def __init__(self, names: list[tuple[int, str | None]], n: int):
        by_name: dict[str, list[tuple[int, str | None]]] = {}
        for position, name in sorted(names, key=lambda x: x[0]):
            same = by_name.setdefault((name or "").lower().strip(), [])
            if len(same) < n:  # of equal names only the first n can be among the best
                same.append((position, name))
        self.names = sorted(by_name, key=lambda low: (len(low), low))
        self.rows = [by_name[low] for low in self.names]
        self.first = np.array([same[0][0] for same in self.rows])
        self.n, self.scored, self.visited = n, 0, 0
        self.roots, at = [], 0
        while at < len(self.names):
            end = bisect_right(self.names, len(self.names[at]), at, key=len)
            self.roots.append(self._node(at, end, 0))
            at = end

    def _node(self, low: int, high: int, begin: int) -> list:
        """First position, range of names, characters from ``begin`` that all of them share, their end, children."""
        a, b, end = self.names[low], self.names[high - 1], begin
        while end < len(a) and a[end] == b[end]:
            end += 1
        return [int(self.first[low:high].min()), low, high, a[begin:end], end, None]

    def _children(self, node: list) -> list[list]:
        if node[5] is None:
            _, low, high, _, end, _ = node
            node[5] = []
            while low < high:
                to = bisect_right(self.names, self.names[low][end], low, high, key=lambda name: name[end])
                node[5].append(self._node(low, to, end))
                low = to
        return node[5]

    def best(self, target: str | None) -> list[tuple[float, int, str | None]]:
        """(minus ratio, position, name) of the ``n`` most alike, earlier ones first among equals."""
        low = (target or "").lower().strip()
        size, places = len(low), {}
        for i, c in enumerate(low):
            places[c] = places.get(c, 0) | 1 << i
        every, heap = (1 << size) - 1, []

        def reach(node: list, v: int) -> None:
            """The node with its bound; the zeros of ``v`` are the characters of the target that are matched."""
            for c in node[3]:
                own = v & places.get(c, 0)
                v = (v + own) | (v - own)
            v &= every
            whole = len(self.names[node[1]])
            rest = whole - node[4]
            most = size if rest >= size else (~v & (1 << size - rest) - 1).bit_count() + rest
            self.visited += 1
            heapq.heappush(heap, (-2.0 * most / (size + whole) if size + whole else -1.0, node[0], node[1], node[4], node, v))

        for root in self.roots:
            reach(root, every)
        m, best = difflib.SequenceMatcher(None, low, ""), []
        while heap:
            minus, first, at, _, node, v = heapq.heappop(heap)
            if len(best) == self.n and (minus, first) > best[-1][:2]:
                break
            if node[2] - at > 1:
                for child in self._children(node):
                    reach(child, v)
                continue
            m.set_seq2(self.names[at])
            self.scored += 1
            minus = -m.ratio()
            best += [(minus, position, name) for position, name in self.rows[at]]
            best.sort(key=lambda x: x[:2])
            del best[self.n :]
        return best


def _best_of_group(n: int):
    def run(names: pa.Table, targets: pa.Table) -> pa.Table:
        rows: list[tuple[str | None, int, str | None, float]] = []
        if names.num_rows:
            index = NameIndex(list(zip(names["position"].to_pylist(), names["name"].to_pylist(), strict=True)), n)
            for target in targets["target"].to_pylist():
                rows += [(target, position, name, -minus) for minus, position, name in index.best(target)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.float64()), strict=True)], names=["target", "position", "name", "score"])

    return run


def best_of_all(targets: DataFrame, names: DataFrame, n: int = 3, block_rows: int = 400_000, group_rows: int = 50_000, least_rows: int = 2_000) -> DataFrame:
    """J14 of every distinct target against all names (position, name): the result of ``best_names``.

    Names are dealt into blocks of about ``block_rows``; every group of targets
    meets each block once, in a task that indexes the block and visits only
    the prefixes whose bound may still enter the ``n`` best. Groups have about
    ``group_rows`` targets, or fewer (down to ``least_rows``) where that makes no
    more groups than shuffle partitions, as each block is sent to every group. What
    leaves a task is ``n`` rows a target. Only two counts come to the driver.
    """
    asked = targets.select("target").distinct()
    blocks = max(1, -(-names.count() // block_rows))
    rows, partitions = asked.count(), int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-rows // group_rows), min(partitions, -(-rows // least_rows)))
    dealt_names = names.select(F.col("position").cast("long"), "name", F.pmod(F.xxhash64("position", "name"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    dealt = asked.select("target", F.pmod(F.xxhash64("target"), F.lit(groups)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    scored = dealt_names.groupBy("block", "part").cogroup(dealt.groupBy("block", "part")).applyInArrow(_best_of_group(n), "target string, position long, name string, score double")
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "position", "name"))), 1, n)
    x = scored.groupBy("target").agg(best.alias("best")).select("target", F.posexplode("best").alias("place", "b"))
    return x.select("target", (F.col("place") + 1).alias("place"), "b.name", "b.position", (-F.col("b.minus")).alias("score"))
