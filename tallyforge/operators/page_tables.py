"""Tables in the text of a page (S7), by the blanks that its lines share.

Lines with cells (runs of two blanks within) that follow one another are a
table. Cells are intervals of characters; intervals that overlap or are less
than two blanks apart over all lines of a table are one column. A page is a row,
so both steps are functions of its arrays: nothing is shuffled or sorted but the
cells of a table, in their task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: blanks that part two cells
GAP = 2


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; named twice within a lambda it would be computed twice."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _cells(line: Column) -> Column:
    """The cells of a line: first and last character (without it), text."""

    def cell(piece: Column, start: Column) -> Column:
        text = F.regexp_replace(piece, r"^\s+|\s+$", "")
        first = start + F.length(piece) - F.length(F.ltrim(piece))
        return _bound(F.struct(first.alias("first"), text.alias("cell")), lambda c: F.struct(c["first"].alias("first"), (c["first"] + F.length(c["cell"])).alias("last"), c["cell"].alias("cell")))

    def cells(pieces: Column) -> Column:
        starts = F.transform(pieces, lambda p, i: F.aggregate(F.slice(pieces, 1, i), F.lit(0), lambda n, q: n + F.length(q)))
        return F.filter(F.zip_with(pieces, starts, cell), lambda c: c["cell"] != "")

    return _bound(F.split(line, r"(?<=  )(?=\S)"), cells)


def lines_of_cells(pages: DataFrame) -> DataFrame:
    """The lines of each page that have two cells or more, in an array of (line, cells: first, last, cell).

    A tab counts as two blanks.
    """
    texts = F.split(F.replace(F.col("page"), F.lit("\t"), F.lit("  ")), "\r?\n")
    numbered = F.filter(F.transform(texts, lambda t, i: F.struct(i.alias("line"), t.alias("text"))), lambda x: x["text"].rlike(r"\S {2,}\S"))
    held = pages.select("doc_id", "page_number", numbered.alias("lines")).where(F.size("lines") > 0)
    return held.withColumn("lines", F.transform("lines", lambda x: F.struct(x["line"].alias("line"), _cells(x["text"]).alias("cells"))))


def _column_starts(lines: Column) -> Column:
    """Where the columns of a table begin: at each cell two blanks or more behind all cells that begin before it."""
    places = F.array_sort(F.flatten(F.transform(lines, lambda x: F.transform(x["cells"], lambda c: F.struct(c["first"].alias("first"), c["last"].alias("last"))))))
    none = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(-GAP).alias("reached"))

    def further(found: Column, c: Column) -> Column:
        starts = F.when(c["first"] - found["reached"] >= GAP, F.array_append(found["starts"], c["first"])).otherwise(found["starts"])
        return F.struct(starts.alias("starts"), F.greatest(found["reached"], c["last"]).alias("reached"))

    return F.aggregate(places, none, further, lambda found: found["starts"])


def page_tables(pages: DataFrame, least_rows: int = 2) -> DataFrame:
    """doc_id, page_number, table_no, row_no, cells: the tables of each page in order, numbers from 1.

    A cell that a row lacks is null; a table has ``least_rows`` lines and two
    columns or more. Pages without tables, empty and null ones have no rows.
    """
    page = ["doc_id", "page_number"]
    found = lines_of_cells(pages)
    # a table begins where the line before has no cells
    first_lines = F.filter(F.transform("lines", lambda x, i: F.when((i == 0) | (x["line"] - F.get("lines", F.greatest(i - 1, F.lit(0)))["line"] > 1), i)), lambda i: i.isNotNull())
    begun = found.select(*page, "lines", first_lines.alias("begins"))
    spans = F.transform("begins", lambda b, k: F.struct(b.alias("begin"), (F.coalesce(F.get("begins", k + 1), F.size("lines")) - b).alias("n")))
    held = begun.select(*page, F.transform(F.filter(spans, lambda x: x["n"] >= least_rows), lambda x: F.slice("lines", x["begin"] + 1, x["n"])).alias("tables"))
    columned = F.transform("tables", lambda t: F.struct(t.alias("lines"), _column_starts(t).alias("starts")))
    tables = held.select(*page, F.posexplode(F.filter(columned, lambda t: F.size(t["starts"]) >= 2)).alias("table", "t"))
    rows = tables.select(*page, (F.col("table") + 1).alias("table_no"), "t.starts", F.posexplode("t.lines").alias("row", "r"))

    def column(start: Column, k: Column) -> Column:
        end = F.get("starts", k + 1)
        inside = F.filter("r.cells", lambda c: (c["first"] >= start) & (end.isNull() | (c["first"] < end)))
        return F.when(F.size(inside) > 0, F.array_join(F.transform(inside, lambda c: c["cell"]), " "))

    return rows.select(*page, "table_no", (F.col("row") + 1).alias("row_no"), F.transform("starts", column).alias("cells"))
