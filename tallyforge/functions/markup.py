"""HTML functions on the standard library's tokenizer, as batched columns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
NOISY = ("script", "style", "nav", "header", "footer", "aside", "noscript", "form", "iframe")
LINK_SUFFIXES = (".pdf", ".rar", ".zip", ".doc", ".docx", ".xls", ".xlsx", ".csv", ".txt")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ENDS_ITSELF = frozenset("p li tr td th option".split())
_DEEPEST = 150


class Element:
    __slots__ = ("name", "attributes", "content")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name, self.attributes, self.content = name, attributes or {}, []

    def all(self, name: str | None = None) -> Iterator[Element]:
        """Descendants in document order."""
        stack = [c for c in reversed(self.content) if isinstance(c, Element)]
        while stack:
            e = stack.pop()
            if name is None or e.name == name:
                yield e
            stack += [c for c in reversed(e.content) if isinstance(c, Element)]

    def first(self, name: str) -> Element | None:
        return next(self.all(name), None)

    def texts(self, skip: tuple[str, ...] = ()) -> Iterator[str]:
        stack = list(reversed(self.content))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                yield c
            elif c.name not in skip:
                stack += reversed(c.content)

    def text(self) -> str:
        """Text with each piece stripped, pieces joined."""
        return "".join(t.strip() for t in self.texts(("script", "style")))

    def has_class(self, name: str) -> bool:
        return name in self.attributes.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("#document")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_ITSELF:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].name == tag or tag in ("td", "th") and self.open[k].name in ("td", "th"):
                    del self.open[k:]
                    break
                if self.open[k].name in ("table", "ul", "ol", "div", "tbody", "body") or self.open[k].name == "tr" and tag != "tr":
                    break
        e = Element(tag, {k: v or "" for k, v in reversed(attrs)})
        self.open[-1].content.append(e)
        if tag not in _VOID and len(self.open) < _DEEPEST:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].content.append(Element(tag, {k: v or "" for k, v in reversed(attrs)}))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].content.append(data)


def tree(page: str) -> Element:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def message_text(page: str | None) -> str:
    """Text of main, else article, else body, else all, a line per piece, noisy elements dropped."""
    if not page or not page.strip():
        return ""
    root = tree(page)

    def wanted(e: Element, name: str) -> Element | None:
        for c in e.content:
            if isinstance(c, Element) and c.name not in NOISY:
                found = c if c.name == name else wanted(c, name)
                if found is not None:
                    return found
        return None

    part = wanted(root, "main") or wanted(root, "article") or wanted(root, "body") or root
    lines = (line.strip() for t in part.texts(NOISY) for line in t.splitlines())
    return "\n".join(line for line in lines if line)


def document_links(page: str | None, base: str | None) -> list[str]:
    """Absolute addresses of linked documents, each once, in order."""
    if not page:
        return []
    found: dict[str, None] = {}
    for a in tree(page).all("a"):
        href = a.attributes.get("href", "").strip()
        if not href or re.match(r"#|mailto:|javascript:", href):
            continue
        try:
            address = urljoin(base or "", href)
            path = urlparse(address).path.lower()
        except ValueError:
            continue
        if path.endswith(LINK_SUFFIXES):
            found.setdefault(address)
    return list(found)


def unwrapped(page: str, *markers: str) -> str:
    """A page shown as its own source, which lacks a marker itself, gives that source."""
    if all(m in page for m in markers):
        return page
    shown = "".join(tree(page).texts(("script", "style")))
    return shown if markers[-1] in shown else page


def search_results(page: str | None) -> list[tuple[str, str, str]]:
    """(id, text, address) of each link to a company."""
    if not page:
        return []
    out = []
    for a in tree(unwrapped(page, "<a", "company.aspx")).all("a"):
        href = a.attributes.get("href", "").strip()
        if m := re.search(r"company\.aspx\?id=(\d+)", href):
            out.append((m[1], a.text(), href))
    return out


LISTING = T.StructType(
    [
        T.StructField("rows", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("file_id", "href", "type_label", "period_text", "fallback_label", "date_text")]))),
        T.StructField("warnings", T.ArrayType(T.StringType())),
    ]
)


def listing(page: str | None) -> tuple[list[tuple], list[str]]:
    """Raw cells of each file row of a listing page, and warnings; dates and periods are columns' work.

    A row needs six cells, a file link with href and data-fileid; a page
    without the files table has no rows and no warning, an empty one a warning.
    """
    if not page or not page.strip():
        return [], ["empty html"]
    files = next((t for t in tree(unwrapped(page, "<table")).all("table") if t.has_class("files-table")), None)
    if files is None:
        return [], []
    rows, warnings = [], []
    body = files.first("tbody") or files
    for tr in body.all("tr"):
        cells = list(tr.all("td"))
        if not cells:
            continue
        if len(cells) < 6:
            warnings.append(f"row with only {len(cells)} cells")
            continue
        label = cells[1].text()
        anchors = list(tr.all("a"))
        link = next((a for a in anchors if a.has_class("file-link")), None) or next((a for c in cells if c.has_class("file-cell") for a in c.all("a")), None)
        if link is None:
            warnings.append(f"row without file link: {label[:80]}")
            continue
        href, file_id = (link.attributes.get(k, "").strip() for k in ("href", "data-fileid"))
        if not href or not file_id:
            warnings.append(f"row with empty href/data-fileid: {label[:80]}")
            continue
        fallback = " ".join(x for x in (link.text(), link.attributes.get("title", "").strip(), label) if x)
        rows.append((file_id, href, label, cells[2].text(), fallback, cells[-3].text()))
    return rows, warnings


def _column(kind, function, page: Column) -> Column:
    @F.pandas_udf(kind)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([function(None if pd.isna(v) else v) for v in s], dtype=object)

    return run(page)


def message_text_column(page: Column) -> Column:
    return _column(T.StringType(), message_text, page)


def document_links_column(page: Column, base: Column) -> Column:
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for pages, bases in parts:
            yield pd.Series([document_links(None if pd.isna(p) else p, None if pd.isna(b) else b) for p, b in zip(pages, bases, strict=True)], dtype=object)

    return run(page, base)


def search_results_column(page: Column) -> Column:
    def run(p):
        return [list(x) for x in search_results(p)]

    return _column(T.ArrayType(T.ArrayType(T.StringType())), run, page)


def listing_column(page: Column) -> Column:
    @F.pandas_udf(LISTING)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = LISTING["rows"].dataType.elementType.names
        for s in parts:
            found = [listing(None if pd.isna(p) else p) for p in s]
            yield pd.DataFrame({"rows": [[dict(zip(names, r, strict=True)) for r in rows] for rows, _ in found], "warnings": [w for _, w in found]})

    return run(page)
