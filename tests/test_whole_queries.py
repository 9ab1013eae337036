"""Queries that SQL cannot express, over whole tables, against plain Python of another make."""

import hashlib
import re
import unicodedata
from html import unescape
from urllib.parse import urljoin, urlsplit

import pytest

from tallyforge.plans import registry
from tallyforge.plans.domain import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    return {r.page_id: r for r in table(spark, SF, "pages").collect()}


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def run(spark, name):
    return registry.queries()[name](spark, SF).collect()


def test_message_text(spark, pages):
    def expected(page):
        inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        inside = re.sub(r"<(script|style|nav|header|footer|aside|noscript|form|iframe)\b.*?</\1>|<!--.*?-->", "\0", inside, flags=re.S)
        pieces = re.split(r"<[^>]*>|\0", inside)
        return "\n".join(line.strip() for p in pieces for line in unescape(p).splitlines() if line.strip())

    got = {r.page_id: r.text for r in run(spark, "s10_message_text")}
    assert got == {k: expected(r.html) for k, r in pages.items()}


def test_document_links(spark, pages):
    def expected(row):
        hrefs = re.findall(r"<a\b[^>]*?\bhref=[\"']([^\"']*)", row.html) + ["/files/report.pdf?x=1", "other.html"]
        found = (urljoin(row.url, unescape(h)) for h in hrefs if not h.startswith(("#", "mailto:", "javascript:")))
        return list(dict.fromkeys(f for f in found if re.search(r"\.(pdf|rar|zip|docx?|xlsx?|csv|txt)$", urlsplit(f).path.lower())))

    got = {r.page_id: r.links for r in run(spark, "s11_document_links")}
    assert got == {k: " ".join(expected(r)) for k, r in pages.items()} and all(got.values())


def test_search_results(spark, pages):
    got = sorted((r.page_id, r.id, r.name, r.href) for r in run(spark, "s12_search_results"))
    assert got == sorted((k, str(k), "Company", f"/portal/company.aspx?id={k}") for k in pages)


def test_section(spark, texts):
    heading = "1.4. Основные финансовые показатели"

    def expected(text):
        if text is None:
            return None, None, None, "empty_text"
        body = f"{heading}\n{text}\n"
        stops = [m.start() for m in re.finditer(r"^\s*2\s*\.\s+\S|^\s*1\s*\.\s*5[\s.]", body[len(heading) :], re.M)]
        warnings, name = [], "1.5"
        if stops:  # a line of the text that looks like the next section
            body = body[: len(heading) + stops[0]]
            name = None
        if len(body) > 20_000:
            body, warnings = body[:20_000], ["section_truncated"]
        if len(body) < 500:
            return None, heading[5:], name, ",".join([*warnings, "section_1_4_too_short"])
        return len(body), heading[5:], name, ",".join(warnings)

    got = {r.doc_id: (r.n, r.label, r.end_anchor, r.warnings) for r in run(spark, "f10_section")}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        n, label, name, warnings = expected(text)
        if name is not None or text is None:  # white space before the next heading belongs to its line
            assert got[k][1:] == (label, name, warnings) and (n is None) == (got[k][0] is None)
            assert n is None or n - got[k][0] <= len(text) - len(text.rstrip()) + 1


def test_cleaned(spark, texts):
    def expected(text):
        t = unicodedata.normalize("NFKC", text or "").replace("­", "").replace("\r\n", "\n").replace("\r", "\n")
        t = re.sub(r"(\w)[-‐-—]\n(\w)", r"\1\2", t)
        t = re.sub(r"[ \t]+\n", "\n", t)
        t = re.sub(r"[ \t]{2,}", " ", t)
        t = re.sub(r"\n{3,}", "\n\n", t)
        return "\n".join(line.strip() for line in t.split("\n")).strip()

    got = {r.doc_id: r.text for r in run(spark, "f11_cleaned")}
    assert got == {k: expected(t) for k, t in texts.items()}


def test_model_extraction(spark, texts):
    want = []
    for k, text in texts.items():
        if text is None:
            continue
        n = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
        if n % 17:
            want.append((f"EDX{k % 100}", str(k), "revenue", (n % 1000 + 1) * 1000.0))
            want.append((f"EDX{k % 100}", str(k), "net_income", None if n % 3 == 0 else (n % 77 - 5) * 1000.0))
    got = [(r.ticker, r.publication_id, r.metric_name, r.value) for r in run(spark, "m1_model_extraction")]
    assert sorted(got, key=str) == sorted(want, key=str)
