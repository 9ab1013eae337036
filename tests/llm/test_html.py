import re
import time
from collections import Counter, defaultdict
from html import unescape

import pytest

from tallyforge.llm import html


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        ("<nav>menu</nav><article><h1>T &amp; t</h1><p>one  two\nthree<p>four<b>bold<br>x</p></article><footer>f</footer>", "T & t\none two three\nfourbold x"),
        ("<body><p><b>Head<br><p>Body &lt;i&gt; &eacute;&#8217;</body>", "Head\nBody <i> é’"),
        ("<article>a<div class='ad-box x'>stays where nothing recurs</div>b<script>var t='</p>';</script><aside>s</aside><form><p>f</p></form>c</article>", "a\nstays where nothing recurs\nb\nc"),
        ("<main><ul><li>1<li>2</ul><table><tr><td>x<td>y</table></main>", "1\n2\nx\ny"),
        ("<article><p>short</p></article><article><p>the longer one of both</p></article>", "short\nthe longer one of both"),
        ("<main><h1>T</h1><p>intro</p><article><p>body</p></article><p>closing</p></main>", "T\nintro\nbody\nclosing"),
        ("<article><p class='notice'>a</p><div id='social'>b</div><div class='related-work'>c</div><section id='banner-history'>d</section><ul class='menu'><li>e</ul><p>f <a class='share'>see</a> g</p></article>", "a\nb\nc\nd\ne\nf see g"),
        ('a <a href="x>link</a> tail', "a link tail"),
        ('a <a title="x>y" href=\'>\'>link</a> <b data-x=5"6>tail</b>', "a link tail"),
        ("<article><header><h1>T</h1></header><p>x</p><footer>by</footer></article>", "T\nx"),
        ("a <b", "a"),
        ("a < b", "a < b"),
        ("<div role=navigation>n</div><div style='display: none'>h</div><div hidden>h</div><p>x", "x"),
        ("<p>a<!-- c --><![CDATA[d]]>&nbsp;&nbsp;b", "ad b"),
        ("<p>a < b and <3 c", "a < b and <3 c"),
        ("<p>a</p></div></article></p><p>b", "a\nb"),
        ("<title>t</title><textarea>no</textarea>yes", "yes"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
        ("<script>never closed <p>x", ""),
    ],
)
def test_extract(page, text):
    assert html.extract(page) == text


def page(host, k, extra=""):
    return f"<html><body><div><p>Site slogan of {host}</p><ul><li>Home</li></ul></div><div><p>Story number {k} of {host}.</p></div>{extra}</body></html>"


def test_templates_go_where_no_article_is_marked(spark):
    rows = [(k, f"http://a.example/{k}", page("a", k)) for k in range(30)] + [(100 + k, f"http://b.example/{k}", page("b", k)) for k in range(3)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story number 3 of a."
    assert got[101] == "Site slogan of b\nHome\nStory number 1 of b.", "three pages are too few to tell"


def test_articles_that_recur_stay(spark):
    rows = [(k, "http://a.example/x", "<nav>m</nav><article><p>The same story.</p></article>") for k in range(40)]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"The same story."} and len(got) == 40


def test_pages_that_are_all_template_stay(spark):
    rows = [(k, "http://a.example/x", "<div><p>Same page.</p></div>") for k in range(40)]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"Same page."}


def test_hard_rows(spark):
    rows = [(1, None, None), (None, "http://x.example", "<p>a"), (2, "no url", ""), (2, "no url", ""), (3, "http://x.example", "<p>" + "word " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS text", "'c' AS host", "1 AS row_key", "'k' AS key")
    got = html.main_text(df).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert {(r.page_id, r.text[:4]) for r in got} == {(1, ""), (None, "a"), (2, ""), (3, "word")}
    assert html.main_text(df.where("false")).count() == 0


def test_provided_pages_lose_nothing_of_their_articles(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in html.main_text(spark.createDataFrame(rows)).collect()}
    assert sum(r.n_templates for r in got.values()) > 0
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        lines = [" ".join(unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", part))).split()) for part in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(x for x in lines if x)


def test_provided_pages(spark):
    got = html.main_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    assert len(got) == 50 and all(r.text and "track(" not in r.text and "©" not in r.text for r in got)
    assert not any(line != " ".join(line.split()) or not line for r in got for line in r.text.split("\n"))


def test_hosts(spark):
    urls = [("http://User@A.example:80/x", "a.example"), ("https://b.example?q", "b.example"), ("x", ""), (None, "")]
    df = spark.createDataFrame(urls, "url string, host string")
    assert df.where(html.host_of(df.url) != df.host).count() == 0


def test_templates_within_articles_go_and_reprints_stay(spark):
    def story(k):
        return f"<article><h2>Summary</h2><p>Story number {k} has a text that is longer than what the site adds.</p><div><p>Read us daily.</p></div></article>"

    rows = [(k, f"http://a.example/{k}", story(k)) for k in range(30)]
    # one section among many, and a reprint of which every copy has another last line
    rows += [(100 + k, f"http://b.example/{'news' if k < 10 else f's{k}'}/{k}", story(k) if k < 10 else f"<article><p>Other text {k}.</p></article>") for k in range(100)]
    rows += [(300 + k, f"http://c.example/{k}", f"<article><p>The same long story on every page.</p><p>Copy {k}.</p></article>") for k in range(30)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == got[103] == "Summary\nStory number 3 has a text that is longer than what the site adds."
    assert got[307] == "The same long story on every page.\nCopy 7."
    assert len(got) == len(rows)


def test_main_keeps_what_is_beside_its_articles():
    assert html.extract("<main><h1>T</h1><article><p>one</p></article><p>between</p><article><p>the second</p></article></main>") == "T\none\nbetween\nthe second"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div><article>" + "<div>" * 250 + "a" + "</div>" * 250 + "<p>b</p></article></div>", "a\nb"),
        ("<article>a" + "<div>" * 300 + "<nav>menu</nav><aside>x</aside><form>y</form>" + "</div>" * 300 + "b</article>", "a\nb"),
        ("<font>" * 200 + "<span>" * 200 + "<article>a</article>", "a"),
        ("<b>" * 100_000 + "<article>" + "<i>" * 100_000 + "a<p>b</b></p><li>c" + "</q></i>" * 50_000 + "</article>", "a\nb\nc"),
    ],
)
def test_no_depth_is_too_deep(page, text):
    assert html.extract(page) == text
    assert html.extract(page, frozenset((2,))) == text


@pytest.mark.parametrize("part", ["<a ", '<a href="', "<a b='", "<a x=\"'", "</a ", "<", "<!", "<![CDATA[", "<script>", "</title ", "a=b ", "<div class=ad>x", "</p>", "<title>", "&"])
def test_time_is_linear(part):
    def seconds(n):
        best = 1e9
        for _ in range(2):
            start = time.perf_counter()
            html.extract("<title></title><p>" + part * (n // len(part)))
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(400_000) < 3 and seconds(400_000) < 24 * seconds(50_000) + 0.2


def test_a_megabyte_of_open_tags():
    start = time.perf_counter()
    html.extract("<a " * 350_000)
    assert time.perf_counter() - start < 2


def brute_templates(rows, min_pages=5, min_share=0.2):
    """Numbers of the templates of each site, counted one by one."""
    contents, found = defaultdict(dict), {}
    for _, url, text in rows:
        m = re.match(r"[a-z]+://([^/?#]*)((?:/[^/?#]+(?=/))?)", url)
        page = html.analysed(text)
        for site in {(m[1], ""), (m[1], m[2])}:
            contents[site].setdefault(page.content, set(page.keys))
    for site, pages in contents.items():
        n = Counter(key for keys in pages.values() for key in keys)
        found[site] = {key for key, c in n.items() if c >= min_pages and c >= min_share * len(pages)}
    return found, {site: len(pages) for site, pages in contents.items()}


def test_templates_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [(10_000 + k, f"http://s.example/{'a' if k % 2 else 'b'}/{k}", f"<div class='ad'>Buy {k % 7}</div><article><p>Story {k} goes on for some time.</p><div class=comments><p>I {k} say</p></div><p>Read us{' daily' * (k % 2)}.</p></article>") for k in range(40)]
    got = {r.page_id: r for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    found, contents = brute_templates(rows)
    wide = Counter(key for keys in found.values() for key in keys if key % 2)
    total = 0
    for page_id, url, text in rows:
        m = re.match(r"[a-z]+://([^/?#]*)((?:/[^/?#]+(?=/))?)", url)
        page = html.analysed(text)
        dead = (found[m[1], ""] | found[m[1], m[2]]) & set(page.keys)
        if contents[m[1], ""] < 5:
            dead |= {key for key in page.keys if wide[key] >= 3}
        assert got[page_id].n_templates == len(dead)
        assert got[page_id].text == page.text(frozenset(dead))
        total += len(dead)
    assert total > 500
    assert got[10_003].text == "Story 3 goes on for some time."


def test_marks_count_where_they_recur(spark):
    def story(k, extra=""):
        return f"<article><p>Story number {k} of this host is told here.</p>{extra}</article>"

    rows = [(k, f"http://a.example/{k}", story(k, f"<div class='x share'>Tell {k} friends</div>")) for k in range(10)]
    rows += [(100 + k, f"http://b.example/{k}", story(k, "<p class=notice>No smoking.</p>" if k == 3 else "")) for k in range(30)]
    rows += [(200 + 10 * h + k, f"http://h{h}.example/{k}", story(k, f"<div id='comments'><p>Reader {k}</p></div>")) for h in range(3) for k in range(6)]
    rows += [(300, "http://small.example/1", story(0, "<div id='comments'><p>A reader's word</p></div><p class=notice>Open on Sunday.</p>"))]
    rows += [(400 + k, f"http://d.example/{k}", f"<div class='page sidebar-left'><p>All of story {k} of a page without an article.</p></div>") for k in range(9)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4] == "Story number 4 of this host is told here."
    assert got[103] == "Story number 3 of this host is told here.\nNo smoking."
    assert got[212] == "Story number 2 of this host is told here."
    assert got[300] == "Story number 0 of this host is told here.\nOpen on Sunday."
    assert got[404] == "All of story 4 of a page without an article."


def test_kinds_go_whatever_their_size_and_host(spark):
    long = "A reader has more to say than the story. " * 40

    def story(k, extra):
        return f"<article><h1>Story {k}</h1><p>It is told in a few words.</p>{extra}</article>"

    rows = [(k, f"http://a.example/{k}", story(k, f"<section class='comments'><p>{'Short.' if k != 30 else long}</p></section>")) for k in range(40)]
    # a host of four pages, and one of one page, where the same kinds have other names
    rows += [(100 + k, f"http://b.example/{k}", story(k, f"<div class='sidebar'>S</div><div class='cookie-notice'>C {k}</div>")) for k in range(4)]
    rows += [(200, "http://c.example/1", story(1, f"<div id='reader-comments' class='x7'>{long}</div>"))]
    rows += [(300 + k, f"http://d{k}.example/1", story(k, "<div class='left-sidebar'>More</div><p class='notice'>N</p>")) for k in range(6)]
    # words that say something else of an element
    rows += [(400, "http://e.example/1", "<article><h1>T</h1><div class='content with-sidebar has-comments'><p>All of the story.</p></div></article>")]
    rows += [(401, "http://e.example/2", "<div class='comments'><article><h1>U</h1><p>A story in a frame.</p></article></div>")]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in (3, 30):
        assert got[k] == f"Story {k}\nIt is told in a few words."
    assert got[102] == "Story 2\nIt is told in a few words."
    assert got[200] == "Story 1\nIt is told in a few words."
    assert got[304] == "Story 4\nIt is told in a few words."
    assert got[400] == "T\nAll of the story." and got[401] == "U\nA story in a frame."


def test_passages_that_many_articles_share_stay(spark):
    rows = [(k, f"http://a.example/{k}", f"<article><p>Story {k} of the host.</p>" + ("<p>A licence that many quote.</p>" if k % 3 == 0 else "") + "<p>Read us daily.</p></article>") for k in range(60)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story 3 of the host.\nA licence that many quote." and got[4] == "Story 4 of the host."


def test_texts_of_many_batches_and_files(spark, monkeypatch):
    monkeypatch.setattr(html, "TOGETHER", 3)
    rows = [(k, f"http://a.example/{k}", f"<article><p>Story {k} is told.</p><p>Read us daily.</p></article>") for k in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in html.main_text(df).collect()}
    assert got == {k: f"Story {k} is told." for k in range(50)}
