"""Main text of web pages with site template removal (operator 10).

One pass parses every page and writes two things: hashes of its element
subtrees to a table, and its text as runs, each with the subtrees that it lies
in, to a file of its task. Spark counts on how many different contents of a
host, and of a host's section, each hash occurs; which subtrees of a page recur
on many goes to the file that holds the page, so no page is parsed twice and no
text is shuffled. An article may lawfully recur (mirrors, reprints), therefore
pages of the same content count once, an ``article`` or ``main`` as a whole is never
counted, and a page that templates would more than halve is a reprint with
changes and stays as it is. Passages that many articles share are text of the
articles: within them an unmarked subtree is a template only on half of the site.

Beside its exact hash, an element whose class or id has a word such as "ad" or
"comments" has a hash of its name, class and id alone. This mark is deleted only
if it recurs on the site like any other template; a word by itself decides
nothing. On hosts with too few pages to count, marks that are templates of
several other hosts are deleted. A class or id that names such a part alone
("reader-comments", "cookie-notice") also has its kind ("comments"), whatever
else it is called; a kind that recurs anywhere in the corpus is deleted on every
page, however large it is there.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import bound_batches, filesystem, fresh_dir, lean, stored

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)[^>\"'=]*>")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
BLANK = re.compile(r"\s+")
SPACES = re.compile(" +")
WORD = re.compile(r"[a-z0-9]+")

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
FORMATTING = frozenset("a b big code em font i nobr s small span strike strong tt u".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
# Elements that never hold main text.
NOISE = frozenset("script style noscript template iframe object embed svg canvas audio video map nav aside form button select textarea input dialog menu title head noembed noframes xmp footer".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words of a class or id that often mark what is not the article; they count only where they recur.
MARKS = frozenset("ad ads advert adverts advertisement advertising banner banners sponsor sponsored promo promotion cookie cookies consent gdpr notice notices sidebar menu menus nav navbar navigation breadcrumb breadcrumbs share sharing social related recommended comment comments discussion disqus replies newsletter subscribe signup login popup modal overlay footer masthead toolbar pagination pager widget skip".split())
# Words beside which a word of MARKS still names the part, and those that say something else of it.
BESIDE = frozenset("section list area box block wrapper wrap container thread item bar inner body widget reader user post article story news".split())
UNLIKE = frozenset("has with without no hide hidden toggle open count".split())
# Within an article these recur for other reasons: section titles, and cells and items of whole tables and lists.
PIECES = frozenset("h1 h2 h3 h4 h5 h6 header hgroup li dt dd tr td th option tbody thead tfoot caption figcaption summary".split())
SELF_NESTED = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
SIBLINGS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tfoot"), "tfoot": ("tbody", "thead", "tfoot"), "thead": ("tbody", "thead", "tfoot")}


@dataclass(slots=True)
class Node:
    tag: str
    noise: bool = False  # by the name of the element, its role, or because it is hidden
    mark: str = ""
    kind: str = ""
    parts: list[Node | str] = field(default_factory=list)
    key: bytes = b""


def kind_of(value: str) -> str:
    """The word of ``MARKS`` that a class or id names an element by; empty if it names it otherwise."""
    for token in value.lower().split():
        words = WORD.findall(token)
        named = [w for w in words if w not in BESIDE]
        if named and named[-1] in MARKS and UNLIKE.isdisjoint(words):
            return named[-1]
    return ""


def _read_attributes(tag: str, attributes: str) -> tuple[bool, str, str]:
    """Whether the element is no part of any main text; its mark, which is name, class and id if one of them has a word of ``MARKS``; its kind."""
    noise, words, kind = tag in NOISE, [], ""
    if attributes and not attributes.isspace():
        for name, value in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id"):
                words += [name, *sorted(WORD.findall(value.lower()))]
                kind = kind or kind_of(value.strip("\"'"))
            elif name == "role":
                noise |= value.strip("\"'").lower() in ROLES
            elif name == "hidden" or name == "aria-hidden" and value.strip("\"'").lower() == "true":
                noise = True
            elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                noise = True
    if tag in ("html", "body", "main") or MARKS.isdisjoint(words):
        return noise, "", ""
    return noise, " ".join([tag, *words]), kind


class Open:
    """The open elements, and where each name and the last block is among them: no look-up walks the stack."""

    def __init__(self, root: Node):
        self.stack, self.blocks, self.where = [root], [0], {}

    def push(self, node: Node) -> None:
        self.where.setdefault(node.tag, []).append(len(self.stack))
        if node.tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def last(self, tags: tuple[str, ...]) -> int:
        """Place of the innermost of the names, 0 if none is open."""
        return max((at[-1] for t in tags if (at := self.where.get(t))), default=0)

    def cut(self, k: int) -> None:
        """Close the element at place ``k`` and all within it."""
        while len(self.stack) > k:
            node = self.stack.pop()
            self.where[node.tag].pop()
            if self.blocks[-1] == len(self.stack):
                self.blocks.pop()


class Scanner:
    """Finds the markup of a page in one pass: what was once not found further on is not looked for again."""

    def __init__(self, page: str):
        self.page, self.missing = page, set()

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``at``; -1 if the page ends before.

        A quote counts after ``=`` only; one that is never closed is not one.
        """
        page, n, end = self.page, len(self.page), -1
        while True:
            if end < at:
                end = self.find(">", at)
            if end < 0:
                return -1
            equals = page.find("=", at, end)
            if equals < 0:
                return end
            at = equals + 1
            while at < n and page[at].isspace():
                at += 1
            if at < n and page[at] in "\"'":
                closing = self.find(page[at], at + 1)
                at = closing + 1 if closing >= 0 else at + 1


def parse(page: str) -> Node:
    """A forgiving tree of the page, of any depth; anything that is open at its end is closed."""
    root, scan = Node("#root"), Scanner(page)
    stack, n = Open(root), len(page)
    at = start = 0  # where the search goes on, and where the text begins that is not in the tree yet

    def text(part: str) -> None:
        if part:
            stack.stack[-1].parts.append(part)

    while at < n:
        begin = scan.find("<", at)
        if begin < 0:
            break
        after = page[begin + 1 : begin + 2]
        if after in ("!", "?") and after:
            text(page[start:begin])
            cdata = page.startswith("<![CDATA[", begin)
            opening, closing = ("<!--", "-->") if page.startswith("<!--", begin) else ("<![CDATA[", "]]>") if cdata else ("<", ">")
            end = scan.find(closing, begin + len(opening))
            if cdata and end >= 0:
                text(page[begin + len(opening) : end])
            at = start = n if end < 0 else end + len(closing)
            continue
        closes = after == "/"
        name = NAME.match(page, begin + 1 + closes)
        if not name:
            at = begin + 1  # no markup
            continue
        text(page[start:begin])
        tag = name[0].lower()
        plain = PLAIN_TAG.match(page, begin)
        end = plain.end() - 1 if plain else scan.tag_end(name.end())
        at = start = end + 1 if end >= 0 else n  # a page may end within a tag
        if end < 0:
            break
        if closes:
            _close(stack, tag)
            continue
        if tag in CLOSES_P and stack.stack[stack.blocks[-1]].tag == "p":
            stack.cut(stack.blocks[-1])
        if tag in SELF_NESTED:
            _close_sibling(stack, tag)
        node = Node(tag, *_read_attributes(tag, page[name.end() : end]))
        stack.stack[-1].parts.append(node)
        if tag in RAW:
            closing = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            node.parts.append(page[at : closing.start() if closing else n])
            end = scan.find(">", closing.end()) if closing else -1
            at = start = end + 1 if end >= 0 else n
        elif tag not in VOID:
            stack.push(node)
    text(page[start:])
    return root


def _close(stack: Open, tag: str) -> None:
    k = stack.last((tag,))
    if tag in FORMATTING and stack.blocks[-1] > k:
        return  # an inline end tag closes nothing beyond its block
    if tag == "p" and stack.last(("article", "main", "body", "td", "th", "div", "section")) > k:
        return
    if k:
        stack.cut(k)


def _close_sibling(stack: Open, tag: str) -> None:
    k = stack.last(SIBLINGS.get(tag, (tag,)))
    if k and k > stack.last(SELF_NESTED[tag]):
        stack.cut(k)


def _walk(root: Node) -> Iterator[Node]:
    """Subtrees that are not noise, in page order."""
    todo = [root]
    while todo:
        x = todo.pop()
        yield x
        todo.extend(p for p in reversed(x.parts) if isinstance(p, Node) and not p.noise)


def main_elements(root: Node) -> list[Node]:
    """The outermost article and main elements, in page order."""
    found, inside = [], set()
    for x in _walk(root):
        if x.tag in ("article", "main") and id(x) not in inside:
            found.append(x)
        if id(x) in inside or x.tag in ("article", "main"):
            inside.update(id(p) for p in x.parts if isinstance(p, Node))
    return found


def keyed(root: Node) -> list[Node]:
    """The subtrees, parents first, each with its hash: its name, and its text and children in order."""
    order = [root]
    for x in order:
        order.extend(p for p in x.parts if isinstance(p, Node))
    for x in reversed(order):
        h = hashlib.blake2b(x.tag.encode("utf-8", "surrogatepass"), digest_size=8)
        for p in x.parts:
            if isinstance(p, str):
                text = BLANK.sub(" ", p).strip()
                if text:
                    h.update(b"\0" + text.encode("utf-8", "surrogatepass"))
            else:
                h.update(b"\1" + p.key)
        x.key = h.digest()
    return order


#: the two low bits of a number: contents, marks, contents within main elements, kinds
CONTENT, MARK, WITHIN, KIND = range(4)


def content_number(key: bytes, what: int = CONTENT) -> int:
    """A hash as a signed number that says what it is of; contents are even, marks and kinds odd."""
    return int.from_bytes(key, "little", signed=True) & ~3 | what


def mark_number(mark: str, what: int = MARK) -> int:
    return content_number(hashlib.blake2b(mark.encode("utf-8", "surrogatepass"), digest_size=8).digest(), what)


@dataclass
class Page:
    """A page's content, the numbers of its subtrees and marks, and its text."""

    content: int
    keys: list[int]
    marked: bool  # the page has an article or main element
    runs: list[str] = field(default_factory=list)  # in page order; a line feed parts blocks
    spans: list[tuple[int, int, int, bool]] = field(default_factory=list)  # number of a subtree with text, its first run and the run after its last, and whether it is a kind

    def text(self, deleted: frozenset[int] = frozenset()) -> str:
        """Text without the deleted subtrees.

        Kinds go whatever their size; the others stay if without them nothing
        else were left, or less than half of an article.
        """
        kinds = [s for s in self.spans if s[3] and s[0] in deleted]
        whole = self._without(kinds)
        others = [s for s in self.spans if not s[3] and s[0] in deleted]
        if not others:
            return whole
        cleaned = self._without(kinds + others)
        return cleaned if 2 * len(cleaned) >= len(whole) or cleaned and not self.marked else whole

    def _without(self, dead: list[tuple[int, int, int, bool]]) -> str:
        if not dead:
            return joined(self.runs)
        depth = [0] * (len(self.runs) + 1)
        for _, begin, end, _ in dead:
            depth[begin] += 1
            depth[end] -= 1
        return joined(t for t, d in zip(self.runs, accumulate(depth), strict=False) if not d or t == "\n")


def joined(runs: Iterable[str]) -> str:
    """Blocks without blanks around them; the runs' white space is already single spaces."""
    lines = (SPACES.sub(" ", line).strip(" ") for line in "".join(runs).split("\n"))
    return "\n".join(line for line in lines if line)


def candidates(root: Node, mains: list[Node]) -> dict[int, list[int]]:
    """Numbers of each subtree that may be a template, by its id().

    A whole document, article or main is none, nor is what holds one, or an
    inline element (but for its mark). Within the main elements titles, cells
    and items are none, as they recur for other reasons. The mark of an element
    that holds more than half of the text is none, and the kind of one that
    holds a main element, the page's first title or, on a page without main
    elements, more than half of the text.
    """
    order = keyed(root)
    size: dict[int, int] = {}
    for x in reversed(order):
        size[id(x)] = sum(len(p) if isinstance(p, str) else size[id(p)] for p in x.parts) if not x.noise else 0
    most = sum(size[id(x)] for x in mains or [root]) / 2
    holders = {id(x) for x in mains}
    for x in reversed(order):
        if any(isinstance(p, Node) and id(p) in holders for p in x.parts):
            holders.add(id(x))
    inside = {id(x) for x in mains}
    titled = {id(next((x for x in order if x.tag == "h1"), None))}
    for x in reversed(order):
        if any(isinstance(p, Node) and id(p) in titled for p in x.parts):
            titled.add(id(x))
    out: dict[int, list[int]] = {}
    for x in order:
        within = id(x) in inside
        if within:
            inside.update(id(p) for p in x.parts if isinstance(p, Node))
        whole = id(x) in holders or x.tag in ("#root", "html", "body") or x.tag in VOID or x.tag in INLINE or within and x.tag in PIECES
        numbers = [] if whole else [content_number(x.key, WITHIN if within else CONTENT)]
        if x.mark and size[id(x)] <= most:
            numbers.append(mark_number(x.mark))
        if x.kind and id(x) not in holders and id(x) not in titled and (mains or size[id(x)] <= most):
            numbers.append(mark_number(x.kind, KIND))
        if numbers:
            out[id(x)] = numbers
    return out


def analysed(page: str | None) -> Page:
    root = parse(page or "")
    mains = main_elements(root)
    numbers = candidates(root, mains)
    content = b"".join(x.key for x in mains) or root.key
    out = Page(content_number(hashlib.blake2b(content, digest_size=8).digest()), sorted({n for found in numbers.values() for n in found}), bool(mains))
    for x in mains or [root]:
        _runs(x, numbers, out)
    return out


def _runs(node: Node, numbers: dict[int, list[int]], page: Page) -> None:
    """Adds the text runs, in page order; references are decoded and white space is one space."""
    out, held = page.runs, []

    def flush() -> None:
        if held:
            text = "".join(held)
            held.clear()
            out.append(BLANK.sub(" ", entities.unescape(text) if "&" in text else text))

    def block() -> None:
        flush()
        if out and out[-1] != "\n":
            out.append("\n")

    block()
    todo = [(node, iter(node.parts), len(out), page.marked, True)]
    while todo:
        x, parts, begin, inside, is_block = todo[-1]
        for p in parts:
            if isinstance(p, str):
                held.append(p)
            elif p.tag == "br":
                held.append(" ")
            elif p.noise or p.tag == "header" and not inside:
                if p.tag not in INLINE:
                    block()
            else:
                inline = p.tag in INLINE
                if not inline:
                    block()
                elif id(p) in numbers:
                    flush()
                todo.append((p, iter(p.parts), len(out), inside or p.tag in ("article", "main"), not inline))
                break
        else:
            todo.pop()
            if is_block:
                block()
            elif id(x) in numbers:
                flush()
            if len(out) > begin:
                page.spans += [(number, begin, len(out), number & 3 == KIND) for number in numbers.get(id(x), ())]


def extract(page: str | None, deleted: frozenset[int] = frozenset()) -> str:
    """Main text of one page; ``deleted`` are numbers of its site's templates."""
    return analysed(page).text(deleted)


def host_of(url: F.Column) -> F.Column:
    """Lower-case host without user and port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def sites_of(url: F.Column) -> F.Column:
    """Hashes of the host, and of the host with the first folder of the path if there is one."""
    folder = F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+/)", 1), F.lit(""))
    return F.array_distinct(F.array(F.xxhash64(host_of(url)), F.xxhash64(F.concat(host_of(url), folder))))


PAGE = "row_key long, file string, row int, sites array<long>, content long, keys array<long>"
BODY = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("body", pa.large_string())])
RESULT = "page_id long, url string, text string, n_chars long, n_templates int"
#: pages that are written, compressed and read together
TOGETHER = 64


def to_body(page: Page) -> str:
    """What the text is made of; a span names its subtree by its place in ``keys``."""
    places = {key: k for k, key in enumerate(page.keys)}
    return json.dumps([page.marked, page.runs, [(places[number], begin, end, kind) for number, begin, end, kind in page.spans]], ensure_ascii=False)


def from_body(body: str) -> Page:
    """The page of ``to_body``, its subtrees numbered by their places."""
    marked, runs, spans = json.loads(body)
    return Page(0, [], marked, runs, spans)


def _analyse(where: str):
    """Writes the texts of a task to one file of a name of its own, and gives the subtrees of each page with its place there.

    A task that runs twice writes two files; the rows that Spark keeps name the
    file of the attempt that gave them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = filesystem(where)
        name, out, row = f"{uuid.uuid4().hex}.arrow", None, 0
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, TOGETHER):
                    part = batch.slice(at, TOGETHER)
                    if out is None:
                        system.create_dir(top, recursive=True)
                        sink = system.open_output_stream(f"{top}/{name}")
                        out = pa.ipc.new_stream(sink, BODY, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 5)))
                    found = [analysed(page.as_py()) for page in part["html"]]
                    bodies = pa.array([to_body(f) for f in found], pa.large_string())
                    out.write_batch(pa.RecordBatch.from_arrays([part["page_id"], part["url"], bodies], schema=BODY))
                    columns = [part["row_key"], pa.array([name] * len(found)), pa.array(range(row, row + len(found)), pa.int32()), part["sites"]]
                    columns += [pa.array([f.content for f in found], pa.int64()), pa.array([f.keys for f in found], pa.list_(pa.int64()))]
                    row += len(found)
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in PAGE.split(", ")])
        finally:
            if out is not None:
                out.close()
                sink.close()

    return lean(run)


def _texts(where: str, name: str, deleted: dict[int, set[int]]) -> Iterator[pa.RecordBatch]:
    """The pages of a file without what is deleted from them."""
    system, top = filesystem(where)
    with system.open_input_stream(f"{top}/{name}") as source, pa.ipc.open_stream(source) as stream:
        row = 0
        for batch in stream:
            gone = [frozenset(deleted.get(row + k, ())) for k in range(batch.num_rows)]
            texts = [from_body(body).text(g) for body, g in zip(batch["body"].to_pylist(), gone, strict=True)]
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(map(len, gone), pa.int32())], names=["page_id", "url", "text", "n_chars", "n_templates"])


def _delete(where: str):
    """Of rows (file, row, place) in the order of files: the texts of each file; what is held is the rows of one file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, deleted = None, {}
        for batch in batches:
            for file, row, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    if name is not None:
                        yield from _texts(where, name, deleted)
                    name, deleted = file, {}
                if place >= 0:
                    deleted.setdefault(row, set()).add(place)
        if name is not None:
            yield from _texts(where, name, deleted)

    return lean(run)


def templates(keys: DataFrame, *, min_pages: int = 5, min_share: float = 0.2, min_share_within: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(site, key) of what is on at least ``min_pages`` contents and ``min_share`` of the site's, and (site, contents) of all sites."""
    contents = keys.select(F.explode("sites").alias("site"), "content", "row_key", "keys").groupBy("site", "content").agg(F.min_by("keys", "row_key").alias("keys"))
    # the null key counts contents
    counted = contents.select("site", F.explode(F.array_append("keys", F.lit(None).cast("long"))).alias("key")).groupBy("site", "key").agg(F.count("*").alias("pages"))
    total = stored(counted.where((F.col("pages") >= min_pages) | F.col("key").isNull()), "html-counts")
    sites = total.where("key is null").select("site", F.col("pages").alias("contents"))
    share = F.when(F.col("key").bitwiseAND(3) == WITHIN, min_share_within).otherwise(min_share)
    found = total.where("key is not null").join(sites, "site").where(F.col("pages") >= share * F.col("contents"))
    return stored(found.select("site", "key"), "html-templates"), sites


def recurring_kinds(keys: DataFrame, *, min_pages: int = 5) -> list[int]:
    """Kinds on at least ``min_pages`` different contents of the corpus; no more than there are words in ``MARKS``."""
    kinds = keys.select("content", F.explode(F.filter("keys", lambda k: k.bitwiseAND(F.lit(3)) == KIND)).alias("key"))
    counted = kinds.groupBy("key").agg(F.count_distinct("content").alias("n")).where(F.col("n") >= min_pages)
    return [r["key"] for r in counted.collect()]


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 5, min_share: float = 0.2, min_share_within: float = 0.5, min_hosts: int = 3) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points), n_templates.

    Null html gives empty text; a null url is a host of its own. With article
    or main elements the text of all of them is returned, without one the
    page's, less the template subtrees of its host and section (or with them,
    if nothing else were left, or less than half of an article). Unmarked
    subtrees within article or main elements are templates from
    ``min_share_within`` of the site's contents on. On a host of fewer than
    ``min_pages`` contents marks that are templates of ``min_hosts`` other sites
    are deleted. Kinds on ``min_pages`` contents of the corpus are deleted
    everywhere, whatever their size. ``n_templates`` counts the page's subtrees
    that are templates, within its main elements or not. Repeated rows and ids
    give a row each. Other columns are not read.
    An empty table gives no rows.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    where = fresh_dir(spark, "html-texts")
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    made = source.select(F.xxhash64("page_id", "url", "html").alias("row_key"), "page_id", "url", sites_of(F.col("url")).alias("sites"), "html")
    keys = stored(made.mapInArrow(_analyse(where), PAGE), "html-keys")
    deleted, sites = templates(keys, min_pages=min_pages, min_share=min_share, min_share_within=min_share_within)
    place = ["file", "row"]
    exploded = keys.select(*place, F.explode("sites").alias("site"), "keys").select(*place, "site", F.posexplode("keys").alias("place", "key"))
    hits = exploded.join(deleted, ["site", "key"], "left_semi").select(*place, "place")
    wide = stored(deleted.where("key % 2 <> 0").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_hosts).select("key"), "html-wide")
    few = sites.where(F.col("contents") < min_pages).select("site")
    small = keys.select(*place, F.col("sites")[0].alias("site"), "keys").join(few, "site", "left_semi").select(*place, F.posexplode("keys").alias("place", "key")).where("key % 2 <> 0")
    hits = hits.unionByName(small.join(wide, "key", "left_semi").select(*place, "place"))
    kinds = recurring_kinds(keys, min_pages=min_pages)
    everywhere = keys.select(*place, F.posexplode("keys").alias("place", "key")).where(F.col("key").isin(kinds)).select(*place, "place")
    every_file = keys.where("row = 0").select(*place, F.lit(-1).alias("place"))
    # by number: these rows are small, so Spark would join them all into one task, but their texts are not
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = hits.unionByName(everywhere).unionByName(every_file).repartition(tasks, "file").sortWithinPartitions("file")
    return dealt.mapInArrow(_delete(where), RESULT)
