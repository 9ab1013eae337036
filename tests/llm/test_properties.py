import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import exact_dedup, html, packing, texthash
from tallyforge.llm.texthash import shingles

PARTS = st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "<b>", "</b>", "<br>", "<script>", "</script>", "<!--", "-->", "&amp;", "&#x41;", "<", ">", "'", '"', " ", "\n", "word", "é", "<a href=\"x>y\">", "<table><tr><td>", "</table>", "<li>", "<![CDATA[", "]]>", "<p", "</"]), max_size=60)


@settings(max_examples=300, deadline=None)
@given(PARTS)
def test_any_markup_gives_clean_blocks(parts):
    page = "".join(parts)
    text = html.extract(page)
    assert all(line and line == " ".join(line.split()) for line in text.split("\n")) or text == ""
    assert html.analysed(page).text() == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=40), st.integers(1, 6), st.integers(8, 256))
def test_every_token_lies_in_one_piece(sizes, segments, tokens):
    packer = packing.Packer(packing.Limits(tokens, segments, tokens))
    pool = [packing.Piece(i, 0, np.arange(n, dtype="<u4"), None, n) for i, n in enumerate(sizes)]
    closed = [*packer.pack(pool), *packer.rest()]
    parts = [part for c in closed for part in packing.without_padding(c, tokens)]
    seen = {i: [] for i in range(len(sizes))}
    for part in parts:
        total = sum(len(p.ids) for p in part)
        assert total == tokens or total & (total - 1) == 0
        assert len(part) <= segments
        for p in part:
            seen[p.doc_id].append((p.start, p.ids.tolist()))
    for i, n in enumerate(sizes):
        assert [t for _, ids in sorted(seen[i]) for t in ids] == list(range(n))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abAB éß\t\n\x0b ", max_size=25), max_size=12))
def test_shingle_counts(texts):
    _, counts = shingles([t.encode() for t in texts], 3)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert counts.tolist() == [0 if not w else max(1, len(w) - 2) for w in words]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_normalised_text(text):
    assert exact_dedup.normalised(text).decode("utf-8", "surrogatepass") == re.sub(r"[\x20\x09-\x0D]", "", text)


def test_chunks_do_not_change_hashes(monkeypatch):
    texts = [b"one two three " * 50, b"", b"x" * 300 + b" one two", b"\n", b"one"]
    want, counts = texthash.words(texts)
    for chunk in (1, 7, 100):
        monkeypatch.setattr(texthash, "CHUNK", chunk)
        got, n = texthash.words(texts)
        assert got.tolist() == want.tolist() and n.tolist() == counts.tolist()
    assert want[0].tolist() == want[3].tolist() == want[-1].tolist()


def test_a_word_longer_than_a_chunk_stays_whole(monkeypatch):
    monkeypatch.setattr(texthash, "CHUNK", 64)
    for text in (b"a " + b"x" * 64 + b"y b c", b" " * 200, b" " + b"x" * 200, b"x" * 200 + b" ", b"a " + b"x" * 200):
        parts = list(texthash._chunks(text))
        assert b"".join(parts) == text and all(parts[:-1])
        assert sum(len(p.split()) for p in parts) == len(text.split())
