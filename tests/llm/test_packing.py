import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyforge.llm import packing
from tallyforge.llm.tokens import Encoder, tokenizer_path


def check(rows, docs):
    whole = Tokenizer.from_file(tokenizer_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    texts = defaultdict(list)
    for doc_id, text in docs:
        texts[doc_id].append(text)
    assert set(by_doc) == set(texts)
    for doc_id, found in texts.items():
        if len(found) > 1:
            continue
        ids = np.array([*whole.encode(found[0] or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r.start)
        at = 0
        for p in pieces:
            assert p.start == at and p.doc_tokens == len(ids)
            assert bytes(p.ids) == ids[at : at + p.length].tobytes()
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= 1024
        assert at & (at - 1) == 0, "a sequence that is not full has a power of two"


def test_pieces_make_up_documents(spark, hard):
    check(packing.pack(hard).collect(), [tuple(r) for r in hard.select("doc_id", "text").collect()])


def test_provided_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs).collect()
    check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sum(r.length for r in rows if r.length) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_crc_column(spark, hard):
    r = packing.pack(hard.where("doc_id = 4")).selectExpr("crc32(ids) AS c", "ids").first()
    assert r.c == zlib.crc32(bytes(r.ids))


def test_empty_table(spark, empty):
    assert packing.pack(empty).count() == 0


def pieces(sizes, loss=None):
    return [packing.Piece(i, 0, np.zeros(n, "<u4"), None if loss is None else np.arange(n) >= loss, n) for i, n in enumerate(sizes)]


def test_three_limits_hold_for_whole_examples():
    limits = packing.Limits(tokens=100, segments=3, loss_tokens=50)
    p = packing.Packer(limits, cuttable=False)
    closed = [*p.pack(pieces([40, 60, 10, 10, 10, 10, 75, 5, 5], loss=30)), *p.rest()]
    assert sum(map(len, closed)) == 9
    for s in closed:
        assert sum(len(x.ids) for x in s) <= 100 and len(s) <= 3 and sum(x.loss_tokens for x in s) <= 50


def test_dot_product_takes_the_piece_that_fits_what_is_left():
    p = packing.Packer(packing.Limits(100, 10, 100), cuttable=False)
    first = next(iter([*p.pack(pieces([30, 70, 50])), *p.rest()]))
    assert [x.doc_id for x in first] == [1, 0]


def test_an_example_beyond_a_limit_raises():
    p = packing.Packer(packing.Limits(10, 2, 10), cuttable=False)
    with pytest.raises(ValueError, match="does not fit"):
        list(p.pack(pieces([11])))


def test_loss_start(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h", 3), (2, None, None)], "doc_id long, text string, s int")
    rows = {r.doc_id: r for r in packing.pack(docs, loss_start_col="s", cuttable=False).collect()}
    assert rows[1].loss_tokens == rows[1].length - 3 and rows[2].loss_tokens == rows[2].length == 1


def test_quick_ids_equal_the_library():
    e = Encoder(tokenizer_path())
    texts = ["", "don't they're  \n\n x ½ é b", "<|endoftext|> x", "日本語 🙂", "\x00\x1f\x85 ¬­", "a" * 5000, "  \t lead", "1234567 ١٢٣"]
    assert e.quick is not None
    for t in texts:
        assert e.encode(t).tolist() == e.whole.encode(t, add_special_tokens=False).ids
