import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import warc
from tallyforge.llm.storage import filesystem


@pytest.fixture(scope="module")
def pages(spark):
    body = "<p>" + "ä" * 60 + "</p>"
    rows = [(1, "http://a.example/x y", body), (2, "http://b.example", body), (3, None, None), (4, "u\r\nEvil: 1", ""), (5, "u", "short"), (6, "u", "short"), (None, "n", body), (2, "again", body), (7, "long", "x" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'c' AS payload", "'c' AS digest", "'c' AS first")


def brute(rows):
    first = {}
    for page_id, _, html in rows:
        b = (html or "").encode()
        if len(b) >= 100 and page_id is not None:
            first[b] = min(first.get(b, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        b = (html or "").encode()
        f = first.get(b)
        revisit = page_id is not None and f is not None and f != page_id
        out.append((page_id, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    got = warc.archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_payloads_come_back(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path))
    got = warc.read(spark, str(tmp_path)).where("record_type = 'response'").select("page_id", "payload").collect()
    want = {(r.page_id, (r.html or "").encode()) for r in pages.collect()}
    assert {(r.page_id, bytes(r.payload)) for r in got} <= want and len(got) == 7
    injected = warc.read(spark, str(tmp_path)).where("page_id = 4").first()
    assert injected.target_uri == "u%0D%0AEvil:%201"


def test_filters_are_pushed(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path))
    df = warc.read(spark, str(tmp_path)).where(F.col("record_type").isin("revisit") & (F.col("page_id") == 2)).select("page_id", "payload_bytes")
    assert [tuple(r) for r in df.collect()] == [(2, 127), (2, 127)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0] or "record_type" not in plan.split("BatchScan")[0]


def test_unwanted_payloads_are_stepped_over():
    records = b"".join(warc.record(i, "u", bytes([65 + i]) * 5000, "d", None) for i in range(20))
    taken = []

    class Spy(io.BytesIO):
        pass

    original = warc._Stream.take
    try:
        warc._Stream.take = lambda self, n: taken.append(n) or original(self, n)
        got = list(warc.read_records(Spy(records), lambda v: v["page_id"] == 7, True))
    finally:
        warc._Stream.take = original
    assert len(got) == 1 and got[0][-1] == b"H" * 5000 and taken == [5000]


@pytest.mark.parametrize("pack", [lambda r: b"".join(r), lambda r: b"".join(map(gzip.compress, r)), lambda r: gzip.compress(b"".join(r))])
def test_plain_members_and_one_stream(pack):
    records = [warc.record(i, None, b"p" * i, "d", None) for i in range(5)]
    got = list(warc.read_records(io.BytesIO(pack(records)), lambda v: True, True))
    assert [(g[5], g[-1]) for g in got] == [(i, b"p" * i) for i in range(5)]


def test_truncated_and_foreign_files_raise():
    r = warc.record(1, None, b"payload" * 50, "d", None)
    with pytest.raises(ValueError, match="ends before"):
        list(warc.read_records(io.BytesIO(r[:-40]), lambda v: True, True))
    with pytest.raises(ValueError, match="not a WARC"):
        list(warc.read_records(io.BytesIO(b"hello\r\n"), lambda v: True, True))


def test_empty_table_and_folder(spark, pages, tmp_path):
    assert warc.archived(pages.where("false")).count() == 0
    assert warc.read(spark, str(tmp_path)).count() == 0


def test_local_uris():
    assert filesystem("file:///a/b")[1] == filesystem("file:/a/b")[1] == filesystem("/a/b")[1] == "/a/b"


def test_ranges_of_a_file_hold_every_record_once(spark, tmp_path):
    rows = [(k, f"http://a.example/{k}", f"<p>{k}</p>" * (k % 40 + 1)) for k in range(300)]
    rows.append((300, "http://a.example/inner", "WARC/1.1 is no record here"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    where = f"file:{tmp_path}/w"
    (one,) = warc.write(df, where).where("records > 0").collect()
    size = (tmp_path / "w" / one.file.rsplit("/", 1)[1]).stat().st_size
    want = sorted((k, html.encode()) for k, _, html in rows)
    for split in (333, 4096, size - 1, size, size + 1):
        got = warc.read(spark, where, split_bytes=split)
        assert sorted((r.page_id, bytes(r.payload)) for r in got.collect()) == want, split
    assert warc.read(spark, where, split_bytes=4096).rdd.getNumPartitions() == -(-size // 4096)


def test_first_member_is_found_across_blocks():
    members = [warc._member(warc.record(k, "u", b"x" * (k * 37 % 200), "d", None), 1) for k in range(40)]
    data = b"".join(members)
    starts = [sum(map(len, members[:k])) for k in range(40)]
    for start in range(1, len(data), 61):
        want = next((s for s in starts if s >= start), None)
        for stop in (len(data), start + 200):
            found = warc.first_member(io.BytesIO(data), start, stop, block=97)
            assert found == (want if want is not None and want < stop else None), (start, stop)


def test_columns_decide_what_is_decoded(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "<p>a</p>"), (2, "v", "<p>b</p>")], "page_id long, url string, html string")
    where = f"file:{tmp_path}/w"
    warc.write(df, where)
    got = warc.read(spark, where, columns=("target_uri", "page_id"))
    assert got.columns == ["target_uri", "page_id"] and sorted(map(tuple, got.collect())) == [("u", 1), ("v", 2)]
