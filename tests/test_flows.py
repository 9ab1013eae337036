"""Stages with failures, name index, byte ranges, archive members, page tables, versions of several tables, keyed discovery."""

import bz2
import difflib
import io
import json
import random
import struct
import zipfile
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.operators import page_tables, snapshots, stages
from tallyforge.plans import flows, registry
from tallyforge.plans.domain import table
from tallyforge.sources import listings, logs, members, ranges
from tallyforge.streaming import incremental

SF = "/root/testdata/sf0.001"


# Stages ----------------------------------------------------------------------


def _halved(n):
    if n is None:
        raise ValueError("no number")
    if n % 5 == 0:
        raise KeyError(n)
    return {"half": n // 2, "n": -n}


HALF = stages.Stage("half", ("n",), "half long, n long", _halved)


def test_a_stage_gives_both_outputs_and_counts(spark, tmp_path):
    rows = spark.range(20).select(F.col("id").alias("n"), F.lit("x").alias("ok"), F.lit("y").alias("kind"), F.lit(1).alias("keep")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS n, 'x' AS ok, 'y' AS kind, 2 AS keep"))
    done = stages.run_stage(rows, HALF, str(tmp_path / "out"))
    assert done.counts == {"rows": 21, "good": 16, "failed": 5}
    assert sorted((r.n, r.half, r.keep) for r in done.good.collect()) == sorted((-n, n // 2, 1) for n in range(20) if n % 5)
    assert sorted((r.stage, r.kind, r.message, r.keep) for r in done.failed.collect()) == sorted([("half", "KeyError", str(n), 1) for n in (0, 5, 10, 15)] + [("half", "ValueError", "no number", 2)])
    again = stages.run_stage(rows, HALF, str(tmp_path / "out"))
    assert again.good.count() == 16


def test_both_outputs_come_from_one_scan(spark):
    plan = registry.queries()["w8_stage_outcomes"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("ArrowEvalPython") == 1


def test_a_fault_of_the_task_is_no_failure_of_a_row(spark):
    def out_of_memory(n):
        raise MemoryError

    with pytest.raises(Exception, match="MemoryError"):
        stages.attempted(spark.range(1).toDF("n"), stages.Stage("s", ("n",), "x int", out_of_memory)).collect()


def test_empty_table_and_long_message(spark, tmp_path):
    def loud(n):
        raise ValueError("x" * 10_000)

    stage = stages.Stage("s", ("n",), "x int", loud)
    done = stages.run_stage(spark.range(0).toDF("n"), stage, str(tmp_path / "none"))
    assert done.counts == {"rows": 0, "good": 0, "failed": 0} and done.good.count() == 0
    (row,) = stages.run_stage(spark.range(1).toDF("n"), stage, str(tmp_path / "one")).failed.collect()
    assert len(row.message) == stages.MESSAGE_CHARS


# Names -----------------------------------------------------------------------


def _brute(target, names, n):
    low = (target or "").lower().strip()
    scored = sorted((-difflib.SequenceMatcher(None, low, (name or "").lower().strip()).ratio(), position, name) for position, name in names)
    return [(-m, p, name) for m, p, name in scored[:n]]


NAMES = st.text(alphabet="aAbc d1", max_size=12) | st.text(alphabet="ab", min_size=60, max_size=70)


@settings(max_examples=300, deadline=None)
@given(st.lists(NAMES, min_size=1, max_size=30), NAMES, st.integers(1, 4))
def test_bounds_never_lose_a_name(names, target, n):
    rows = list(enumerate(names))
    index = listings.NameIndex(rows, n)
    assert [(-m, p, name) for m, p, name in index.best(target)] == _brute(target, rows, n)


def test_long_names_with_popular_characters():
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice("ab ") for _ in range(rng.choice([10, 64, 65, 250])))) for k in range(40)]
    for _, target in rows[:10]:
        assert [(-m, p, name) for m, p, name in listings.NameIndex(rows, 3).best(target)] == _brute(target, rows, 3)


def test_few_pairs_are_scored(spark):
    sf = "/root/testdata/sf0.1"
    names = [(r.s_suppkey, r.s_name) for r in table(spark, sf, "supplier").collect()]
    targets = [r.c_name for r in table(spark, sf, "customer").orderBy("c_custkey").limit(400).collect()]
    index = listings.NameIndex(names, 3)
    for t in targets:
        index.best(t)
    assert index.scored < 0.05 * len(targets) * len(names)


def test_names_and_targets_in_blocks(spark):
    names = [(k, f"company {k % 7} of {k // 3}") for k in range(60)] + [(60, None), (61, "")]
    targets = ["Company 3", "of 12", None, "", "Company 3"]
    got = listings.best_of_all(spark.createDataFrame([(t,) for t in targets], "target string"), spark.createDataFrame(names, "position long, name string"), block_rows=9, group_rows=2).collect()
    want = {t: [(p, name) for _, p, name in _brute(t, names, 3)] for t in set(targets)}
    assert {t: [(r.position, r.name) for r in sorted(got, key=lambda r: r.place) if r.target == t] for t in want} == want
    none = spark.createDataFrame([], "position long, name string")
    assert listings.best_of_all(spark.createDataFrame([("a",)], "target string"), none).count() == 0


# Byte ranges -----------------------------------------------------------------


def test_lines_are_whole_whatever_the_ranges(spark, tmp_path):
    body = b'one\n\ntwo\r\n' + b"x" * 300 + "\näöü\n{\"a\": 1}\n".encode() + b"\xff\n" + b"no end"
    (tmp_path / "a.log").write_bytes(body)
    (tmp_path / "b.log").write_bytes(b"")
    (tmp_path / "_hidden").write_bytes(b"no\n")
    (tmp_path / "c.log").write_bytes(b"\n\n")
    want = sorted([line.removesuffix(b"\r").decode("utf-8", "replace") for line in body.split(b"\n")] + ["", ""])
    for step in (1, 2, 7, 1000, 1 << 20):
        got = ranges.lines(spark, str(tmp_path), range_bytes=step).collect()
        assert sorted(r.value for r in got) == want, step
        for r in got:
            if r.file.endswith("a.log"):
                assert body[r.start :].split(b"\n")[0].removesuffix(b"\r").decode("utf-8", "replace") == r.value


def test_lines_longer_than_a_block(tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 5)
    body = b"a" * 23 + b"\n" + b"b" * 4 + b"\n\n" + b"c" * 11
    path = tmp_path / "a"
    path.write_bytes(body)
    system, where = ranges.filesystem(str(path))
    for step in range(1, 45):
        found = [line for part in ranges.cut(where, 0, len(body), step) for _, line in ranges.lines_of(part, system)]
        assert found == body.split(b"\n"), step
    assert ranges._whole_lines(system, where, len(body)) == body.rfind(b"\n") + 1


def test_log_in_ranges_of_a_kilobyte(spark, tmp_path):
    value = F.expr("concat('{\"ticker\":\"EDX', user_id, '\",\"found\":', event_id, '}')")
    events = table(spark, SF, "events")
    events.select(value).repartition(3).write.text(str(tmp_path / "log"))
    found = logs.log_lines(ranges.lines(spark, str(tmp_path / "log"), range_bytes=1024))
    assert sorted((int(r.found), r.ticker) for r in found.collect()) == sorted((r.event_id, f"EDX{r.user_id}") for r in events.collect())


def test_appended_lines_are_read_once(spark, tmp_path):
    log, out, check = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "check")
    log.mkdir()

    def run():
        stream = ranges.lines(spark, str(log), range_bytes=16, stream=True)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.value for r in spark.read.parquet(out).collect())

    (log / "a").write_text("1\n2\nhal")
    assert run() == ["1", "2"]  # a line still being written waits
    with open(log / "a", "a") as f:
        f.write("f\n3\n")
    (log / "b").write_text("4\n")
    assert run() == ["1", "2", "3", "4", "half"]
    assert run() == ["1", "2", "3", "4", "half"]
    (log / "a").write_text("9\n")  # replaced by a shorter one
    assert run() == ["1", "2", "3", "4", "9", "half"]


# Archives --------------------------------------------------------------------


def _zipped(files, **options):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data, method in files:
            z.writestr(zipfile.ZipInfo(name), data, method, **options)
    return out.getvalue()


def _vint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _rar5(files):
    out = members.RAR5
    for name, data, method in files:
        body = _vint(2) + _vint(2) + _vint(len(data)) + _vint(4) + _vint(len(data)) + _vint(0) + struct.pack("<L", zlib.crc32(data)) + _vint(method << 7) + _vint(0) + _vint(len(name)) + name.encode()
        head = _vint(len(body)) + body
        out += struct.pack("<L", zlib.crc32(head)) + head + data
    end = _vint(2) + _vint(5) + _vint(0)
    return out + struct.pack("<L", zlib.crc32(end)) + end


def _rar4(files):
    out = members.RAR4 + struct.pack("<HBHHHL", 0, 0x73, 0, 13, 0, 0)
    for name, data, method in files:
        n = name.encode()
        head = struct.pack("<BHHLLBLLBBHL", 0x74, 0x8000, 32 + len(n), len(data), len(data), 0, zlib.crc32(data), 0, 20, method, len(n), 0) + n
        out += struct.pack("<H", 0) + head + data
    return out + struct.pack("<HBHH", 0, 0x7B, 0, 7)


def _found(spark, tmp_path, archives, **options):
    for name, data in archives.items():
        (tmp_path / name).write_bytes(data)
    paths = spark.createDataFrame([(f"file:{tmp_path}/{name}",) for name in archives], "path string")
    return [(r.path.rsplit("/", 1)[1], *tuple(r)[1:]) for r in members.read_members(paths, **options).collect()]


TEXT = b"some text " * 40_000


def test_members_of_all_kinds(spark, tmp_path):
    plain = [("a.txt", b"hello", zipfile.ZIP_STORED), ("d/b.txt", TEXT, zipfile.ZIP_DEFLATED), ("d/", b"", zipfile.ZIP_STORED), ("ü.txt", TEXT, zipfile.ZIP_BZIP2), ("empty", b"", zipfile.ZIP_DEFLATED)]
    files = {"z.zip": _zipped(plain), "front.zip": b"stub" * 9 + _zipped(plain[:1]), "none.zip": _zipped([]), "r5.rar": _rar5([("a.txt", b"hello", 0), ("b", TEXT, 0)]), "r4.rar": _rar4([("d\\a.txt", b"hello", 0x30)])}
    got = _found(spark, tmp_path, files, run_bytes=100)
    sizes = sorted((r[0], r[1], r[2]) for r in got)
    assert sizes == sorted([("z.zip", "a.txt", 5), ("z.zip", "d/b.txt", len(TEXT)), ("z.zip", "ü.txt", len(TEXT)), ("z.zip", "empty", 0), ("front.zip", "a.txt", 5), ("r5.rar", "a.txt", 5), ("r5.rar", "b", len(TEXT)), ("r4.rar", "d/a.txt", 5)])
    assert all(r[4] is None for r in got)
    assert len({r[3] for r in got if r[2] == len(TEXT)}) == 1


def test_contents_come_in_blocks(spark, tmp_path, monkeypatch):
    data = bz2.compress(bytes(range(256)) * 9000)
    got = _found(spark, tmp_path, {"z.zip": _zipped([("a", TEXT * 8, zipfile.ZIP_DEFLATED), ("b", data, zipfile.ZIP_STORED)])}, chunks=True)
    parts = {m: b"".join(r[3] for r in sorted(got, key=lambda r: r[2]) if r[1] == m) for m in ("a", "b")}
    assert parts == {"a": TEXT * 8, "b": data}
    assert max(len(r[3]) for r in got) <= members.BLOCK and len(got) > 3


def test_archives_that_fail(spark, tmp_path):
    good = _zipped([("a", TEXT, zipfile.ZIP_DEFLATED), ("b", b"12345", zipfile.ZIP_STORED)])
    at = good.index(b"12345")
    wrong = good[:at] + b"12x45" + good[at + 5 :]
    bomb = bytearray(_zipped([("a", b"0" * 5000, zipfile.ZIP_DEFLATED)]))
    where = bomb.index(members.CENTRAL)
    struct.pack_into("<L", bomb, where + 24, 10)  # says less than it holds
    archives = {"cut.zip": good[:-30], "half.zip": good[: len(good) // 2], "wrong.zip": wrong, "bomb.zip": bytes(bomb), "up.zip": _zipped([("ok", b"1", 0), ("../x", b"2", 0)]), "root.zip": _zipped([("/x", b"2", 0)]), "no.zip": b"", "text.zip": b"no archive", "packed.rar": _rar5([("a", b"zz", 3)]), "cut.rar": _rar5([("a", TEXT, 0)])[:60], "lzma.zip": _zipped([("a", b"1", zipfile.ZIP_LZMA)])}
    got = _found(spark, tmp_path, archives)
    assert sorted(r[0] for r in got) == sorted(archives)
    assert all(r[1] is None and r[4] for r in got)
    (row,) = _found(spark, tmp_path, {"big.zip": good}, max_bytes=1000)
    assert row[4] == "more than 1000 bytes"
    missing = spark.createDataFrame([(f"file:{tmp_path}/nowhere.zip",), (None,)], "path string")
    assert all(r.error for r in members.read_members(missing).collect())


def test_directories_with_64_bit_fields(tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z, z.open(zipfile.ZipInfo("a"), "w", force_zip64=True) as f:
        f.write(b"x" * 100)
    data = bytearray(out.getvalue())
    found = list(members.zip_members(io.BytesIO(data), len(data)))
    assert [(m[0], m[3], m[4]) for m in found] == [("a", 100, 100)]
    # the same directory behind a 64-bit end
    end = data.rindex(members.END)
    _, _, _, _, n, length, start, _ = members.END_RECORD.unpack_from(data, end)
    wide = members.END64_RECORD.pack(members.END64, 44, 45, 45, 0, 0, n, n, length, start) + struct.pack("<4sLQL", members.LOCATOR64, 0, end, 1) + members.END_RECORD.pack(members.END, 0, 0, n, n, length, 0xFFFFFFFF, 0)
    both = bytes(data[:end]) + wide
    assert list(members.zip_members(io.BytesIO(both), len(both))) == found


# Tables of a page ------------------------------------------------------------


def _tables(page):
    """Columns by the characters that are blank on every line of a table."""
    out, block = [], []
    for line in [*page.replace("\t", "  ").replace("\r", "").split("\n"), ""]:
        stripped = line.strip()
        if "  " in stripped:
            block.append(line)
            continue
        if len(block) >= 2:
            wide = max(map(len, block))
            full = [any(k < len(b) and not b[k].isspace() for b in block) for k in range(wide)]
            # a single blank within the text of a line is part of its cell
            for b in block:
                for k in range(1, min(len(b), wide) - 1):
                    if b[k] == " " and b[k - 1] != " " and b[k + 1] != " ":
                        full[k] = True
            columns, k = [], 0
            while k < wide:
                if full[k]:
                    e = k
                    while e < wide and (full[e] or (e + 1 < wide and full[e + 1])):
                        e += 1
                    columns.append((k, e))
                    k = e
                k += 1
            if len(columns) >= 2:
                out.append([[" ".join(b[s:e].split()) or None for s, e in columns] for b in block])
        block = []
    return out


CELL = st.sampled_from(["", "a", "12 345", "net income", "-7", "x y z"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.lists(CELL, min_size=2, max_size=4), min_size=1, max_size=5), min_size=1, max_size=12))
def test_planted_tables_come_back(spark, tables):
    pages = []
    for t in tables:
        lines = ["A title"]
        for row in t:
            lines.append("".join(c.ljust(13) for c in row).rstrip())
        pages.append("\n".join(lines))
    df = spark.createDataFrame(list(enumerate(pages)), "doc_id long, page string").withColumn("page_number", F.lit(1)).coalesce(1)
    got = {}
    for r in page_tables.page_tables(df).collect():
        got.setdefault((r.doc_id, r.table_no), {})[r.row_no] = list(r.cells)
    want = {(k, n): dict(enumerate(t, 1)) for k, page in enumerate(pages) for n, t in enumerate(_tables(page), 1)}
    assert got == want


def test_pages_of_two_tables_and_none(spark):
    page = "Assets       2023   2022\ncash           10     20\nother debts            5\n\ntext\n  a  b\n  c  d\nlast\nalone  here"
    df = spark.createDataFrame([(1, 1, page), (1, 2, None), (2, 1, ""), (None, 1, "x  y\nz  w\r\n")], "doc_id long, page_number int, page string").withColumn("cells", F.lit("clash"))
    got = [(r.doc_id, r.page_number, r.table_no, r.row_no, r.cells) for r in page_tables.page_tables(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 1, 1, ["Assets", "2023", "2022"]), (1, 1, 1, 2, ["cash", "10", "20"]), (1, 1, 1, 3, ["other debts", None, "5"]), (1, 1, 2, 1, ["a", "b"]), (1, 1, 2, 2, ["c", "d"]), (None, 1, 1, 1, ["x", "y"]), (None, 1, 1, 2, ["z", "w"])], key=str)


def test_tables_of_pages_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a   b\nc   d\ntext\ne   f\ng   h"), (1, 2, None)], "doc_id long, page_number int, page string")
    found = page_tables.page_tables(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert sorted((r.table_no, r.row_no, r.cells) for r in found.collect()) == [(1, 1, ["a", "b"]), (1, 2, ["c", "d"]), (2, 1, ["e", "f"]), (2, 2, ["g", "h"])]


# Versions --------------------------------------------------------------------


def _ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_change_that_ends_between_two_tables_changes_nothing(spark, tmp_path):
    store = snapshots.Store(spark, f"file:{tmp_path}/store")
    assert store.latest() == 0 and "a" not in store.pin()
    assert store.commit({"a": spark.range(3).toDF("x"), "b": spark.range(2).toDF("y")}) == 1
    old = store.pin()
    broken = spark.range(5).selectExpr("raise_error('broken') AS y")
    with pytest.raises(Exception, match="broken"):
        store.commit({"a": spark.range(9).toDF("x"), "b": broken})
    assert store.latest() == 1 and _ids(store.pin()["a"]) == [0, 1, 2]
    assert store.commit({"a": spark.range(9).toDF("x")}) == 2
    assert _ids(old["a"]) == [0, 1, 2] and _ids(store.pin()["a"]) == list(range(9)) and _ids(store.pin()["b"]) == [0, 1]
    # a writer that began from version 1
    with pytest.raises(snapshots.Conflict):
        store.commit({"b": spark.range(7).toDF("y")}, old)
    assert _ids(store.pin()["b"]) == [0, 1]
    assert store.roll_back(1) == 3 and _ids(store.pin()["a"]) == [0, 1, 2]
    assert len(store.vacuum(keep=1)) == 4  # the table of version 2, and what the failed writers left
    assert store.versions() == [3] and _ids(store.pin()["a"]) == [0, 1, 2] and _ids(store.pin()["b"]) == [0, 1]


def test_a_version_keeps_schema_and_empty_tables(spark, tmp_path):
    store = snapshots.Store(spark, f"file:{tmp_path}/store")
    df = spark.createDataFrame([], "a int, b array<string>")
    pinned = store.pin(store.commit({"t": df}))
    assert pinned["t"].schema == df.schema and pinned["t"].count() == 0
    assert json.loads((tmp_path / "store/versions/000000000001.json").read_text())["version"] == 1


# Discovery -------------------------------------------------------------------


def test_keys_are_new_once(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    schema = "publication_id string, n int"
    known = spark.createDataFrame([("old", 1), (None, 1)], schema)

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = spark.readStream.schema(schema).parquet(str(source))
        q = incremental.discover_new(stream, out, check, known=known, order=["n"])
        q.awaitTermination()
        return sorted((r.publication_id, r.n) for r in spark.read.parquet(out).collect()), q

    add([("a", 2), ("a", 1), ("old", 7), ("b", 5), (None, 3)])
    assert run()[0] == [("a", 1), ("b", 5)]
    add([("a", 0), ("c", 1), ("c", 1), ("old", 0)])
    got, q = run()
    assert got == [("a", 1), ("b", 5), ("c", 1)]
    assert q.lastProgress["numInputRows"] <= 4  # the rows of the batch, and nothing of the table
    assert run()[0] == got


def test_flow_queries_read_whole_tables(spark):
    assert flows.ARCHIVED == 100
    got = registry.queries()["s14_member_runs"](spark, SF)
    assert got.where("failed").count() >= 0 and got.where("not failed").count() > 0


# Pages and files ---------------------------------------------------------------


class _Engine:
    """Reads a table as prose unless the page is segmented as one."""

    def recognize(self, path, page, languages, segmentation, resolution):
        if page == 3:
            raise OSError("unreadable")
        texts = {
            1: {6: "word " * 40, 4: "word " * 30 + "1 2 3 4 5 6 7 8 9 10 " * 4},
            2: {6: "12 345 " * 40, 4: "never read"},
            4: {6: "x" * 900, 4: "never read"},
            5: {6: None, 4: ""},
        }
        return texts[page][segmentation]


def test_pages_are_read_again_where_it_helps(spark):
    pages = spark.createDataFrame([("d", "a.pdf", k) for k in range(1, 6)] + [("e", None, 1), ("e", "b.pdf", None)], "document_id string, path string, page_number int").selectExpr("*", "'x' AS text")
    from tallyforge.operators import recognition

    read = recognition.recognized(pages, _Engine)
    got = {(r.document_id, r.page_number): r for r in read.collect()}
    assert got["d", 1].won and got["d", 1].text.endswith("9 10 ")
    assert not got["d", 2].retried and not got["d", 4].retried and got["d", 4].text == "x" * 900
    assert got["d", 3].text is None and got["d", 3].failure.kind == "OSError" and got["d", 3].failure.stage == "ocr"
    assert got["d", 5].retried and not got["d", 5].won and got["d", 5].text == ""
    assert got["e", 1].failure.kind == got["e", None].failure.kind == "ValueError"
    sums = {r.document_id: tuple(r)[1:4] for r in recognition.counts(read).collect()}
    assert sums == {"d": (5, 1, 2), "e": (2, 2, 0)}
    once = recognition.recognized(pages.where("page_number = 1 and path is not null"), _Engine, recognition.Reading(again=None)).collect()
    assert not once[0].retried


def test_files_beyond_a_column_are_digested(spark, tmp_path):
    from tallyforge.sources import files

    with open(tmp_path / "huge.txt", "wb") as f:
        f.truncate(3 << 30)  # sparse
    (tmp_path / "a b.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "x.pdf.partial").write_bytes(b"%PDF")
    (tmp_path / "zip.txt").write_bytes(b"PK\x03\x04rest")
    (tmp_path / "empty.rtf").write_bytes(b"")
    got = {r.name: (r.length, r.mime_type, r.file_hash) for r in files.inventory(spark, str(tmp_path)).collect()}
    assert got["huge.txt"][:2] == (3 << 30, "text/plain") and len(got["huge.txt"][2]) == 64
    assert got["empty.rtf"][2].startswith("e3b0c442") and got["a b.pdf"][1] == "application/pdf"
    assert set(got) == {"huge.txt", "a b.pdf", "empty.rtf"}


# Model calls -------------------------------------------------------------------


def test_bodies_of_requests(spark):
    from tallyforge.operators import requests

    schema = "system string, user_text string, pdf binary, images array<binary>, schema_name string, schema_description string, json_schema string"
    rows = [
        ('say "x"\n', "text\\ of\tpages é", None, None, "extract", "d", '{"type": "object"}'),
        ("s", "t", b"%PDF", [], "extract", None, None),
        ("s", None, b"%PDF", [b"\x89PNG", None], "extract", "d", "{}"),
    ]
    df = spark.createDataFrame(rows, schema)
    one, two, three = (json.loads(r[0]) for r in df.select(requests.request_body("m", max_tokens=9)).collect())
    assert one["system"] == [{"type": "text", "text": 'say "x"\n', "cache_control": {"type": "ephemeral"}}]
    assert one["messages"] == [{"role": "user", "content": [{"type": "text", "text": "text\\ of\tpages é"}]}]
    assert one["tools"] == [{"name": "extract", "description": "d", "input_schema": {"type": "object"}}] and one["tool_choice"] == {"type": "tool", "name": "extract"}
    assert (one["model"], one["max_tokens"], one["temperature"]) == ("m", 9, 0.0)
    assert two["messages"][0]["content"] == [{"type": "document", "source": {"type": "base64", "media_type": "application/pdf", "data": "JVBERg=="}}, {"type": "text", "text": "t"}]
    assert [c["type"] for c in three["messages"][0]["content"]] == ["image", "text"] and three["messages"][0]["content"][1]["text"] == ""
    (hour, *_) = (json.loads(r[0]) for r in df.select(requests.request_body("m", cache_ttl="1h")).collect())
    (never, *_) = (json.loads(r[0]) for r in df.select(requests.request_body("m", cache_ttl=None)).collect())
    assert hour["system"][0]["cache_control"] == {"type": "ephemeral", "ttl": "1h"} and "cache_control" not in never["system"][0]


def test_outcomes_of_calls(spark):
    from tallyforge.operators import requests

    df = spark.createDataFrame([(200, 1), (402, 1), (401, 3), (429, 1), (529, 3), (404, 1), (None, 1)], "status int, tries int")
    assert [r[0] for r in df.select(requests.call_outcome(F.col("status"), F.col("tries"))).collect()] == ["answered", "unavailable", "unavailable", "again", "unavailable", "failed", "failed"]
