import datetime
import zipfile
import zlib
from xml.etree import ElementTree

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.sources import xlsx

NS = {"m": xlsx.MAIN}


def cells(path, sheet):
    with zipfile.ZipFile(path) as z:
        root = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    out = []
    for row in root.iterfind(".//m:row", NS):
        out.append([(c.get("s"), "".join(c.itertext()) or None) for c in row.iterfind("m:c", NS)])
    return root, out


def test_workbook(spark, tmp_path):
    one = spark.createDataFrame([("a<&>\x01", 5.0, 2.5, True, None, datetime.date(2024, 1, 2)), ("long " * 30, float("nan"), -1.0, False, 7, None)], "name string, v double, w double, b boolean, n int, d date")
    path = tmp_path / "out" / "mart.xlsx"
    xlsx.write_workbook({"metrics": one, "empty": one.where("false")}, str(path))
    root, got = cells(path, 1)
    assert got[0] == [("3", c) for c in one.columns]
    assert got[1] == [(None, "a<&>"), ("1", "5.0"), ("2", "2.5"), (None, "1"), (None, None), (None, "2024-01-02")]
    assert got[2][1] == (None, "nan") and got[2][4] == ("1", "7")
    assert [c.get("width") for c in root.iterfind(".//m:col", NS)] == ["60", "12", "12", "12", "12", "12"]
    assert len(cells(path, 2)[1]) == 1
    assert sorted(p.name for p in path.parent.iterdir()) == ["mart.xlsx"]


def test_too_many_rows_leave_the_old_file(spark, tmp_path, monkeypatch):
    path = tmp_path / "mart.xlsx"
    path.write_bytes(b"old")
    monkeypatch.setattr(xlsx, "MOST_ROWS", 2)
    with pytest.raises(ValueError, match="more than 2 rows"):
        xlsx.write_workbook({"s": spark.range(3)}, str(path))
    assert path.read_bytes() == b"old" and len(list(tmp_path.iterdir())) == 1


def test_sheets_of_many_partitions_keep_their_order(spark, tmp_path):
    sheet = spark.range(5000).selectExpr("id", "concat('row ', id) AS name", "id / 4 AS v").repartition(13).orderBy("id")
    path = tmp_path / "mart.xlsx"
    xlsx.write_workbook({"s": sheet, "t": sheet.limit(0)}, str(path))
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None  # every checksum, combined of those of its parts
        assert [i.file_size for i in z.infolist()] == [len(z.read(i)) for i in z.infolist()]
    _, got = cells(path, 1)
    assert [r[0][1] for r in got] == ["id", *map(str, range(5000))] and got[77][1][1] == "row 76" and got[78][2][1] == "19.25"
    assert len(cells(path, 2)[1]) == 1


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=300), st.binary(max_size=300))
def test_checksums_combine(a, b):
    assert xlsx.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
