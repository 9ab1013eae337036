"""Workbooks of a mart (K1-K3): one sheet per table, written by partitions, put in place when whole.

Tasks write the rows of their partition, compressed, to a file in the shared
folder. Such parts follow one another in an archive's member as they are, and
their checksums combine, so the driver joins bytes and holds a line of figures
for each partition, never a row. A sheet has at most ``MOST_ROWS`` rows by its format.
"""

from __future__ import annotations

import datetime
import os
import re
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyforge.operators.mart import column_widths
from tallyforge.shared import filesystem, fresh_dir

MOST_ROWS = 1_048_575
# Fixed values of the format.
TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
#: cell styles: general, whole numbers, other numbers, header
STYLES = (
    f'{HEAD}<styleSheet xmlns="{MAIN}"><numFmts count="2"><numFmt numFmtId="164" formatCode="#,##0"/><numFmt numFmtId="165" formatCode="#,##0.##"/></numFmts>'
    "<fonts count=\"2\"><font/><font><b/></font></fonts><fills count=\"1\"><fill/></fills><borders count=\"1\"><border/></borders><cellStyleXfs count=\"1\"><xf/></cellStyleXfs>"
    '<cellXfs count="4"><xf/><xf numFmtId="164" applyNumberFormat="1"/><xf numFmtId="165" applyNumberFormat="1"/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>'
)
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿\ud800-\udfff]")


def _cell(value: object, style: int | None = None) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        whole = value == int(value)
        return f'<c s="{style if style is not None else 1 if whole else 2}"><v>{value!r}</v></c>'
    if isinstance(value, datetime.datetime):
        value = value.replace(tzinfo=None)
    if isinstance(value, (datetime.date, datetime.datetime)):
        value = value.isoformat()
    mark = "" if style is None else f' s="{style}"'
    return f'<c t="inlineStr"{mark}><is><t xml:space="preserve">{escape(_CONTROL.sub("", str(value)))}</t></is></c>'


@dataclass(frozen=True)
class Part:
    """A run of a member's bytes, deflated without an end: a file, or the bytes themselves."""

    crc: int
    size: int
    packed: int
    rows: int = 0
    uri: str | None = None
    data: bytes = b""

    @classmethod
    def of(cls, text: str) -> Part:
        raw = text.encode("utf-8")
        c = zlib.compressobj(wbits=-15)
        data = c.compress(raw) + c.flush(zlib.Z_FULL_FLUSH)
        return cls(zlib.crc32(raw), len(raw), len(data), data=data)


#: ends a deflated stream
LAST_BLOCK = b"\x03\x00"
#: of the checksum's polynomial, without its highest term, lowest power first
POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials of the checksum's field; bit 31 is the power 0."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, length: int) -> int:
    """CRC-32 of two runs of bytes, one after the other, from theirs and the length of the second: the first is moved on by x^(8 * length)."""
    power, square, n = 1 << 31, 1 << 30, 8 * length
    while n:
        if n & 1:
            power = _times(power, square)
        square, n = _times(square, square), n >> 1
    return _times(first, power) ^ second


# Fixed values of the zip format.
LOCAL, CENTRAL, END64, LOCATOR64, END = (struct.Struct(f"<4s{f}") for f in ("5H3L2H", "6H3L5H2L", "Q2H2L4Q", "LQL", "4H2LH"))
FULL = 0xFFFFFFFF


class Archive:
    """A zip archive whose members are joined from deflated parts; all fields are of 64 bits."""

    def __init__(self, path: Path):
        self.out, self.entries = path.open("wb"), []

    def member(self, name: str, parts: Iterable[Part]) -> None:
        parts, at = list(parts), self.out.tell()
        crc = size = 0
        for p in parts:
            crc, size = joined_crc(crc, p.crc, p.size), size + p.size
        packed = sum(p.packed for p in parts) + len(LAST_BLOCK)
        extra = struct.pack("<2H2Q", 1, 16, size, packed)
        self.out.write(LOCAL.pack(b"PK\3\4", 45, 0x800, 8, 0, 0x21, crc, FULL, FULL, len(name.encode()), len(extra)) + name.encode() + extra)
        for p in parts:
            if p.uri is None:
                self.out.write(p.data)
                continue
            system, path = filesystem(p.uri)
            with system.open_input_stream(path) as source:
                shutil.copyfileobj(source, self.out, 1 << 20)
        self.out.write(LAST_BLOCK)
        self.entries.append((name.encode(), crc, size, packed, at))

    def close(self) -> None:
        start = self.out.tell()
        for name, crc, size, packed, at in self.entries:
            extra = struct.pack("<2H3Q", 1, 24, size, packed, at)
            self.out.write(CENTRAL.pack(b"PK\1\2", 45, 45, 0x800, 8, 0, 0x21, crc, FULL, FULL, len(name), len(extra), 0, 0, 0, 0, FULL) + name + extra)
        end, n = self.out.tell(), len(self.entries)
        self.out.write(END64.pack(b"PK\6\6", 44, 45, 45, 0, 0, n, n, end - start, start) + LOCATOR64.pack(b"PK\6\7", 0, end, 1))
        self.out.write(END.pack(b"PK\5\6", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), FULL, FULL, 0))
        self.out.close()


PARTS = "number int, uri string, crc long, size long, packed long, n int"


def _write_parts(where: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        uri = f"{where}/{number:06d}-{uuid.uuid4().hex}"  # of the attempt: the one whose row is kept is joined
        system, path = filesystem(uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        c, crc, size, packed, rows = zlib.compressobj(wbits=-15), 0, 0, 0, 0
        with system.open_output_stream(path) as out:
            for batch in batches:
                for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    raw = ("<row>" + "".join(map(_cell, row)) + "</row>").encode("utf-8")
                    crc, size, rows = zlib.crc32(raw, crc), size + len(raw), rows + 1
                    data = c.compress(raw)
                    packed += len(data)
                    out.write(data)
            data = c.flush(zlib.Z_FULL_FLUSH)
            out.write(data)
        yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int32()), "uri": [uri], "crc": pa.array([crc], pa.int64()), "size": pa.array([size], pa.int64()), "packed": pa.array([packed + len(data)], pa.int64()), "n": pa.array([rows], pa.int32())})

    return run


def sheet_parts(name: str, sheet: DataFrame) -> list[Part]:
    """The sheet's rows as parts in the order of its partitions; ValueError if they are too many."""
    found = sheet.mapInArrow(_write_parts(fresh_dir(sheet.sparkSession, "workbook")), PARTS).collect() if sheet.columns else []
    if sum(r.n for r in found) > MOST_ROWS:
        raise ValueError(f"sheet {name!r} has more than {MOST_ROWS} rows")
    return [Part(r.crc, r.size, r.packed, r.n, r.uri) for r in sorted(found, key=lambda r: r.number) if r.n]


def write_workbook(sheets: dict[str, DataFrame], path: str) -> None:
    """Write the sheets in their order; an old file stays until the new one is whole."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f".{target.name}.{uuid.uuid4().hex}.partial")
    names = list(sheets)
    rows = {name: sheet_parts(name, sheet) for name, sheet in sheets.items()}
    try:
        z = Archive(part)
        try:
            overrides = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
            types = (
                f'{HEAD}<Types xmlns="{TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
                '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                f'<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{overrides}</Types>'
            )
            z.member("[Content_Types].xml", [Part.of(types)])
            z.member("_rels/.rels", [Part.of(f'{HEAD}<Relationships xmlns="{PACKAGE}"><Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')])
            listed = "".join(f'<sheet name="{escape(n[:31])}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
            z.member("xl/workbook.xml", [Part.of(f'{HEAD}<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets>{listed}</sheets></workbook>')])
            links = "".join(f'<Relationship Id="rId{k}" Type="{LINKS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
            z.member("xl/_rels/workbook.xml.rels", [Part.of(f'{HEAD}<Relationships xmlns="{PACKAGE}">{links}<Relationship Id="rId{len(names) + 1}" Type="{LINKS}/styles" Target="styles.xml"/></Relationships>')])
            z.member("xl/styles.xml", [Part.of(STYLES)])
            for k, name in enumerate(names, 1):
                sheet = sheets[name]
                widths = {r.column: r.width for r in column_widths(sheet, sheet.columns).collect()}
                columns = "".join(f'<col min="{i}" max="{i}" width="{widths[c]}" customWidth="1"/>' for i, c in enumerate(sheet.columns, 1))
                head = "<row>" + "".join(_cell(c, 3) for c in sheet.columns) + "</row>"
                first = Part.of(f'{HEAD}<worksheet xmlns="{MAIN}"><cols>{columns}</cols><sheetData>{head}')
                z.member(f"xl/worksheets/sheet{k}.xml", [first, *rows[name], Part.of("</sheetData></worksheet>")])
        finally:
            z.close()
        os.replace(part, target)
    finally:
        part.unlink(missing_ok=True)
