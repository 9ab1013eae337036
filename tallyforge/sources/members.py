"""Members of archives as rows of their own.

``member_index`` reads the directory of each archive, and no data: a row a
member, with the run of neighbours it is read with. ``read_members`` deals the
runs over tasks, which read the members' byte ranges and unpack them in blocks,
so memory is bounded by a block whatever the size of a member or an archive.
Zip (stored, deflated, bzip2, also of 64 bits) and stored members of rar are read; an
archive with another method needs an adapter and is a failure.
"""

from __future__ import annotations

import bz2
import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.shared import filesystem, stored

BLOCK = 1 << 20
INDEX = "path string, member string, method int, at long, local boolean, packed long, size long, crc long, run int, error string"
FIELDS = [f.split()[0] for f in INDEX.split(", ")]
KINDS = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]

# Fixed values of the zip format: records and their marks.
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
END_RECORD, END64_RECORD, CENTRAL_RECORD, LOCAL_RECORD = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")
# Fixed values of the rar format: marks of its two versions.
RAR4, RAR5 = b"Rar!\x1a\x07\x00", b"Rar!\x1a\x07\x01\x00"
STORED, DEFLATED, BZIP2 = 0, 8, 12


class Unreadable(ValueError):
    """An archive that cannot be unpacked as a whole."""


def safe_name(name: str) -> str:
    parts = [p for p in name.replace("\\", "/").split("/") if p]
    if not name or name.replace("\\", "/").startswith("/") or ".." in parts:
        raise Unreadable(f"unsafe member {name!r}")
    return name


def _zip_directory(f, size: int) -> tuple[int, int, int]:
    """Start and bytes of the central directory, and the bytes that stand before the archive."""
    at = max(0, size - (1 << 16) - END_RECORD.size)
    f.seek(at)
    tail = f.read(size - at)
    end = tail.rfind(END)
    if end < 0 or len(tail) - end < END_RECORD.size:
        raise Unreadable("no end of a zip archive")
    _, _, _, _, _, length, start, _ = END_RECORD.unpack_from(tail, end)
    end += at
    if start == 0xFFFFFFFF or length == 0xFFFFFFFF:
        f.seek(end - 20)
        mark, _, where, _ = struct.unpack("<4sLQL", f.read(20))
        if mark != LOCATOR64:
            raise Unreadable("no 64-bit end of a zip archive")
        f.seek(where)
        record = END64_RECORD.unpack(f.read(END64_RECORD.size))
        if record[0] != END64:
            raise Unreadable("no 64-bit end of a zip archive")
        length, start, end = record[8], record[9], where
    before = end - length - start
    if before < 0:
        raise Unreadable("the directory of a zip archive is cut")
    return start + before, length, before


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and place from the 64-bit field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            more = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(more, v) if v == 0xFFFFFFFF else v for v in values]
        at += 4 + length
    return values


def zip_members(f, size: int) -> Iterator[tuple[str, int, int, int, int, int]]:
    """(name, method, place of the local record, packed, size, crc) of each file, read in blocks."""
    start, length, before = _zip_directory(f, size)
    f.seek(start)
    data, read = b"", 0
    while length - read or data:
        while len(data) < 1 << 18 and read < length:
            data += f.read(min(BLOCK, length - read))
            read = f.tell() - start
        if len(data) < CENTRAL_RECORD.size:
            raise Unreadable("the directory of a zip archive is cut")
        mark, _, _, flags, method, _, _, crc, packed, whole, n, m, c, _, _, _, where = CENTRAL_RECORD.unpack_from(data)
        if mark != CENTRAL:
            raise Unreadable("the directory of a zip archive is damaged")
        at = CENTRAL_RECORD.size
        name = data[at : at + n].decode("utf-8" if flags & 0x800 else "cp437").split("\0")[0]
        whole, packed, where = _wide(data[at + n : at + n + m], [whole, packed, where])
        data = data[at + n + m + c :]
        if name.endswith("/"):
            continue
        if flags & 1:
            raise Unreadable(f"member {name!r} is encrypted")
        if method not in (STORED, DEFLATED, BZIP2):
            raise Unreadable(f"member {name!r} has method {method}")
        yield name, method, where + before, packed, whole, crc


def _vint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return value, at


def rar_members(f, size: int) -> Iterator[tuple[str, int, int, int, int, int]]:
    """As ``zip_members``, with the place of the data itself; packed members raise."""
    f.seek(0)
    head = f.read(8)
    yield from _rar5(f, size) if head == RAR5 else _rar4(f, size)


def _stored_only(name: str, plain: bool) -> None:
    if not plain:
        raise Unreadable(f"member {name!r} is packed or encrypted: rar needs an adapter")


def _rar5(f, size: int) -> Iterator[tuple[str, int, int, int, int, int]]:
    at = len(RAR5)
    while at < size:
        f.seek(at)
        head = f.read(32)
        length, begin = _vint(head, 4)
        f.seek(at + begin)
        body = f.read(length)
        if len(body) < length:
            raise Unreadable("a rar archive is cut")
        kind, k = _vint(body, 0)
        flags, k = _vint(body, k)
        if flags & 1:
            _, k = _vint(body, k)
        packed = 0
        if flags & 2:
            packed, k = _vint(body, k)
        data_at = at + begin + length
        at = data_at + packed
        if kind == 4:
            raise Unreadable("a rar archive is encrypted")
        if kind == 5:
            return
        if kind != 2:
            continue
        file_flags, k = _vint(body, k)
        whole, k = _vint(body, k)
        _, k = _vint(body, k)
        k += 4 * bool(file_flags & 2)
        crc = struct.unpack_from("<L", body, k)[0] if file_flags & 4 else None
        k += 4 * bool(file_flags & 4)
        how, k = _vint(body, k)
        _, k = _vint(body, k)
        n, k = _vint(body, k)
        name = body[k : k + n].decode("utf-8", "replace")
        if file_flags & 1:
            continue
        _stored_only(name, not how >> 7 & 7 and packed == whole)
        yield name, STORED, data_at, packed, whole, crc


def _rar4(f, size: int) -> Iterator[tuple[str, int, int, int, int, int]]:
    at = len(RAR4)
    while at + 7 <= size:
        f.seek(at)
        _, kind, flags, length = struct.unpack("<HBHH", f.read(7))
        body = f.read(length - 7)
        if length < 7 or len(body) < length - 7:
            raise Unreadable("a rar archive is cut")
        packed = struct.unpack_from("<L", body)[0] if flags & 0x8000 or kind == 0x74 else 0
        if kind == 0x7B:
            return
        if kind != 0x74:
            at += length + packed
            continue
        whole, _, crc, _, _, method, n, _ = struct.unpack_from("<LBLLBBHL", body, 4)
        k = 25
        if flags & 0x100:
            high, high_whole = struct.unpack_from("<LL", body, k)
            packed, whole, k = packed | high << 32, whole | high_whole << 32, k + 8
        name = body[k : k + n].split(b"\0")[0].decode("utf-8", "replace").replace("\\", "/")
        data_at, at = at + length, at + length + packed
        if flags & 0xE0 == 0xE0:
            continue
        _stored_only(name, method == 0x30 and not flags & 4 and packed == whole)
        yield name, STORED, data_at, packed, whole, crc


def _indexed(path: str, most: int, run_bytes: int) -> Iterator[tuple]:
    """Rows of one archive; ValueError or OSError where it cannot be unpacked."""
    system, where = filesystem(path)
    with system.open_input_file(where) as f:
        size = f.size()
        head = f.read(8)
        rar = head == RAR5 or head[:7] == RAR4
        total = run = in_run = 0
        for name, method, at, packed, whole, crc in rar_members(f, size) if rar else zip_members(f, size):
            safe_name(name)
            total += whole
            if total > most:
                raise Unreadable(f"more than {most} bytes")
            if in_run and in_run + packed > run_bytes:
                run, in_run = run + 1, 0
            in_run += packed
            yield path, name, method, at, not rar, packed, whole, crc, run, None


def _table(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [()] * len(names), kinds, strict=True)], names=names)


def member_index(archives: DataFrame, max_bytes: int = 500 << 20, run_bytes: int = 64 << 20) -> DataFrame:
    """Members of the archives (column ``path``, a URI that executors reach), from their directories alone.

    An archive with an unsafe name, of more than ``max_bytes`` unpacked, or that
    cannot be read has one row with ``error``, and members of it that stand
    beside that row are not to be read (``read_members`` leaves them out).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for path in batch[0].to_pylist():
                try:
                    for row in _indexed(path or "", max_bytes, run_bytes):
                        rows.append(row)
                        if len(rows) >= 4096:
                            yield _table(rows, KINDS, FIELDS)
                            rows = []
                except (ValueError, OSError, struct.error, IndexError) as e:
                    rows.append((path, *[None] * 8, str(e) or type(e).__name__))
        yield _table(rows, KINDS, FIELDS)

    return archives.select("path").mapInArrow(run, INDEX)


def _blocks(f, at: int, length: int) -> Iterator[bytes]:
    f.seek(at)
    while length:
        block = f.read(min(BLOCK, length))
        if not block:
            raise Unreadable("a member is cut")
        length -= len(block)
        yield block


def _deflated(blocks: Iterator[bytes]) -> Iterator[bytes]:
    d = zlib.decompressobj(-15)
    for block in blocks:
        while block:
            yield d.decompress(block, BLOCK)
            block = d.unconsumed_tail
    while not d.eof:
        rest = d.decompress(d.unconsumed_tail, BLOCK)
        if not rest:
            raise Unreadable("a member is cut")
        yield rest


def _bzipped(blocks: Iterator[bytes]) -> Iterator[bytes]:
    d = bz2.BZ2Decompressor()
    for block in blocks:
        yield d.decompress(block, BLOCK)
        while not d.needs_input and not d.eof:
            yield d.decompress(b"", BLOCK)


UNPACK: dict[int, Callable[[Iterator[bytes]], Iterator[bytes]]] = {STORED: lambda blocks: blocks, DEFLATED: _deflated, BZIP2: _bzipped}


def unpacked(f, method: int, at: int, local: bool, packed: int, size: int, crc: int | None) -> Iterator[bytes]:
    """The data of a member in blocks; Unreadable where length or checksum are not as the directory says."""
    if local:
        f.seek(at)
        record = LOCAL_RECORD.unpack(f.read(LOCAL_RECORD.size))
        if record[0] != LOCAL:
            raise Unreadable("a member is not where the directory says")
        at += LOCAL_RECORD.size + record[9] + record[10]
    done = check = 0
    try:
        for block in UNPACK[method](_blocks(f, at, packed)):
            done += len(block)
            if done > size:
                break
            check = zlib.crc32(block, check)
            yield block
    except (zlib.error, OSError, EOFError) as e:
        raise Unreadable(f"a member is damaged: {e}") from e
    if done != size or crc is not None and check != crc:
        raise Unreadable("a member is not what its checksum says")


READ = "path string, member string, size long, file_hash string, error string"
CHUNKS = "path string, member string, chunk int, content binary, error string"


def _read(chunks: bool):
    names = [f.split()[0] for f in (CHUNKS if chunks else READ).split(", ")]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string()] if chunks else [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                digest = hashlib.sha256()
                try:
                    system, where = filesystem(row["path"])
                    with system.open_input_file(where) as f:
                        for k, block in enumerate(unpacked(f, row["method"], row["at"], row["local"], row["packed"], row["size"], row["crc"])):
                            digest.update(block)
                            if chunks:
                                yield _table([(row["path"], row["member"], k, block, None)], kinds, names)
                    if not chunks:
                        rows.append((row["path"], row["member"], row["size"], digest.hexdigest(), None))
                except (ValueError, OSError, struct.error) as e:
                    rows.append((row["path"], row["member"], None, None, str(e) or type(e).__name__))
                if len(rows) >= 4096:
                    yield _table(rows, kinds, names)
                    rows = []
        yield _table(rows, kinds, names)

    return run


def read_members(archives: DataFrame, *, chunks: bool = False, max_bytes: int = 500 << 20, run_bytes: int = 64 << 20) -> DataFrame:
    """path, member, size, file_hash, error of each member; of an archive that fails one row with its error and no members.

    With ``chunks`` the contents come as rows (path, member, chunk, content, error) of
    at most a block, in the order of ``chunk``; an empty member has none.
    """
    index = stored(member_index(archives, max_bytes, run_bytes), "archive-index")
    # by number: rows of the index are small, so Spark would join them all into one task, but their members are not
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.where("error is null").repartition(tasks, "path", "run")
    found = stored(dealt.mapInArrow(_read(chunks), CHUNKS if chunks else READ), "archive-members")
    wrong = index.where("error is not null").select("path", "error").unionByName(found.where("error is not null").select("path", "error")).groupBy("path").agg(F.min("error").alias("error"))
    good = found.where("error is null").join(wrong.select("path"), "path", "left_anti")
    empty = [F.lit(None).cast(t).alias(n) for n, t in (f.split() for f in (CHUNKS if chunks else READ).split(", ")) if n not in ("path", "error")]
    return good.unionByName(wrong.select("path", *empty, "error"))
