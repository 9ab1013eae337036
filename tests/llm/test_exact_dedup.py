import hashlib
import os
from collections import defaultdict

import pytest

from tallyforge.llm import exact_dedup as x


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")].append((doc_id, text or ""))
    out = []
    for key, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        digest = hashlib.sha256(key.encode()).hexdigest()
        out += [(doc_id, keep, len(members), doc_id == keep, digest) for doc_id, _ in members]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_hard_rows(spark, hard):
    want = brute([tuple(r) for r in hard.select("doc_id", "text").collect()])
    assert rows_of(x.deduplicate(hard)) == want


@pytest.mark.parametrize("memory", [1, 2000, 1 << 20])
def test_small_memory_gives_the_same(spark, memory):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(x.deduplicate(docs, local_memory=memory, bucket_memory=memory)) == want


def test_grace_recursion_removes_its_files(tmp_path):
    records = [x._record(i, "text " + str(i % 300)) for i in range(900)]
    found = list(x.grace(iter(records), str(tmp_path), memory=4000, fan_out=4))
    assert len(found) == 300 and all(r.rows == 3 for r in found)
    assert os.listdir(tmp_path) == []


def test_different_contents_with_one_key_raise():
    table = x.ContentTable()
    table.add(x.Record(b"k", b"k" * 16, b"one", 1, 1, 1))
    with pytest.raises(ValueError, match="same SHA-256"):
        table.add(x.Record(b"k", b"k" * 16, b"two", 1, 2, 1))


def test_keys_that_share_a_slot_stay_apart():
    table = x.ContentTable(8)
    for i in range(20):
        table.add(x.Record(bytes([i]), b"\0" * 8 + bytes([i]) * 8, bytes([i]), 1, i, 1))
    assert sorted(r.doc_id for r in table.drain()) == list(range(20))


def test_empty_table(spark, empty):
    assert x.deduplicate(empty).count() == 0


def test_without_copies_keeps_columns_and_one_row(spark, hard):
    kept = x.without_copies(hard)
    assert kept.columns == hard.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    want = {r[1] for r in brute([tuple(r) for r in hard.select("doc_id", "text").collect()])}
    assert len(ids) == len(set(ids)) and set(ids) == want
