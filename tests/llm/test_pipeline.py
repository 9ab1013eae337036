import unicodedata
import zlib
from collections import defaultdict

import corpus_pipeline
from tallyforge.llm import language
from tallyforge.llm.storage import stored
from tests.llm.test_exact_dedup import brute as copies
from tests.llm.test_minhash import brute as near
from tests.llm.test_tokens_secrets_leaks import leaks

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        rows = [(i, texts[i]) for i in sorted(r.doc_id for r in docs.select("doc_id").collect())]
        docs = stored(stage(spark, docs, SF), "test")
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == {i for i, _ in rows}
            break
        assert docs.columns == columns
        got = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if name == "language":
            want = [i for i, t in rows if any(unicodedata.category(c)[0] == "L" for c in t or "")]
        elif name == "exact_dedup":
            want = sorted({r[1] for r in copies(rows)})
        elif name == "near_dedup":
            want = sorted({c for _, c in near(rows, 5, 80).values()})
        else:
            bad = {r[0] for r in leaks(rows, items)}
            want = [i for i, _ in rows if i not in bad]
            assert bad
        assert got == want, name


def test_run_packs_what_the_stages_keep(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    by = defaultdict(int)
    for r in rows:
        by[r.doc_id] += r.length
    assert all(by[r.doc_id] == r.doc_tokens for r in rows)


def test_hard_rows(spark, hard, tmp_path):
    hard.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {5, 7, 8, 10, 11, 12, None} or {r.doc_id for r in got} == {4, 7, 8, 10, 11, 12, None}


def test_empty_table(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_held_out_is_by_crc(spark):
    ids = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    got = {r[0] for r in ids.where(language.held_out("doc_id")).collect()}
    assert got == {i for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2}
