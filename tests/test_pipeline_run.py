"""The status-driven pipeline from listing to mart, and the streaming form of discovery."""

import sys
import uuid

from pyspark.sql import functions as F

import __spark_entry__
from tallyforge.operators.extraction import FixedProvider
from tallyforge.plans import pipeline
from tallyforge.plans.domain import table
from tallyforge.streaming import incremental

SF = "/root/testdata/sf0.001"


def fresh(spark):
    p = table(spark, SF, "publications")
    metrics = table(spark, SF, "metrics").where("false").select("metric_id", "ticker", "reporting_date", "period_type", "reporting_standard", "metric_name", "value", "currency", "unit", "source_document_id")
    issues = spark.createDataFrame([], "publication_id string, ticker string, code string, message string")
    return p, pipeline.State(p.where("false"), table(spark, SF, "filings"), metrics, issues)


def test_cold_run_then_a_second_run_changes_nothing(spark, tmp_path):
    found, s = fresh(spark)
    found = found.withColumn("status", F.lit("discovered")).withColumn("last_error", F.lit(None).cast("string"))

    def store(df):
        path = str(tmp_path / uuid.uuid4().hex)
        df.write.parquet(path)
        return spark.read.parquet(path)

    s1, answers = pipeline.run(s, found, FixedProvider, store)
    by = {r.status: r["count"] for r in s1.publications.groupBy("status").count().collect()}
    assert s1.publications.count() == found.count() and by["written"] > 0
    assert set(by) <= {"written", "extracted", "skipped", "failed"}
    assert s1.metrics.count() > 0
    waiting = answers.where("unavailable").count()
    assert waiting > 0 and by["extracted"] >= waiting
    s2, more = pipeline.run(s1, found, FixedProvider, store, answers)
    assert more.count() == 0
    assert s2.publications.count() == s1.publications.count() and s2.metrics.count() == s1.metrics.count()


def test_discovery_as_a_stream(spark, tmp_path):
    schema = "publication_id string, ticker string"
    source, out = tmp_path / "in", str(tmp_path / "out")
    spark.createDataFrame([("a", "T"), ("b", "T"), ("a", "T")], schema).coalesce(1).write.parquet(str(source))
    stream = lambda: spark.readStream.schema(schema).parquet(str(source))
    incremental.discover_new(stream(), out, str(tmp_path / "check")).awaitTermination()
    spark.createDataFrame([("b", "T"), ("c", "T")], schema).coalesce(1).write.mode("append").parquet(str(source))
    incremental.discover_new(stream(), out, str(tmp_path / "check")).awaitTermination()
    assert sorted(r.publication_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_entry_works_without_the_corpus_package(monkeypatch):
    import importlib

    for name in [m for m in sys.modules if m.startswith("tallyforge.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    bare = importlib.reload(__spark_entry__)
    assert "j2_export_mart" in bare.queries() and "pipeline" not in bare.queries() and not any(n.startswith("op") for n in bare.queries())
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
