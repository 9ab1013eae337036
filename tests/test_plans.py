"""Physical plans: no products of large tables, pruned columns, no Python where none is needed."""

import re

import pytest

from tallyforge.plans import registry
from tallyforge.plans.domain import table

SF = "/root/testdata/sf0.001"
# products with a side of a few rows by construction: four types, three standards, one row of totals
SMALL_PRODUCTS = {"p11_applicable_metrics", "p14_probe_status", "j15_type_grid", "a20_probe_matrix", "a18_probe_summary", "a8_totals", "c7_failure_classes"}
PYTHON = {"s4_log_ranges", "w8_stage_outcomes", "s1_listing_rows", "s2_view_source", "s10_message_text", "s11_document_links", "s12_search_results", "s14_unpack", "f10_section", "f11_cleaned", "f21_outer_object", "j14_best_names", "m1_model_extraction"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_plan(spark, name):
    p = plan(registry.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    # the domain view of metrics multiplies each period by five metric names
    loops = len(re.findall("BroadcastNestedLoopJoin", p)) - len(re.findall(r"LocalTableScan \[metric_name", p))
    assert name in SMALL_PRODUCTS or loops <= 0
    assert bool(re.search("Python|Arrow|Pandas", p)) == (name in PYTHON)


def test_columns_are_pruned(spark):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(registry.queries()["f4_short"](spark, SF)))
    assert read == ["doc_id:bigint,text:string"]
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(registry.queries()["a9_status_counts"](spark, SF)))
    assert read == ["o_orderkey:bigint"]


def test_filters_reach_the_scan(spark):
    # through a join and two views
    assert "GreaterThan(l_linenumber,5)" in plan(table(spark, SF, "early_filings"))


def test_counts_are_combined_before_the_shuffle(spark):
    p = plan(registry.queries()["a4_documents_of_ticker"](spark, SF))
    assert p.index("HashAggregate") < p.index("partial_count")


def _physical(spark, name, sf="/root/testdata/sf0.001"):
    return registry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["j2_export_mart", "t2_sheet_order", "k2_number_format", "d9_replace_metrics"])
def test_periods_are_joined_before_their_metrics_are_spread(spark, name):
    plan = _physical(spark, name)
    assert plan.index("NestedLoopJoin") < min(k for k in (plan.find("SortMergeJoin"), plan.find("HashJoin")) if k >= 0)


def test_lines_are_not_shuffled_for_one_ticker(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 200_000)  # less than the orders
    try:
        plan = _physical(spark, "p16_base_scan", "/root/testdata/sf0.1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(l_orderkey" not in plan and "lineitem" in plan


def test_lines_are_read_once_for_their_route(spark):
    assert _physical(spark, "p17_request_route").count("lineitem.parquet") == 1
