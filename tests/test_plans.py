"""What the plans have to look like at any scale."""

import __spark_entry__ as entry
from meterline.operators.filters import half_open, on_date
from meterline.plans.revenue import monthly_revenue
from querybook.feeds import green, yellow
from tests.conftest import SMALL, plan_of

QUERIES = entry.queries()


def plan(spark, name):
    return plan_of(QUERIES[name](spark, SMALL))


def test_range_reaches_the_scan(spark, small):
    text = plan_of(half_open(small("events"), "ts", "2024-01-05", "2024-01-06"))
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text


def test_day_reaches_the_scan(spark, small):
    assert "GreaterThanOrEqual(ts," in plan_of(on_date(small("events"), "ts", "2024-01-05"))


def test_projection_reads_two_columns(spark):
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan(spark, "project_columns")


def test_range_on_time_prunes_day_partitions(spark):
    text = plan(spark, "distinct_vendor_pruned")
    assert "PartitionFilters: [isnotnull(day" in text


def test_monthly_revenue_shuffles_once(small):
    assert plan_of(monthly_revenue(green(small), yellow(small))).count(") Exchange\n") == 1


def test_one_service_reads_one_table(small):
    text = plan_of(monthly_revenue(green(small), yellow(small)).where("service_type = 'green'"))
    assert text.count("Scan parquet \n") == 1 and "orders.parquet" in text


def test_dedup_limits_each_key_before_the_shuffle(spark):
    assert plan(spark, "dedup_composite").count("WindowGroupLimit") >= 2


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(spark, "limit_rows")
    assert "TakeOrderedAndProject" in plan(spark, "least_busy_zones")


def test_native_label_needs_no_python(spark):
    assert "EvalPython" not in plan(spark, "base_id_native")
    assert "ArrowEvalPython" in plan(spark, "base_id_udf")


def test_child_table_reads_key_and_own_field_only(spark):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(spark, "child_nested_levels")


def test_no_query_pairs_rows_without_a_key(spark):
    for name in ("pages_until_empty", "trip_zone_names_comma", "month_spine", "load_state"):
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
