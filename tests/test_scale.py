"""Plan properties that keep the queries usable on large data."""

import pytest

from eventloom.fixtures import Tables
from eventloom.operators import udf_report
from eventloom.plans import checkouts, events, pages, revenue, traffic
from eventloom.suite import QUERIES
from tests.conftest import optimized, plan

FOLDER = "/root/testdata/sf0.001"
WRITES_FILES = {"streaming_ingest", "ingested_channels", "compacted_layout", "users_by_sketch", "point_lookup"}


@pytest.fixture(scope="module")
def plans(spark):
    """Optimized and physical plan of every query, with joins planned as for tables too large to broadcast."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        return {
            name: (optimized(df), plan(df))
            for name, run in QUERIES.items()
            if name not in WRITES_FILES
            for df in [run(spark, FOLDER)]
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_no_cross_joins(plans):
    for name, (_, physical) in plans.items():
        assert "CartesianProduct" not in physical and "NestedLoopJoin" not in physical, name


def test_nothing_is_broadcast_by_hint(plans):
    for name, (_, physical) in plans.items():
        assert "BroadcastHashJoin" not in physical, name


# Windows without a partition: the rows are days or funnel stages.
SINGLE_TASK_WINDOWS = {"daily_revenue_7day", "daily_revenue_7days_calendar", "funnel_sql", "funnel_stages"}


def test_single_task_windows_only_on_tiny_series(plans):
    for name, (_, physical) in plans.items():
        lines = physical.splitlines()
        windows = [i for i, line in enumerate(lines) if "Window [" in line]
        single = [i for i in windows if any("Exchange SinglePartition" in line for line in lines[i : i + 4])]
        assert not single or name in SINGLE_TASK_WINDOWS, name


def test_only_the_udf_query_leaves_the_jvm(spark):
    for name in ("event_overview", "traffic_channels", "top_pages", "params_long", "channel_title", "sessionize"):
        assert udf_report(QUERIES[name](spark, FOLDER)) == []
    assert udf_report(QUERIES["udf_label"](spark, FOLDER))


def test_scans_read_only_what_is_needed(spark):
    t = Tables(spark, FOLDER)
    assert "ReadSchema: struct<event_type:string,value:double>" in plan(events.event_counts(t.events()))
    text = plan(checkouts.checkouts_by_year(t.checkouts(), suffix="BOOK"))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in text
    assert "html" not in plan(pages.top_pages(t.params()))


def test_daily_revenue_aggregates_before_the_shuffle(spark):
    text = plan(revenue.daily_revenue(Tables(spark, FOLDER).events()))
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning")


def test_join_inputs_are_reduced_first(spark):
    """Both inputs of the join on user and day are aggregates, so one busy user does not make a large partition."""
    t = Tables(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(traffic.device_medium_purchases(t.events(), t.sessions()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[text.index("SortMergeJoin") :]
    assert below.count("HashAggregate") >= 4
