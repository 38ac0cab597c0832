"""What the physical plans must and must not contain."""

import pytest

from harness import registry
from harness.registry import QUERIES

SF = "/root/testdata/sf0.001"

# These start streams or write tables while the frame is being built.
STORED = {n for n in QUERIES if n.startswith("stream_")} | {
    "bronze_landing",
    "bronze_unreadable_periods",
    "carbon_revisions",
    "demand_forecast",
    "medallion_counts",
    "medallion_reruns",
    "medallion_two_runs",
    "merge_null_partition",
    "quality_report",
    "silver_merge_two_loads",
    "stored_event_counts",
    "stored_retention",
}
LAZY = sorted(set(QUERIES) - STORED)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapIn"):
        assert banned not in text, name


@pytest.mark.parametrize(
    "name", ["live_demand", "demand_hourly", "low_carbon_windows", "threshold_alerts", "retained_events"]
)
def test_time_range_reaches_the_scan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    if name != "threshold_alerts":
        assert "GreaterThan" in text.split("PushedFilters:")[1].split("]")[0]
    assert "props" not in text  # unused columns are not read


@pytest.mark.parametrize("name", ["fact_demand", "fact_generation", "fact_carbon_intensity"])
def test_facts_shuffle_only_to_deduplicate(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize(
    "name", ["five_minute_rollup", "event_counts", "freshness", "live_demand", "intensity_demand_overlay"]
)
def test_aggregates_are_partial_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.count("HashAggregate") == 2 and "partial_" in text
    assert text.count("FileScan") == 1


def test_latest_events_are_a_bounded_top_k(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["latest_events"](spark, SF))


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(registry.ORACLE)


def test_day_folders_outside_the_range_are_not_opened(spark):
    text = plan(QUERIES["stored_event_counts"](spark, SF))
    assert "event_date" in text.split("PartitionFilters:")[1].split("]")[0]


def test_an_event_line_is_parsed_once(spark):
    from wattline.sources import events

    lines = spark.range(3).selectExpr("cast(id as string) as value")
    for frame in (events.parse_event_json(lines), events.rejected(events.checked_events(lines))):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, plan
