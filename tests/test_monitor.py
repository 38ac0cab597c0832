"""Monitoring queries at their operating defaults, on a handful of literal events."""

from datetime import datetime, timedelta

import pytest

from wattline.operators.retention import apply_retention
from wattline.plans import monitor
from wattline.sources.events import CARBON_SOURCE, SYNTHETIC_SOURCE
from wattline.streaming import alerts

NOW = datetime(2024, 3, 1, 12, 0)
SCHEMA = (
    "event_id string, region string, timestamp timestamp, demand_mw double, "
    "generation_mw double, carbon_intensity_gco2_kwh double, source string"
)


def event(n, seconds_ago, demand=40_000.0, region="ERCOT", ci=200.0, source=SYNTHETIC_SOURCE):
    at = NOW - timedelta(seconds=seconds_ago)
    return (f"e{n:03d}", region, at, demand, demand + 500, ci, source)


def reading(n, seconds_ago, ci):
    return event(n, seconds_ago, 0.0, "GB", float(ci), CARBON_SOURCE)


@pytest.fixture
def make(spark):
    return lambda *events: spark.createDataFrame(list(events), SCHEMA)


def test_counts_cover_the_last_hour_strictly(make, rows):
    df = make(event(1, 10), event(2, 3599), event(3, 3600), reading(4, 5, 100))
    assert rows(monitor.event_counts(df, NOW)) == [
        (CARBON_SOURCE, "GB", 1),
        (SYNTHETIC_SOURCE, "ERCOT", 2),
    ]
    assert monitor.total_events(df).first()[0] == 4


def test_latest_events_are_ordered_and_limited(make):
    df = make(*[event(i, i) for i in range(120)], event(200, 0))
    got = monitor.latest_events(df).collect()
    assert len(got) == 100
    times = [r["timestamp"] for r in got]
    assert times == sorted(times, reverse=True)


def test_freshness_covers_all_time(make):
    df = make(event(1, 30), event(2, 9000), event(3, 7200, region="CAISO"))
    got = [tuple(r)[:2] + (r["staleness_seconds"], r["event_count"]) for r in monitor.freshness(df, NOW).collect()]
    assert got == [("CAISO", SYNTHETIC_SOURCE, 7200, 1), ("ERCOT", SYNTHETIC_SOURCE, 30, 2)]


def test_live_demand_bins(make):
    df = make(event(1, 60, 100.0), event(2, 120, 300.0), event(3, 400, 500.0), reading(4, 60, 90))
    got = monitor.live_demand(df, NOW).collect()
    assert [(r["timestamp"].minute, r["avg_demand_mw"], r["max_demand_mw"], r["min_demand_mw"]) for r in got] == [
        (55, 200.0, 300.0, 100.0),
        (50, 500.0, 500.0, 500.0),
    ]


def test_balance(make):
    got = monitor.generation_balance(make(event(1, 60), event(2, 90)), NOW).collect()
    assert [r["balance_mw"] for r in got] == [500.0]


def test_hourly_demand_of_one_region(make):
    df = make(event(1, 60, 10.0), event(2, 3660, 20.0), event(3, 60, 99.0, region="MISO"))
    got = monitor.demand_hourly(df, NOW).collect()
    assert [(r["timestamp"].hour, r["avg_demand_mw"]) for r in got] == [(10, 20.0), (11, 10.0)]


def test_overlay_keeps_bins_without_demand_but_not_bins_without_intensity(make):
    df = make(reading(1, 600, 100.0), event(2, 600, 10.0), reading(3, 2400, 120.0), event(4, 3000, 7.0, region="MISO"))
    got = [tuple(r) for r in monitor.intensity_demand_overlay(df, NOW).collect()]
    assert [(t.minute, ci, d) for t, ci, d in got] == [(0, 120.0, None), (30, 100.0, 10.0)]
    only_demand = make(event(1, 60, 10.0))
    assert monitor.intensity_demand_overlay(only_demand, NOW).count() == 0


def test_low_carbon_windows(make):
    df = make(reading(1, 600, 149.0), reading(2, 2400, 150.0))
    got = monitor.low_carbon_windows(df, NOW).collect()
    assert [(r["avg_ci"], r["label"]) for r in got] == [(149.0, "low-carbon window")]


def test_alerts_fire_beyond_their_limits_only(make):
    calm = make(event(1, 10, 60_000.0), reading(2, 10, 250.0))
    assert monitor.alert_demand_spike(calm, NOW).count() == 0
    assert monitor.alert_high_intensity(calm, NOW).count() == 0
    assert monitor.alert_silence(calm, NOW).count() == 0
    stormy = make(event(1, 100, 60_001.0), reading(2, 100, 250.5))
    assert monitor.alert_demand_spike(stormy, NOW).first()["alert"] == "ERCOT demand spike"
    assert monitor.alert_high_intensity(stormy, NOW).first()["avg_ci"] == 250.5
    assert monitor.alert_silence(stormy, NOW).first()["last_event"] == NOW - timedelta(seconds=100)


def test_alerts_over_no_events(make):
    empty = make()
    for alert in (monitor.alert_demand_spike, monitor.alert_high_intensity, monitor.alert_silence):
        assert alert(empty, NOW).count() == 0
    assert monitor.alert_silence(empty, NOW, alert_when_empty=True).count() == 1
    assert monitor.five_minute_rollup(empty).count() == 0
    assert monitor.zscore_outliers(empty, NOW).count() == 0


def test_tiles_read_the_rollup(make):
    rollup = monitor.five_minute_rollup(
        make(event(1, 60, 10.0), event(2, 70, 30.0), reading(3, 60, 90.0), event(4, 8 * 3600, 5.0))
    )
    assert monitor.tile_recent(rollup, NOW).count() == 2
    assert [r["max_demand_mw"] for r in monitor.tile_max_demand(rollup, NOW).collect()] == [5.0, 30.0]
    assert [r[1] for r in monitor.tile_intensity_trend(rollup, NOW).collect()] == [90.0]


def test_outliers_score_the_last_hour_against_the_last_day(make):
    steady = [event(i, 7200 + i, 100.0 + i % 3) for i in range(60)]
    df = make(*steady, event(900, 60, 130.0), event(901, 60, 101.0), event(902, 5000, 140.0))
    got = monitor.zscore_outliers(df, NOW).collect()
    assert [r["demand_mw"] for r in got] == [130.0]


def test_single_event_has_no_score(make):
    assert monitor.zscore_outliers(make(event(1, 60)), NOW, k=0).count() == 0


def test_outlier_join_without_broadcast(spark, make, rows):
    df = make(*[event(i, 60 + i, float(i % 7), region=f"R{i % 5}") for i in range(200)])
    small = rows(monitor.zscore_outliers(df, NOW, k=1))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert rows(monitor.zscore_outliers(df, NOW, k=1)) == small and small
    finally:
        spark.conf.set(key, before)


def test_level_rules(make, rows):
    df = make(
        event(1, 10, 60_000.5),
        event(2, 20, 70_000.0, region="MISO"),
        reading(3, 30, 250.0),
        reading(4, 40, 312.4),
    )
    assert rows(alerts.level_alerts(df), "event_id", "subject") == [
        ("e001", "ALERT: ERCOT demand spike — 60000 MW"),
        ("e004", "ALERT: GB carbon intensity high — 312 gCO₂/kWh"),
    ]


def test_edge_rules_fire_on_the_way_up(make, rows):
    values = [70_000.0, 60_000.0, 60_001.0, 65_000.0, 50_000.0, 61_000.0]
    df = make(*[event(i, 100 - i, v) for i, v in enumerate(values)])
    assert rows(alerts.edge_alerts(df), "event_id") == [("e002",), ("e005",)]


def test_retention_keeps_the_boundary(make):
    day = 86_400
    df = make(event(1, 90 * day), event(2, 90 * day + 1), event(3, 0))
    kept = {r["event_id"] for r in apply_retention(df, "timestamp", NOW).collect()}
    assert kept == {"e001", "e003"}
