from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline.plans import gold, insights

DAY = datetime(2024, 3, 1)


def demand(spark, *rows):
    return spark.createDataFrame(
        list(rows), "respondent string, period_utc timestamp, demand_mwh double"
    ).withColumn("period_hour", F.hour("period_utc"))


def hour(h):
    return DAY + timedelta(hours=h)


def test_shares_of_an_hour_add_up(spark, rows):
    generation = spark.createDataFrame(
        [(hour(0), 5, 30.0), (hour(0), 8, 10.0), (hour(0), None, 10.0), (hour(1), 5, 0.0)],
        "period_utc timestamp, fuel_type_key int, generation_mwh double",
    )
    out = insights.fuel_share(generation, gold.dim_fuel_type(spark))
    share = {(r["period_utc"].hour, r["fuel_category"]): r["share"] for r in out.collect()}
    by_key = {r["fuel_type_key"]: r["fuel_category"] for r in gold.dim_fuel_type(spark).collect()}
    assert share[(0, by_key[5])] == pytest.approx(0.6)
    assert share[(0, "Unknown")] == pytest.approx(0.2)
    assert share[(1, by_key[5])] is None


def test_peak_hour_is_the_earliest_of_equals(spark, rows):
    df = demand(spark, ("A", hour(3), 9.0), ("A", hour(1), 9.0), ("A", hour(2), 5.0), ("A", hour(30), 1.0))
    got = insights.peak_hours(df).orderBy("period_utc").collect()
    assert [(r["period_utc"], r["demand_mwh"]) for r in got] == [(hour(1), 9.0), (hour(30), 1.0)]


def test_low_carbon_runs_break_at_gaps_and_high_slots(spark):
    flags = [1, 1, 0, 1, None, 1, 1, 1]  # None: the slot is missing
    slots = []
    for i, flag in enumerate(flags):
        if flag is not None:
            start = DAY + timedelta(minutes=30 * i)
            slots.append((start, start + timedelta(minutes=30), 100.0 + i, bool(flag)))
    df = spark.createDataFrame(
        slots,
        "period_from timestamp, period_to timestamp, intensity_gco2_kwh double, is_low_carbon_window boolean",
    )
    got = insights.low_carbon_runs(df).orderBy("window_start").collect()
    assert [(r["window_start"], r["slots"], r["min_intensity"]) for r in got] == [
        (DAY, 2, 100.0),
        (DAY + timedelta(minutes=90), 1, 103.0),
        (DAY + timedelta(minutes=150), 3, 105.0),
    ]
    assert got[2]["window_end"] == DAY + timedelta(minutes=240)


def test_lags_follow_the_clock_not_the_row_order(spark, rows):
    df = demand(spark, ("A", hour(0), 1.0), ("A", hour(24), 2.0), ("A", hour(49), 3.0), ("B", hour(48), 9.0))
    out = insights.forecast_features(df, lags=(24,))
    assert rows(out, "respondent", "demand_mwh", "lag_24h") == [
        ("A", 1.0, None), ("A", 2.0, 1.0), ("A", 3.0, None), ("B", 9.0, None),
    ]


def test_forecast_learns_a_linear_pattern(spark):
    rows = []
    for h in range(24 * 12):
        yesterday = rows[h - 24][2] if h >= 24 else 100.0 + 5 * (h % 24)
        rows.append(("A", hour(h), yesterday * 1.01 if h >= 24 else yesterday))
    got = insights.forecast_demand(demand(spark, *rows), hour(24 * 10 - 1)).collect()
    assert len(got) == 24 * 2
    for r in got:
        assert r["forecast_mwh"] == pytest.approx(r["demand_mwh"], rel=1e-3)


def test_forecast_covers_hours_without_lag_weather_or_history(spark, rows):
    known = [("A", hour(h), 10.0 + h % 3) for h in range(48)]
    later = [("A", hour(60), 1.0), ("A", hour(200), 1.0), ("B", hour(61), 1.0)]
    weather = spark.createDataFrame(
        [(hour(60), None, 1.0, 0.0)],
        "period_utc timestamp, temperature_c double, wind_speed double, precipitation_mm double",
    )
    out = insights.forecast_demand(demand(spark, *known, *later), hour(47), weather)
    assert rows(out, "respondent", "forecast_mwh")[1:] == [("A", 11.0), ("B", 11.0)]
    assert out.count() == 3


def test_forecast_error(spark):
    df = spark.createDataFrame(
        [(hour(0), 100.0, 90.0), (hour(24), 100.0, 130.0), (hour(0), None, 1.0)],
        "period_from timestamp, intensity_actual double, intensity_forecast double",
    )
    row = insights.forecast_error(df).first()
    assert (row["bias"], row["mean_abs_error"], row["max_abs_error"], row["slots"]) == (-10.0, 20.0, 30.0, 2)


def test_weather_bins_skip_missing_temperatures(spark, rows):
    weather = spark.createDataFrame(
        [(hour(0), -0.5, 1.0, 0.0), (hour(1), 4.9, 1.0, 0.0), (hour(2), None, 1.0, 0.0)],
        "period_utc timestamp, temperature_c double, wind_speed double, precipitation_mm double",
    )
    df = demand(spark, ("A", hour(0), 1.0), ("B", hour(0), 2.0), ("A", hour(1), 5.0), ("A", hour(2), 7.0))
    assert rows(insights.demand_by_temperature(df, weather)) == [(-5, 3.0, 1), (0, 5.0, 1)]
