from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wattline.functions import keys, measures
from wattline.functions import time as t


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def sunday_week_by_hand(day: date) -> int:
    first = date(day.year, 1, 1)
    # Walk back to the Sunday that opens week 1.
    opening = first - timedelta(days=(first.weekday() + 1) % 7)
    return (day - opening).days // 7 + 1


def test_week_number_follows_the_sunday_rule(spark):
    days = spark.sql(
        "select explode(sequence(date'2018-01-01', date'2030-12-31', interval 1 day)) as d"
    )
    for day, week in days.select("d", t.sunday_week("d")).collect():
        assert week == sunday_week_by_hand(day), day


def test_date_key(spark):
    assert one(spark, t.date_key(F.lit("2024-02-09").cast("date"))) == 20240209


def test_surrogate_key_is_stable(spark):
    key = keys.surrogate_key(
        keys.iso_text(F.lit("2024-01-01 00:00:00").cast("timestamp")), F.lit("ERCO")
    )
    assert one(spark, key) == 5451026433119646162


def test_surrogate_key_keeps_the_place_of_a_missing_part(spark):
    a = keys.surrogate_key(F.lit("x"), F.lit(None), F.lit("y"))
    b = keys.surrogate_key(F.lit("x"), F.lit("y"), F.lit(None))
    c = keys.surrogate_key(F.lit("x"), F.lit(""), F.lit("y"))
    assert one(spark, a) != one(spark, b)
    assert one(spark, a) == one(spark, c)
    assert one(spark, a) >= 0


@pytest.mark.parametrize(
    "value, band, low",
    [
        (0.0, "Very Low", True),
        (99.99, "Very Low", True),
        (100.0, "Low", True),
        (149.99, "Low", True),
        (150.0, "Low", False),
        (200.0, "Moderate", False),
        (300.0, "High", False),
        (400.0, "Very High", False),
        (None, "Very High", False),
    ],
)
def test_bands_at_their_limits(spark, value, band, low):
    v = F.lit(value).cast("double")
    assert one(spark, measures.intensity_band(v)) == band
    assert one(spark, measures.is_low_carbon(v)) is low


def test_number_is_lenient_and_drops_nan(spark):
    assert one(spark, measures.number(F.lit("12.5"))) == 12.5
    assert one(spark, measures.number(F.lit("n/a"))) is None
    assert one(spark, measures.number(F.lit("NaN"))) is None
    assert one(spark, measures.number(F.lit(float("nan")))) is None


def test_fuel_label_falls_back_to_the_code(spark):
    assert one(spark, measures.fuel_label(F.lit("NG"))) == "Natural Gas"
    assert one(spark, measures.fuel_label(F.lit("GEO"))) == "GEO"
    assert one(spark, measures.fuel_label(F.lit("???"))) == "???"


def test_emissions(spark):
    assert one(spark, measures.emissions_tonnes(F.lit(1234.5), F.lit(490.0))) == 604.91
    assert one(spark, measures.emissions_tonnes(F.lit(10.0), F.lit(None).cast("double"))) == 0.0


def test_first_nonzero_skips_missing_and_zero(spark):
    def pick(*values):
        return one(spark, measures.first_nonzero(*[F.lit(v).cast("double") for v in values]))

    assert pick(None, 0.0, 5.0) == 5.0
    assert pick(7.0, 5.0) == 7.0
    assert pick(None, 0.0) == 0.0


def test_clamp(spark):
    assert one(spark, measures.at_least_zero(F.lit(-3.0))) == 0.0
    assert one(spark, measures.at_least_zero(F.lit(3.0))) == 3.0


def test_z_score_without_deviation_is_missing(spark):
    assert one(spark, measures.z_score(F.lit(3.0), F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, measures.z_score(F.lit(3.0), F.lit(1.0), F.lit(2.0))) == 1.0


def test_whole_number_text_rounds_ties_to_even(spark):
    assert one(spark, measures.whole_number_text(F.lit(250.5))) == "250"
    assert one(spark, measures.whole_number_text(F.lit(251.5))) == "252"


def test_period_parsing(spark):
    assert one(spark, t.parse_hour(F.lit("2024-01-15T13"))) == datetime(2024, 1, 15, 13)
    assert one(spark, t.parse_hour(F.lit("soon"))) is None
    assert one(spark, t.parse_minute_z(F.lit("2024-01-15T12:30Z"))) == datetime(2024, 1, 15, 12, 30)
    assert one(spark, t.parse_minute(F.lit("2024-01-15T12:30"))) == datetime(2024, 1, 15, 12, 30)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-15T12:30Z", datetime(2024, 1, 15, 12, 30)),
        ("2024-01-15T12:30:45.123456+00:00", datetime(2024, 1, 15, 12, 30, 45, 123456)),
        ("2024-01-15T14:30:45+02:00", datetime(2024, 1, 15, 12, 30, 45)),
        ("soon", None),
    ],
)
def test_event_time_takes_both_shapes(spark, text, expected):
    assert one(spark, t.parse_event_time(F.lit(text))) == expected


def test_moments_are_read_as_utc():
    aware = datetime(2024, 1, 1, 2, tzinfo=timezone(timedelta(hours=2)))
    assert t.as_datetime(aware) == datetime(2024, 1, 1)
    assert t.as_datetime("2024-01-01T00:00:00Z") == datetime(2024, 1, 1)
    assert t.as_datetime(date(2024, 1, 1)) == datetime(2024, 1, 1)


def test_trailing_range_is_strict(spark):
    df = spark.sql(
        "select timestamp'2024-01-01 00:30:00' as ts union all select timestamp'2024-01-01 00:30:01'"
    )
    kept = df.filter(t.newer_than("ts", "30 minutes", "2024-01-01 01:00:00"))
    assert [r[0].second for r in kept.collect()] == [1]
