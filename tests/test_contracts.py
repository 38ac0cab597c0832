import pytest

from wattline.operators import contracts
from wattline.operators.contracts import REASON, inspect, validate

SCHEMA = "period string, respondent string, type string, value string"
GOOD = ("2024-03-01T00", "ERCO", "D", "45100")


def test_defaults_and_optional_columns(spark, rows):
    df = validate(spark.createDataFrame([GOOD], SCHEMA), contracts.EIA_DEMAND)
    assert rows(df) == [("2024-03-01T00", "ERCO", None, "D", None, 45100.0, "megawatthours")]


def test_numeric_text_is_accepted_and_other_text_is_not(spark, rows):
    df = spark.createDataFrame([GOOD, (*GOOD[:3], "lots"), (*GOOD[:3], "NaN")], SCHEMA)
    valid, rejected = validate(df, contracts.EIA_DEMAND, mode="split")
    assert valid.count() == 1
    assert rows(rejected, REASON) == [("value: not a valid double",)] * 2


def test_every_problem_is_named(spark, rows):
    df = spark.createDataFrame([(None, "ERCO", None, "x")], SCHEMA)
    assert rows(inspect(df, contracts.EIA_DEMAND), REASON) == [
        ("period: missing; type: missing; value: not a valid double",)
    ]


def test_missing_required_column_rejects_every_row(spark):
    df = spark.createDataFrame([("a", "GB")], "event_id string, region string")
    valid, rejected = validate(df, contracts.GRID_EVENT, mode="split")
    assert (valid.count(), rejected.count()) == (0, 1)


def test_either_name_is_accepted(spark, rows):
    for name in ("fueltype", "fuel_type"):
        df = spark.createDataFrame(
            [("p", "r", "NG", 1.0)], f"period string, respondent string, {name} string, value double"
        )
        assert rows(validate(df, contracts.EIA_GENERATION), "fuel_type") == [("NG",)]


def test_unknown_columns_are_ignored_unless_kept(spark):
    df = spark.createDataFrame([(*GOOD, "extra")], SCHEMA + ", other string")
    assert "other" not in validate(df, contracts.EIA_DEMAND).columns
    assert "other" in validate(df, contracts.EIA_DEMAND, keep=["other"]).columns


def test_whole_numbers(spark, rows):
    schema = "time string, temperature_2m double, wind_speed_10m double, precipitation double, weather_code string"
    base = ("2024-03-01T00:00", 1.0, 2.0, 3.0)
    df = spark.createDataFrame([(*base, "3"), (*base, "3.0"), (*base, "3.5"), (*base, None)], schema)
    valid, rejected = validate(df, contracts.WEATHER, mode="split")
    assert rows(valid, "weather_code") == [(3,), (3,), (None,)]
    assert rejected.count() == 1


def test_fail_mode_halts_the_load_and_leaves_nothing(spark, folder):
    df = spark.createDataFrame([GOOD, (*GOOD[:3], "lots")], SCHEMA)
    path = folder("out")
    with pytest.raises(Exception, match="eia_demand contract violated: value"):
        validate(df, contracts.EIA_DEMAND).write.parquet(path)
    import os

    left = [f for f in os.listdir(path) if f.endswith(".parquet")] if os.path.exists(path) else []
    assert left == []


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        validate(spark.createDataFrame([GOOD], SCHEMA), contracts.EIA_DEMAND, mode="maybe")
