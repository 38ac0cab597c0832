"""Silver: bronze rows parsed, typed, filtered and reduced to one per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.measures import fuel_label, number
from wattline.functions.time import (
    Moment,
    as_datetime,
    minutes_between,
    parse_hour,
    parse_minute,
    parse_minute_z,
    stamp,
)
from wattline.operators import versions
from wattline.operators.dedup import latest_per_key
from wattline.operators.upsert import merge_table, read_merged

DEMAND_KEYS = ("period_utc", "respondent")
GENERATION_KEYS = ("period_utc", "respondent", "fuel_type")
CARBON_KEYS = ("period_from", "period_to")
WEATHER_KEYS = ("period_utc",)

_STAMPS = ("_ingested_at", "_cleansed_at")


def clean_demand(bronze: DataFrame, as_of: Moment) -> DataFrame:
    """Hourly energy equals average power, so the MW column repeats the MWh one."""
    value = number("value")
    return bronze.select(
        parse_hour("period").alias("period_utc"),
        "respondent",
        "respondent_name",
        value.alias("demand_mwh"),
        value.alias("demand_mw"),
        "_ingested_at",
        stamp(as_of).alias("_cleansed_at"),
    ).filter(F.col("period_utc").isNotNull() & F.col("demand_mwh").isNotNull())


def clean_generation(bronze: DataFrame, as_of: Moment) -> DataFrame:
    return bronze.select(
        parse_hour("period").alias("period_utc"),
        "respondent",
        "fuel_type",
        fuel_label("fuel_type").alias("fuel_type_label"),
        number("value").alias("generation_mwh"),
        "_ingested_at",
        stamp(as_of).alias("_cleansed_at"),
    ).filter(F.col("period_utc").isNotNull() & F.col("generation_mwh").isNotNull())


def clean_carbon(bronze: DataFrame, as_of: Moment) -> DataFrame:
    """The measured value counts; without one the forecast does, marked estimated."""
    actual, forecast = number("intensity_actual"), number("intensity_forecast")
    parsed = bronze.select(
        parse_minute_z("from").alias("period_from"),
        parse_minute_z("to").alias("period_to"),
        F.coalesce(actual, forecast).alias("intensity_gco2_kwh"),
        "intensity_index",
        actual.isNull().alias("is_estimated"),
        "_ingested_at",
    ).filter(F.col("period_from").isNotNull() & F.col("intensity_gco2_kwh").isNotNull())
    return parsed.select(
        "period_from",
        "period_to",
        "intensity_gco2_kwh",
        "intensity_index",
        "is_estimated",
        minutes_between("period_to", "period_from").alias("duration_minutes"),
        "_ingested_at",
        stamp(as_of).alias("_cleansed_at"),
    )


def latest_readings(bronze: DataFrame) -> DataFrame:
    """Newest load of each slot with measured and forecast value side by side."""
    parsed = bronze.select(
        parse_minute_z("from").alias("period_from"),
        parse_minute_z("to").alias("period_to"),
        number("intensity_actual").alias("intensity_actual"),
        number("intensity_forecast").alias("intensity_forecast"),
        "_ingested_at",
    ).filter(F.col("period_from").isNotNull())
    return latest_per_key(parsed, CARBON_KEYS)


def clean_weather(bronze: DataFrame, as_of: Moment) -> DataFrame:
    return bronze.select(
        parse_minute("time").alias("period_utc"),
        number("temperature_2m").alias("temperature_c"),
        number("wind_speed_10m").alias("wind_speed"),
        number("precipitation").alias("precipitation_mm"),
        F.col("weather_code").try_cast("int").alias("weather_code"),
        "_ingested_at",
        stamp(as_of).alias("_cleansed_at"),
    ).filter(F.col("period_utc").isNotNull())


@dataclass(frozen=True)
class SilverTable:
    clean: Callable[[DataFrame, Moment], DataFrame]
    keys: Sequence[str]

    @property
    def time(self) -> str:
        return self.keys[0]


TABLES = {
    "demand": SilverTable(clean_demand, DEMAND_KEYS),
    "generation": SilverTable(clean_generation, GENERATION_KEYS),
    "carbon": SilverTable(clean_carbon, CARBON_KEYS),
    "weather": SilverTable(clean_weather, WEATHER_KEYS),
}


def build(table: str, bronze: DataFrame, as_of: Moment) -> DataFrame:
    """Cleansed rows, newest load per natural key."""
    spec = TABLES[table]
    rows = spec.clean(bronze, as_of)
    # Rows of one load differ only in what they carry, so that breaks ties.
    carried = [c for c in rows.columns if c not in {*spec.keys, *_STAMPS}]
    return latest_per_key(rows, spec.keys, tiebreak=carried)


def demand(bronze: DataFrame, as_of: Moment) -> DataFrame:
    return build("demand", bronze, as_of)


def generation(bronze: DataFrame, as_of: Moment) -> DataFrame:
    return build("generation", bronze, as_of)


def carbon(bronze: DataFrame, as_of: Moment) -> DataFrame:
    return build("carbon", bronze, as_of)


def weather(bronze: DataFrame, as_of: Moment) -> DataFrame:
    return build("weather", bronze, as_of)


# The stored layout adds the month of the key's time as partition column, and the
# number of the load that last changed a row.
LAYOUT = "period_month"
LOAD = "_load"


def merge(
    spark: SparkSession,
    table: str,
    bronze: DataFrame,
    path: str,
    as_of: Moment,
    consumed: Mapping[str, int] | None = None,
) -> None:
    """Upsert one batch of bronze rows into the stored table (create if absent).

    A row delivered again unchanged keeps its stamp and its load number. Load numbers
    follow the order of the merges, whatever their ``as_of``.
    """
    spec = TABLES[table]
    rows = build(table, bronze, as_of).withColumn(
        LAYOUT, F.date_format(spec.time, "yyyyMM").cast("int")
    )
    merge_table(
        spark, path, rows, spec.keys, LAYOUT, stamps=("_cleansed_at",), number_as=LOAD, consumed=consumed
    )


def refresh(table: str, bronze: DataFrame, path: str, as_of: Moment) -> None:
    """Explicit full rebuild; drops rows that bronze no longer holds."""
    spec = TABLES[table]
    rows = build(table, bronze, as_of).withColumn(
        LAYOUT, F.date_format(spec.time, "yyyyMM").cast("int")
    )
    merge_table(bronze.sparkSession, path, rows, spec.keys, LAYOUT, number_as=LOAD, replace=True)


def read(
    spark: SparkSession, path: str, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """The stored table; bounds on its time also prune the months outside them."""
    return within_months(read_merged(spark, path), start, end).drop(LAYOUT, LOAD)


def read_loads(spark: SparkSession, path: str, after: int) -> tuple[DataFrame | None, int]:
    """Rows that loads after number ``after`` changed, and the newest load's number.

    Months that no later load has written are not opened. A mark beyond the newest
    load is of another table's making, so everything counts as changed then.
    """
    at = versions.pointer(spark, path)
    if after > at.number:
        after = 0
    rows = versions.read(spark, path, at, since=after)
    if rows is not None:
        rows = rows.where(F.col(LOAD) > after).drop(LAYOUT, LOAD)
    return rows, at.number


def within_months(stored: DataFrame, start: Moment | None, end: Moment | None) -> DataFrame:
    """Rows of the months from ``start`` to ``end``, both inclusive and optional."""
    for bound, later in ((start, True), (end, False)):
        if bound is not None:
            month = F.lit(int(as_datetime(bound).strftime("%Y%m")))
            stored = stored.where(F.col(LAYOUT) >= month if later else F.col(LAYOUT) <= month)
    return stored
