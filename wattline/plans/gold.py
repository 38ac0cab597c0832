"""Gold: staging projections, dimensions and facts of the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.functions.keys import iso_text, surrogate_key
from wattline.functions.measures import emissions_tonnes, intensity_band, is_low_carbon
from wattline.functions.time import Moment, as_datetime, date_key, instant, stamp, sunday_week
from wattline.operators import versions
from wattline.operators.ordered import with_running_total
from wattline.operators.upsert import merge_table, read_merged, upsert

# ---- staging --------------------------------------------------------------


def stage_demand(silver: DataFrame) -> DataFrame:
    return silver.select(
        surrogate_key(iso_text("period_utc"), F.col("respondent")).alias("demand_key"),
        "period_utc",
        F.to_date("period_utc").alias("period_date"),
        F.hour("period_utc").alias("period_hour"),
        "respondent",
        "respondent_name",
        "demand_mwh",
        "demand_mw",
        "_cleansed_at",
    )


def stage_generation(silver: DataFrame) -> DataFrame:
    return silver.select(
        surrogate_key(iso_text("period_utc"), F.col("respondent"), F.col("fuel_type")).alias(
            "generation_key"
        ),
        "period_utc",
        F.to_date("period_utc").alias("period_date"),
        F.hour("period_utc").alias("period_hour"),
        "respondent",
        "fuel_type",
        "fuel_type_label",
        "generation_mwh",
        "_cleansed_at",
    )


def stage_carbon(silver: DataFrame) -> DataFrame:
    return silver.select(
        surrogate_key(iso_text("period_from"), iso_text("period_to")).alias(
            "carbon_intensity_key"
        ),
        "period_from",
        "period_to",
        F.to_date("period_from").alias("period_date"),
        "intensity_gco2_kwh",
        "intensity_index",
        F.col("is_estimated").cast("boolean").alias("is_estimated"),
        F.col("duration_minutes").cast("int").alias("duration_minutes"),
        "_cleansed_at",
    )


# ---- dimensions -----------------------------------------------------------

DEFAULT_START = "2023-01-01"
DAYS_AHEAD = 365

# Code, name, country, time zone, grid type.
REGIONS = (
    ("ERCO", "Electric Reliability Council of Texas", "United States", "America/Chicago", "RTO"),
    ("GB", "Great Britain National Grid", "United Kingdom", "Europe/London", "TSO"),
    ("CAISO", "California Independent System Operator", "United States", "America/Los_Angeles", "ISO"),
    ("MISO", "Midcontinent Independent System Operator", "United States", "America/Chicago", "RTO"),
    ("PJM", "PJM Interconnection", "United States", "America/New_York", "RTO"),
    ("NYISO", "New York Independent System Operator", "United States", "America/New_York", "ISO"),
    ("ISONE", "ISO New England", "United States", "America/New_York", "ISO"),
    ("SPP", "Southwest Power Pool", "United States", "America/Chicago", "RTO"),
    ("SWPP", "Southwest Power Pool (alt)", "United States", "America/Chicago", "RTO"),
)

# Code, label, category, renewable, low-carbon, gCO2 per kWh.
FUELS = (
    ("COL", "Coal", "Thermal", False, False, 820.0),
    ("NG", "Natural Gas", "Thermal", False, False, 490.0),
    ("OIL", "Oil", "Thermal", False, False, 650.0),
    ("NUC", "Nuclear", "Low-Carbon", False, True, 12.0),
    ("WAT", "Hydro", "Renewable", True, True, 4.0),
    ("WND", "Wind", "Renewable", True, True, 11.0),
    ("SUN", "Solar", "Renewable", True, True, 45.0),
    ("GEO", "Geothermal", "Renewable", True, True, 38.0),
    ("BIO", "Biomass", "Renewable", True, False, 230.0),
    ("OTH", "Other", "Other", False, False, 0.0),
    ("UNK", "Unknown", "Unknown", False, False, 0.0),
)


def _seed(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Inline rows, folded into the plan as one literal. The optimizer sees how
    small they are and broadcasts them by its own threshold, without a hint."""
    cells = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def _numbered(df: DataFrame, key: str, code: str) -> DataFrame:
    """Dense numbers in code order; for seed tables of a few rows only."""
    return df.select(F.row_number().over(Window.orderBy(code)).alias(key), *df.columns)


def dim_region(spark: SparkSession) -> DataFrame:
    columns = ("respondent_code", "region_name", "country", "timezone_name", "grid_type")
    return _numbered(_seed(spark, REGIONS, columns), "region_key", "respondent_code")


def dim_fuel_type(spark: SparkSession) -> DataFrame:
    columns = (
        "fuel_type_code",
        "fuel_type_label",
        "fuel_category",
        "is_renewable",
        "is_low_carbon",
        "typical_co2_gco2_kwh",
    )
    return _numbered(_seed(spark, FUELS, columns), "fuel_type_key", "fuel_type_code")


def calendar(days: DataFrame, as_of: Moment) -> DataFrame:
    """Calendar attributes of the dates in column ``date_day``."""
    day = F.col("date_day")
    weekday = F.dayofweek(day)
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        F.quarter(day).alias("quarter"),
        sunday_week(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        weekday.isin(1, 7).alias("is_weekend"),
        (day == F.lit(as_datetime(as_of).date().isoformat()).cast("date")).alias("is_today"),
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every day from ``first_day`` to ``last_day`` of a one-row frame."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_day"))


def dim_date(
    spark: SparkSession, as_of: Moment, start: str | date = DEFAULT_START
) -> DataFrame:
    """From ``start`` through a year beyond ``as_of``."""
    today = F.lit(as_datetime(as_of).date().isoformat()).cast("date")
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("first_day"),
        F.date_add(today, DAYS_AHEAD).alias("last_day"),
    )
    return calendar(date_spine(bounds), as_of)


def extend_regions(regions: DataFrame, observed: DataFrame, code: str) -> DataFrame:
    """Add codes seen in the data but missing from the dimension.

    New members are numbered after the existing ones, in code order. The
    numbering is distributed: what counts as a code is up to the data.
    """
    codes = observed.select(F.col(code).alias("respondent_code")).filter(
        F.col("respondent_code").isNotNull()
    ).distinct()
    new = codes.join(regions.select("respondent_code"), "respondent_code", "left_anti")
    numbered = with_running_total(new, [], ["respondent_code"], F.lit(1), "_n")
    highest = regions.agg(F.coalesce(F.max("region_key"), F.lit(0))).scalar()
    unknown = F.lit("Unknown")
    added = numbered.select(
        (highest + F.col("_n")).cast("int").alias("region_key"),
        "respondent_code",
        unknown.alias("region_name"),
        unknown.alias("country"),
        F.lit("UTC").alias("timezone_name"),
        unknown.alias("grid_type"),
    )
    return regions.unionByName(added)


# ---- facts ----------------------------------------------------------------


def _with_date(staged: DataFrame, dates: DataFrame) -> DataFrame:
    days = dates.select(F.col("date_day").alias("period_date"), "date_key")
    return staged.join(days, "period_date", "left")


def _with_region(staged: DataFrame, regions: DataFrame) -> DataFrame:
    members = regions.select(F.col("respondent_code").alias("respondent"), "region_key")
    return staged.join(members, "respondent", "left")


def fact_demand(
    staged: DataFrame, dates: DataFrame, regions: DataFrame, as_of: Moment
) -> DataFrame:
    return _with_region(_with_date(staged, dates), regions).select(
        "demand_key",
        "date_key",
        "region_key",
        "period_utc",
        "period_hour",
        "respondent",
        "demand_mwh",
        "demand_mw",
        stamp(as_of).alias("_loaded_at"),
    )


def fact_generation(
    staged: DataFrame, dates: DataFrame, regions: DataFrame, fuels: DataFrame, as_of: Moment
) -> DataFrame:
    traits = fuels.select(
        F.col("fuel_type_code").alias("fuel_type"),
        "fuel_type_key",
        "is_renewable",
        "typical_co2_gco2_kwh",
    )
    joined = _with_region(_with_date(staged, dates), regions).join(traits, "fuel_type", "left")
    return joined.select(
        "generation_key",
        "date_key",
        "region_key",
        "fuel_type_key",
        "period_utc",
        "period_hour",
        "respondent",
        "fuel_type",
        "fuel_type_label",
        "generation_mwh",
        emissions_tonnes("generation_mwh", "typical_co2_gco2_kwh").alias("estimated_co2_tonnes"),
        F.coalesce("is_renewable", F.lit(False)).alias("is_renewable"),
        stamp(as_of).alias("_loaded_at"),
    )


def fact_carbon_intensity(staged: DataFrame, dates: DataFrame, as_of: Moment) -> DataFrame:
    return _with_date(staged, dates).select(
        "carbon_intensity_key",
        "date_key",
        "period_from",
        "period_to",
        "period_date",
        F.hour("period_from").alias("period_hour"),
        "intensity_gco2_kwh",
        "intensity_index",
        "is_estimated",
        "duration_minutes",
        intensity_band("intensity_gco2_kwh").alias("intensity_band"),
        is_low_carbon("intensity_gco2_kwh").alias("is_low_carbon_window"),
        stamp(as_of).alias("_loaded_at"),
    )


def fact_weather(silver: DataFrame, dates: DataFrame, as_of: Moment) -> DataFrame:
    staged = silver.withColumn("period_date", F.to_date("period_utc"))
    return _with_date(staged, dates).select(
        "date_key",
        "period_utc",
        F.hour("period_utc").alias("period_hour"),
        "temperature_c",
        "wind_speed",
        "precipitation_mm",
        "weather_code",
        stamp(as_of).alias("_loaded_at"),
    )


# ---- incremental facts ----------------------------------------------------

BEGINNING = "1900-01-01"


def not_yet_loaded(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged rows cleansed after the newest load of the fact table."""
    newest = fact.agg(
        F.coalesce(F.max("_loaded_at"), instant(BEGINNING).cast("timestamp"))
    ).scalar()
    return staged.filter(F.col("_cleansed_at") > newest)


def incremental_fact(fact: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Fact table after merging freshly built fact rows by their key."""
    return upsert(fact, fresh, [key])


# ---- stored facts -------------------------------------------------------------

# A fact's key, and the time whose month its files are laid out by.
FACT_KEYS = {
    "fact_demand": ("demand_key", "period_utc"),
    "fact_generation": ("generation_key", "period_utc"),
    "fact_carbon_intensity": ("carbon_intensity_key", "period_from"),
    "fact_weather": ("period_utc", "period_utc"),
}
LAYOUT = "period_month"


SILVER = "silver"


def loaded_upto(spark: SparkSession, path: str) -> int:
    """Number of the last silver load that the stored fact holds."""
    return versions.pointer(spark, path).consumed.get(SILVER, 0)


def merge_fact(
    spark: SparkSession, name: str, fresh: DataFrame, path: str, upto: int | None = None
) -> None:
    """Merge freshly built rows into the stored fact, month by month.

    ``upto`` is the silver load they reach; the mark moves with the rows or not at all.
    """
    key, time = FACT_KEYS[name]
    rows = fresh.withColumn(LAYOUT, F.date_format(time, "yyyyMM").cast("int"))
    consumed = None if upto is None else {SILVER: upto}
    merge_table(spark, path, rows, [key], LAYOUT, stamps=("_loaded_at",), consumed=consumed)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return read_merged(spark, path).drop(LAYOUT)
