"""API payload files to flat rows.

A payload file is one page of an API answer; pages are small by contract, so
files are read whole and the work spreads over files. With ``page_per_line`` a
file holds many pages, one per line, and is split like any text file.
Values come out as text and get their types from the contract.
Each reader is a scan plus an ``unwrap_*`` step that also takes payloads from
anywhere else (a column of JSON text, a message bus).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas

_EIA_ROWS = {
    "demand": schemas.EIA_DEMAND_ROW,
    "generation": schemas.EIA_GENERATION_ROW,
}


# Text that is not JSON halts the load instead of turning into an empty page.
_STRICT = {"mode": "FAILFAST"}


def _read_json(
    spark: SparkSession, path: str, schema: T.StructType, page_per_line: bool
) -> DataFrame:
    reader = spark.read.schema(schema).options(multiLine=not page_per_line, **_STRICT)
    return reader.json(path)


#: Lines of one stored file. A compressed file is read by one task, whatever its size.
PAGES_PER_FILE = 50_000


def write_pages(pages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Page texts, one per line, as compressed files; the readers tell by the file's name.

    Field names make up most of a page, so plain text would be the bulk of what a load
    writes. Files are kept short because they are not split: many go to one task, and
    how many is bounded by Spark's cost of opening a file rather than by their few bytes.
    """
    pages.write.mode(mode).options(compression="gzip", maxRecordsPerFile=PAGES_PER_FILE).text(path)


def page_schema(feed: str) -> T.StructType:
    if feed in _EIA_ROWS:
        return schemas.eia_page(_EIA_ROWS[feed])
    return {"carbon": schemas.CARBON_PAGE, "weather": schemas.WEATHER_PAGE}[feed]


def parse_payload(df: DataFrame, text: str, feed: str) -> DataFrame:
    """Payloads held as JSON text in column ``text``.

    The one-element explode keeps later filters, such as the optimizer's own
    test for empty arrays, above the parser, so that each text is parsed once.
    """
    page = F.from_json(text, page_schema(feed), _STRICT)
    return df.select(F.explode(F.array(page)).alias("page")).select("page.*")


def unwrap_eia(pages: DataFrame) -> DataFrame:
    """One row per record; hyphenated headers are folded into underscored ones.

    The declared total is not consulted: the rows received are the rows.
    """
    rows = pages.select(F.inline("response.data"))
    names = list(dict.fromkeys(c.replace("-", "_") for c in rows.columns))

    def folded(name: str) -> Column:
        spellings = [c for c in rows.columns if c.replace("-", "_") == name]
        return F.coalesce(*[F.col(f"`{c}`") for c in spellings]).alias(name)

    return rows.select(*[folded(n) for n in names])


def read_eia(
    spark: SparkSession, path: str, feed: str, page_per_line: bool = False
) -> DataFrame:
    """``feed`` is ``demand`` or ``generation``."""
    return unwrap_eia(_read_json(spark, path, page_schema(feed), page_per_line))


def unwrap_carbon(pages: DataFrame, forecast_default: str | None = None) -> DataFrame:
    """Flatten half-hour slots.

    A missing forecast stays NULL unless ``forecast_default`` is given, so that
    a slot with neither reading is not mistaken for a clean grid.
    """
    slots = pages.select(F.explode("data").alias("slot"))
    forecast = F.col("slot.intensity.forecast")
    if forecast_default is not None:
        forecast = F.coalesce(forecast, F.lit(forecast_default))
    return slots.select(
        F.col("slot.from").alias("from"),
        F.col("slot.to").alias("to"),
        F.col("slot.intensity.index").alias("intensity_index"),
        F.col("slot.intensity.actual").alias("intensity_actual"),
        forecast.alias("intensity_forecast"),
    )


def read_carbon(
    spark: SparkSession,
    path: str,
    forecast_default: str | None = None,
    page_per_line: bool = False,
) -> DataFrame:
    pages = _read_json(spark, path, page_schema("carbon"), page_per_line)
    return unwrap_carbon(pages, forecast_default)


def unwrap_weather(pages: DataFrame, zero_fill: bool = True) -> DataFrame:
    """Turn parallel arrays into rows, matching them by position.

    Missing measures become 0.0 unless ``zero_fill`` is off; the weather code
    stays missing either way.
    """
    hours = pages.select("hourly", F.posexplode("hourly.time").alias("at", "time"))

    def measure(name: str) -> Column:
        value = F.get(F.col(f"hourly.{name}"), F.col("at"))
        return (F.coalesce(value, F.lit("0.0")) if zero_fill else value).alias(name)

    return hours.select(
        "time",
        measure("temperature_2m"),
        measure("wind_speed_10m"),
        measure("precipitation"),
        F.get(F.col("hourly.weather_code"), F.col("at")).alias("weather_code"),
    )


def read_weather(
    spark: SparkSession, path: str, zero_fill: bool = True, page_per_line: bool = False
) -> DataFrame:
    pages = _read_json(spark, path, page_schema("weather"), page_per_line)
    return unwrap_weather(pages, zero_fill)
