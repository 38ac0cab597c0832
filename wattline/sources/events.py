"""Grid events: JSON in, JSON out, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions.measures import first_nonzero
from wattline.functions.time import ISO_SECOND_PATTERN, parse_event_time
from wattline.operators.contracts import GRID_EVENT, REASON, inspect

CARBON_SOURCE = "carbonintensity.org.uk"
SYNTHETIC_SOURCE = "synthetic"


BODY = "_body"


def checked_events(lines: DataFrame, text: str = "value") -> DataFrame:
    """Typed events of JSON lines with ``_reason`` (NULL for a good one) and the raw ``_body``.

    A line that is no JSON object, a missing or unreadable time and a measure that
    is no number each have a reason; a number in quotes is a number.

    The one-element generator keeps later filters, such as the one on the reason, above
    the parser: the optimizer would otherwise copy the parse into each use of a field.
    """
    body = F.col(text).cast("string")
    event = F.from_json(body, schemas.GRID_EVENT_JSON)
    parsed = lines.select(body.alias(BODY), F.inline(F.array(F.struct(event.alias("e")))))
    nothing = F.coalesce(*[F.col(f"e.{c}") for c in schemas.GRID_EVENT_COLUMNS]).isNull()
    checked = inspect(parsed.select(BODY, nothing.alias("_nothing"), "e.*"), GRID_EVENT, keep=[BODY, "_nothing"])
    time = parse_event_time("timestamp")
    bad_time = F.when(
        time.isNull() & F.col("timestamp").isNotNull(), F.lit("timestamp: not a valid time")
    )
    reason = F.when(F.col("_nothing"), F.lit("not an event")).otherwise(
        F.nullif(F.concat_ws("; ", F.col(REASON), bad_time), F.lit(""))
    )
    columns = [time.alias(c) if c == "timestamp" else F.col(c) for c in schemas.GRID_EVENT_COLUMNS]
    return checked.select(*columns, BODY, reason.alias(REASON))


def accepted(checked: DataFrame) -> DataFrame:
    """The good events; a frame without reasons is taken as it is."""
    if REASON not in checked.columns:
        return checked
    return checked.where(F.col(REASON).isNull()).drop(REASON, BODY)


def rejected(checked: DataFrame) -> DataFrame:
    """The raw lines that are no events, each with its reason."""
    return checked.where(F.col(REASON).isNotNull()).select(BODY, REASON)


def parse_event_json(df: DataFrame, text: str = "value") -> DataFrame:
    """Good events held as JSON text, as a message bus delivers them."""
    return accepted(checked_events(df, text))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return parse_event_json(spark.read.text(path))


def read_checked_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Good and bad lines; sinks that store rejects take this one."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return checked_events(reader.text(path))


def read_events_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    return accepted(read_checked_stream(spark, path, max_files_per_trigger))


def events_to_json(events: DataFrame) -> DataFrame:
    """One JSON object per event in column ``value``; times as UTC text."""
    time_text = F.concat(F.date_format("timestamp", ISO_SECOND_PATTERN + ".SSSSSS"), F.lit("+00:00"))
    fields = [
        time_text.alias(c) if c == "timestamp" else F.col(c)
        for c in schemas.GRID_EVENT_COLUMNS
    ]
    return events.select(F.to_json(F.struct(*fields)).alias("value"))


def write_events_json(events: DataFrame, path: str, mode: str = "append") -> None:
    events_to_json(events).write.mode(mode).text(path)


def readings_to_events(readings: DataFrame) -> DataFrame:
    """Carbon readings as events of the national grid, timed at the slot start.

    The measured value counts if present and not zero, else the forecast.
    The id is derived from the slot, so a recomputed task emits the same event.
    """
    return readings.select(
        F.md5(F.concat_ws("|", F.lit(CARBON_SOURCE), "from", "to")).alias("event_id"),
        F.lit("GB").alias("region"),
        parse_event_time("from").alias("timestamp"),
        F.lit(0.0).alias("demand_mw"),
        F.lit(0.0).alias("generation_mw"),
        first_nonzero(F.col("intensity_actual"), F.col("intensity_forecast")).alias(
            "carbon_intensity_gco2_kwh"
        ),
        F.lit(CARBON_SOURCE).alias("source"),
    )


def newest_reading(readings: DataFrame) -> DataFrame:
    """The latest slot only, which is what a poll reports."""
    return readings.orderBy(F.desc("from"), F.desc("to")).limit(1)
