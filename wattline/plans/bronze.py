"""Bronze: payload files to validated, append-only landed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattline.functions.time import Moment, as_datetime, parse_hour, parse_minute, parse_minute_z
from wattline.operators import contracts
from wattline.operators.contracts import validate
from wattline.operators.dedup import prefer_first
from wattline.sources import deliveries, payloads, watermarks
from wattline.sources.tables import land_bronze
from wattline.sources.watermarks import Feed, high_watermark, in_next_range

_EIA_CONTRACTS = {"demand": contracts.EIA_DEMAND, "generation": contracts.EIA_GENERATION}


def _land(
    spark: SparkSession,
    rows: DataFrame,
    bronze_path: str,
    watermark_path: str,
    mark_name: str,
    mark: Column,
    as_of: Moment,
) -> int:
    """Append the rows and advance the mark, counting during the write itself."""
    seen = Observation()
    observed = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        mark.alias("mark"),
    )
    land_bronze(observed, bronze_path, as_of)
    # Advance only after the rows are safely stored, and only if there were any.
    if seen.get["mark"] is not None:
        watermarks.write_watermark(spark, watermark_path, mark_name, seen.get["mark"], as_of)
    return seen.get["rows"]


def _incremental(
    spark: SparkSession,
    rows: DataFrame,
    feed: Feed,
    mark_name: str,
    parse: Callable,
    time_column: str,
    watermark_path: str,
    as_of: Moment,
) -> DataFrame:
    """Rows of the next load, before validation, so that a bad record of an old
    page does not block later loads. A record without a readable time belongs to
    no range and stays in: without a time the contract rejects it, an unreadable
    one lands as delivered and is dropped when silver is built."""
    mark = watermarks.read_watermark(spark, watermark_path, mark_name)
    time = parse(time_column)
    return rows.filter(in_next_range(time, feed, mark, as_of) | time.isNull())


def _readable(column: str, parse: Callable) -> Column:
    """The column where it holds a time; anything else must not move a mark."""
    return F.when(parse(column).isNotNull(), F.col(column))


def eia(
    spark: SparkSession,
    payload_path: str,
    feed: str,
    bronze_path: str,
    watermark_path: str,
    as_of: Moment,
    page_per_line: bool = False,
) -> int:
    """Load ``demand`` or ``generation``; each feed keeps its own mark.

    Returns the number of rows landed.
    """
    pages = payloads.read_eia(spark, payload_path, feed, page_per_line)
    name = f"eia_{feed}"
    fresh = _incremental(
        spark, pages, watermarks.EIA, name, parse_hour, "period", watermark_path, as_of
    )
    rows = validate(fresh, _EIA_CONTRACTS[feed])
    mark = high_watermark(_readable("period", parse_hour))
    return _land(spark, rows, bronze_path, watermark_path, name, mark, as_of)


def carbon(
    spark: SparkSession,
    payload_path: str,
    bronze_path: str,
    watermark_path: str,
    as_of: Moment,
    page_per_line: bool = False,
) -> int:
    """The mark waits for the oldest slot without a measured value, at most the
    feed's lookback, so that an estimate is replaced when the value arrives."""
    pages = payloads.read_carbon(spark, payload_path, page_per_line=page_per_line)
    name = watermarks.CARBON.name
    fresh = _incremental(
        spark, pages, watermarks.CARBON, name, parse_minute_z, "from", watermark_path, as_of
    )
    rows = validate(fresh, contracts.CARBON)
    now = as_datetime(as_of)
    pattern, lookback = watermarks.CARBON.pattern, watermarks.CARBON.lookback
    waiting = F.min(F.when(F.col("intensity_actual").isNull(), _readable("from", parse_minute_z)))
    newest = F.max(_readable("to", parse_minute_z))
    oldest_wait = F.lit((now - lookback).strftime(pattern))
    held = F.least(newest, F.lit(now.strftime(pattern)), F.greatest(waiting, oldest_wait))
    mark = F.when(newest.isNotNull() & waiting.isNotNull(), held).otherwise(
        high_watermark(_readable("to", parse_minute_z))
    )
    return _land(spark, rows, bronze_path, watermark_path, name, mark, as_of)


def _ranked_weather(archive: DataFrame, forecast: DataFrame) -> DataFrame:
    return archive.withColumn("_preference", F.lit(0)).unionByName(
        forecast.withColumn("_preference", F.lit(1))
    )


def _preferred_weather(both: DataFrame) -> DataFrame:
    rest = [c for c in both.columns if c not in ("time", "_preference")]
    return prefer_first(both, ["time"], "_preference", rest).drop("_preference")


def combine_weather(archive: DataFrame, forecast: DataFrame) -> DataFrame:
    """Observed hours win over forecast hours; within one, payload values decide."""
    return _preferred_weather(_ranked_weather(archive, forecast))


def weather(
    spark: SparkSession,
    archive_path: str,
    forecast_path: str,
    bronze_path: str,
    watermark_path: str,
    as_of: Moment,
    zero_fill: bool = True,
    page_per_line: bool = False,
) -> int:
    """The mark never passes ``as_of``, so forecast hours are read again later."""
    both = combine_weather(
        payloads.read_weather(spark, archive_path, zero_fill, page_per_line),
        payloads.read_weather(spark, forecast_path, zero_fill, page_per_line),
    )
    feed = watermarks.WEATHER
    fresh = _incremental(
        spark, both, feed, feed.name, parse_minute, "time", watermark_path, as_of
    )
    rows = validate(fresh, contracts.WEATHER)
    limit = as_datetime(as_of).strftime(feed.pattern)
    mark = high_watermark(_readable("time", parse_minute), limit)
    return _land(spark, rows, bronze_path, watermark_path, feed.name, mark, as_of)


# ---- loads by delivered file ---------------------------------------------------
# The other form of a load: what is new is decided by file and not by time, so every
# accepted record lands, however old or far ahead, and no page is parsed twice.


def _deliver(
    rows: DataFrame,
    contract: contracts.Contract,
    bronze_path: str,
    ledger: str,
    as_of: Moment,
    rejects_path: str | None = None,
) -> int:
    landed = []

    def land(batch: DataFrame, number: int) -> None:
        if "_preference" in batch.columns:
            batch = _preferred_weather(batch)
        if rejects_path is None:
            good = validate(batch, contract)
        else:
            batch = batch.persist()
            good, bad = validate(batch, contract, mode="split")
            deliveries.land(bad, rejects_path, number, as_of)
        seen = Observation()
        deliveries.land(good.observe(seen, F.count(F.lit(1)).alias("rows")), bronze_path, number, as_of)
        landed.append(seen.get["rows"])
        batch.unpersist()

    deliveries.take_new(rows, ledger, land)
    return sum(landed)


def deliver(
    spark: SparkSession,
    payload_path: str,
    feed: str,
    bronze_path: str,
    ledger: str,
    as_of: Moment,
    page_per_line: bool = False,
    rejects_path: str | None = None,
) -> int:
    """Land the files of ``demand``, ``generation`` or ``carbon`` that are new; returns their rows.

    A record against the contract halts the run, and the files stay untaken until it is
    mended; with ``rejects_path`` such records land there with their reason instead.
    """
    pages = deliveries.stream_pages(spark, payload_path, feed, page_per_line)
    rows = payloads.unwrap_carbon(pages) if feed == "carbon" else payloads.unwrap_eia(pages)
    contract = contracts.CARBON if feed == "carbon" else _EIA_CONTRACTS[feed]
    return _deliver(rows, contract, bronze_path, ledger, as_of, rejects_path)


def deliver_weather(
    spark: SparkSession,
    archive_path: str,
    forecast_path: str,
    bronze_path: str,
    ledger: str,
    as_of: Moment,
    zero_fill: bool = True,
    page_per_line: bool = False,
    rejects_path: str | None = None,
) -> int:
    """Both weather folders under one ledger; within a delivery observed hours win."""
    both = _ranked_weather(
        *[
            payloads.unwrap_weather(
                deliveries.stream_pages(spark, path, "weather", page_per_line), zero_fill
            )
            for path in (archive_path, forecast_path)
        ]
    )
    return _deliver(both, contracts.WEATHER, bronze_path, ledger, as_of, rejects_path)
