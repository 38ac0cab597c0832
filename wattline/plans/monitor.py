"""Monitoring queries over grid events.

Defaults are the operating values of the live system; ``as_of`` is the moment a
query is asked. Time ranges are strict and open-ended ("newer than ``span``
ago"). Averages are plain bins or one trailing range, never moving frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.measures import LOW_CARBON_LIMIT, z_score
from wattline.functions.time import Moment, instant, newer_than, seconds_between, time_bin, width
from wattline.operators.joins import join_fixed
from wattline.operators.retention import DAY
from wattline.sources.events import CARBON_SOURCE, SYNTHETIC_SOURCE

ERCOT = "ERCOT"
DEMAND_LIMIT = 60_000
INTENSITY_LIMIT = 250
SILENCE_SECONDS = 90

_INTENSITY = "carbon_intensity_gco2_kwh"


def _synthetic() -> Column:
    return F.col("source") == SYNTHETIC_SOURCE


def _carbon() -> Column:
    return F.col("source") == CARBON_SOURCE


def _recent(events: DataFrame, span: str, as_of: Moment, *conditions: Column) -> DataFrame:
    """A stored table's day column, if there, keeps older days from being opened."""
    df = events.filter(newer_than("timestamp", span, as_of))
    if DAY in events.columns:
        df = df.filter(F.col(DAY) >= F.to_date(instant(as_of) - width(span)))
    for condition in conditions:
        df = df.filter(condition)
    return df


# ---- sanity ---------------------------------------------------------------


def total_events(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("event_count"))


def latest_events(events: DataFrame, n: int = 100) -> DataFrame:
    """Newest events; the id decides between equal times."""
    return (
        events.orderBy(F.desc("timestamp"), F.desc("event_id"))
        .limit(n)
        .select("timestamp", "region", "source", "demand_mw", _INTENSITY)
    )


def event_counts(events: DataFrame, as_of: Moment, span: str = "1 hour") -> DataFrame:
    return (
        _recent(events, span, as_of)
        .groupBy("source", "region")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def freshness(events: DataFrame, as_of: Moment) -> DataFrame:
    grouped = events.groupBy("region", "source").agg(
        F.max("timestamp").alias("last_event"), F.count(F.lit(1)).alias("event_count")
    )
    age = seconds_between(instant(as_of), F.col("last_event"))
    return grouped.select(
        "region", "source", "last_event", age.alias("staleness_seconds"), "event_count"
    ).orderBy(F.desc("staleness_seconds"), "region", "source")


# ---- demand ---------------------------------------------------------------


def live_demand(
    events: DataFrame, as_of: Moment, span: str = "30 minutes", bin_width: str = "5 minutes"
) -> DataFrame:
    return (
        _recent(events, span, as_of, _synthetic())
        .groupBy("region", time_bin("timestamp", bin_width).alias("timestamp"))
        .agg(
            F.avg("demand_mw").alias("avg_demand_mw"),
            F.max("demand_mw").alias("max_demand_mw"),
            F.min("demand_mw").alias("min_demand_mw"),
        )
        .orderBy(F.desc("timestamp"), "region")
    )


def generation_balance(
    events: DataFrame, as_of: Moment, span: str = "1 hour", bin_width: str = "5 minutes"
) -> DataFrame:
    binned = (
        _recent(events, span, as_of, _synthetic())
        .groupBy("region", time_bin("timestamp", bin_width).alias("timestamp"))
        .agg(
            F.avg("demand_mw").alias("avg_demand"),
            F.avg("generation_mw").alias("avg_generation"),
        )
    )
    return binned.select(
        "timestamp",
        "region",
        "avg_demand",
        "avg_generation",
        (F.col("avg_generation") - F.col("avg_demand")).alias("balance_mw"),
    ).orderBy("timestamp", "region")


def demand_hourly(
    events: DataFrame,
    as_of: Moment,
    span: str = "24 hours",
    bin_width: str = "1 hour",
    region: str = ERCOT,
) -> DataFrame:
    return (
        _recent(events, span, as_of, _synthetic(), F.col("region") == region)
        .groupBy(time_bin("timestamp", bin_width).alias("timestamp"))
        .agg(F.avg("demand_mw").alias("avg_demand_mw"))
        .orderBy("timestamp")
    )


# ---- carbon intensity -----------------------------------------------------


def intensity_series(events: DataFrame, as_of: Moment, span: str = "2 hours") -> DataFrame:
    """Sorted on the id as well, so that a slot reported many times can spread
    over several sort tasks."""
    return (
        _recent(events, span, as_of, _carbon())
        .orderBy("timestamp", "event_id")
        .select("timestamp", _INTENSITY)
    )


def intensity_demand_overlay(
    events: DataFrame,
    as_of: Moment,
    span: str = "1 hour",
    bin_width: str = "30 minutes",
    region: str = ERCOT,
) -> DataFrame:
    """Every bin with intensity readings, with the region's demand beside it.

    The two series come from one scan: each average skips the other's rows, and
    bins that only hold demand are dropped afterwards, as a left join would.
    """
    is_demand = _synthetic() & (F.col("region") == region)
    return (
        _recent(events, span, as_of, _carbon() | is_demand)
        .groupBy(time_bin("timestamp", bin_width).alias("timestamp"))
        .agg(
            F.avg(F.when(_carbon(), F.col(_INTENSITY))).alias("avg_ci"),
            F.avg(F.when(is_demand, F.col("demand_mw"))).alias("avg_demand"),
            F.count_if(_carbon()).alias("_readings"),
        )
        .filter("_readings > 0")
        .drop("_readings")
        .orderBy("timestamp")
    )


def low_carbon_windows(
    events: DataFrame,
    as_of: Moment,
    span: str = "24 hours",
    bin_width: str = "30 minutes",
    limit: float = LOW_CARBON_LIMIT,
) -> DataFrame:
    return (
        _recent(events, span, as_of, _carbon())
        .groupBy(time_bin("timestamp", bin_width).alias("timestamp"))
        .agg(F.avg(_INTENSITY).alias("avg_ci"))
        .filter(F.col("avg_ci") < limit)
        .withColumn("label", F.lit("low-carbon window"))
        .orderBy("timestamp")
    )


# ---- alert queries: they fire by returning a row ---------------------------


def alert_demand_spike(
    events: DataFrame,
    as_of: Moment,
    span: str = "5 minutes",
    limit: float = DEMAND_LIMIT,
    region: str = ERCOT,
) -> DataFrame:
    return (
        _recent(events, span, as_of, _synthetic(), F.col("region") == region)
        .agg(F.max("demand_mw").alias("max_demand_mw"))
        .filter(F.col("max_demand_mw") > limit)
        .withColumn("alert", F.lit(f"{region} demand spike"))
    )


def alert_high_intensity(
    events: DataFrame, as_of: Moment, span: str = "30 minutes", limit: float = INTENSITY_LIMIT
) -> DataFrame:
    return (
        _recent(events, span, as_of, _carbon())
        .agg(F.avg(_INTENSITY).alias("avg_ci"))
        .filter(F.col("avg_ci") > limit)
        .withColumn("alert", F.lit("GB carbon intensity high"))
    )


def alert_silence(
    events: DataFrame,
    as_of: Moment,
    seconds: int = SILENCE_SECONDS,
    alert_when_empty: bool = False,
) -> DataFrame:
    """A table without any event stays quiet unless ``alert_when_empty``."""
    last = F.col("last_event")
    silent = seconds_between(instant(as_of), last) > seconds
    if alert_when_empty:
        silent = last.isNull() | silent
    return (
        events.agg(F.max("timestamp").alias("last_event"))
        .filter(silent)
        .withColumn("alert", F.lit("producer silence"))
    )


# ---- five-minute rollup and its tiles --------------------------------------

ROLLUP_BIN = "5 minutes"


def base_bins(rollup: DataFrame, span: str, as_of: Moment) -> DataFrame:
    """Synthetic bins that lie in the range whole; a bin that its start cuts is left out."""
    start = instant(as_of) - width(span)
    return rollup.filter((F.col("timestamp") >= start) & _synthetic())


def _rollup_measures() -> list[Column]:
    return [
        F.avg("demand_mw").alias("avg_demand_mw"),
        F.max("demand_mw").alias("max_demand_mw"),
        F.avg(_INTENSITY).alias("avg_carbon_intensity"),
        F.max(_INTENSITY).alias("max_carbon_intensity"),
        F.count(F.lit(1)).alias("event_count"),
    ]


def five_minute_rollup(events: DataFrame) -> DataFrame:
    bin_ = time_bin("timestamp", ROLLUP_BIN).alias("timestamp")
    return events.groupBy("region", "source", bin_).agg(*_rollup_measures())


def windowed_rollup(events: DataFrame) -> DataFrame:
    """The same rows, grouped by the window itself.

    A stream needs that: only a window carries the watermark, by which state is
    dropped and rows that are too late are ignored; its start alone does not.
    """
    window = F.window("timestamp", ROLLUP_BIN).alias("_window")
    rolled = events.groupBy("region", "source", window).agg(*_rollup_measures())
    measures = [c for c in rolled.columns if c not in ("region", "source", "_window")]
    return rolled.select("region", "source", F.col("_window.start").alias("timestamp"), *measures)


def tile_recent(rollup: DataFrame, as_of: Moment, span: str = "6 hours") -> DataFrame:
    return _recent(rollup, span, as_of).orderBy(F.desc("timestamp"), "region", "source")


def tile_max_demand(
    rollup: DataFrame, as_of: Moment, span: str = "24 hours", region: str = ERCOT
) -> DataFrame:
    return (
        _recent(rollup, span, as_of, F.col("region") == region, _synthetic())
        .select("timestamp", "max_demand_mw")
        .orderBy("timestamp")
    )


def tile_intensity_trend(rollup: DataFrame, as_of: Moment, span: str = "24 hours") -> DataFrame:
    return (
        _recent(rollup, span, as_of, _carbon())
        .select("timestamp", "avg_carbon_intensity")
        .orderBy("timestamp")
    )


# ---- anomalies --------------------------------------------------------------


def zscore_outliers(
    events: DataFrame,
    as_of: Moment,
    by: str = "region",
    value: str = "demand_mw",
    base: str = "24 hours",
    recent: str = "1 hour",
    k: float = 2.0,
) -> DataFrame:
    """Recent readings more than ``k`` deviations from the base-range mean.

    Sample deviation; a group of one reading has none and yields no score.
    """
    stats = (
        _recent(events, base, as_of, _synthetic())
        .groupBy(by)
        .agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_deviation"))
    )
    return outliers_against(events, stats, as_of, by, value, recent, k)


def outliers_against(
    events: DataFrame,
    stats: DataFrame,
    as_of: Moment,
    by: str = "region",
    value: str = "demand_mw",
    recent: str = "1 hour",
    k: float = 2.0,
) -> DataFrame:
    """Recent readings against ``_mean`` and ``_deviation`` of each ``by``."""
    readings = _recent(events, recent, as_of, _synthetic()).select(
        "event_id", "timestamp", by, value
    )
    scored = join_fixed(readings, stats, [by]).withColumn(
        "z_score", z_score(value, "_mean", "_deviation")
    )
    return (
        scored.filter(F.abs("z_score") > k)
        .orderBy(F.desc(F.abs("z_score")), "event_id")
        .select("timestamp", by, value, "z_score")
    )
