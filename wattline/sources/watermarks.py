"""How far each feed has been loaded.

The state is an append-only table with one row per advance, partitioned by
feed. An append commits as a whole, so a crash leaves the previous mark intact.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions.time import Moment, as_datetime, instant, stamp
from wattline.operators import storage


def read_watermark(spark: SparkSession, path: str, source: str) -> str | None:
    """Newest mark of a feed; ``None`` on a cold start."""
    if not storage.exists(spark, path):
        return None
    marks = spark.read.schema(schemas.WATERMARKS).parquet(path)
    newest = F.max_by("watermark", F.struct("updated_at", "watermark"))
    return marks.filter(F.col("source") == source).agg(newest).first()[0]


def write_watermark(
    spark: SparkSession, path: str, source: str, value: str, as_of: Moment
) -> None:
    mark = spark.range(1).select(
        F.lit(source).alias("source"),
        F.lit(value).alias("watermark"),
        stamp(as_of).alias("updated_at"),
    )
    mark.coalesce(1).write.mode("append").partitionBy("source").parquet(path)


def high_watermark(column: str | Column, limit: str | None = None) -> Column:
    """Greatest value of a sortable text column, optionally held at ``limit``.

    NULL over no rows, in which case the caller leaves the mark where it is.
    """
    mark = F.max(column)
    if limit is not None:
        mark = F.when(mark.isNotNull(), F.least(mark, F.lit(limit)))
    return mark


@dataclass(frozen=True)
class Feed:
    """How a feed's next range is derived.

    ``lag`` is subtracted from now to get the end (negative: into the future);
    ``pattern`` is the text form of the feed's times; with ``whole_days`` both
    ends cover their full day.
    """

    name: str
    pattern: str
    lookback: timedelta
    lag: timedelta = timedelta(0)
    whole_days: bool = False


# First-run lookback and publication lag of the feeds.
EIA = Feed("eia", "%Y-%m-%dT%H", timedelta(hours=48), lag=timedelta(hours=1))
CARBON = Feed("carbon_intensity", "%Y-%m-%dT%H:%MZ", timedelta(hours=48))
WEATHER = Feed(
    "weather", "%Y-%m-%dT%H:%M", timedelta(days=3), lag=timedelta(days=-1), whole_days=True
)


def next_range(
    feed: Feed, watermark: str | None, as_of: Moment
) -> tuple[datetime, datetime] | None:
    """Inclusive bounds of the next load, or ``None`` when already current."""
    now = as_datetime(as_of)
    start = datetime.strptime(watermark, feed.pattern) if watermark else now - feed.lookback
    end = now - feed.lag
    # Ends are stated at the feed's own precision.
    start, end = (datetime.strptime(t.strftime(feed.pattern), feed.pattern) for t in (start, end))
    if feed.whole_days:
        start = start.replace(hour=0, minute=0)
        end = end.replace(hour=23, minute=59)
    return (start, end) if start < end else None


def in_next_range(ts: Column, feed: Feed, watermark: str | None, as_of: Moment) -> Column:
    bounds = next_range(feed, watermark, as_of)
    if bounds is None:
        return F.lit(False)
    return ts.between(instant(bounds[0]), instant(bounds[1]))


def incremental_slice(
    df: DataFrame, ts: Column, feed: Feed, watermark: str | None, as_of: Moment
) -> DataFrame:
    """Rows of the next load. The boundary period is read again on purpose;
    silver absorbs the overlap."""
    return df.filter(in_next_range(ts, feed, watermark, as_of))
