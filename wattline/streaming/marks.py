"""Filters that leave the watermark to all events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EARLIEST = "0001-01-01 00:00:00Z"


def behind_watermark(ts: str, condition: Column) -> Column:
    """``condition`` for a filter after ``withWatermark``; rows without a time go.

    The optimizer moves a filter below the watermark unless it reads the event time;
    there it would hide the other events, and a quiet selection would stop the clock.
    """
    return F.col(ts) >= F.when(condition, F.lit(_EARLIEST).cast("timestamp"))
