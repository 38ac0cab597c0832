"""Age-based removal."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.time import Moment, instant, width
from wattline.operators import storage

KEEP = "90 days"

#: Partition column of stored event tables.
DAY = "event_date"


def apply_retention(df: DataFrame, ts: str, as_of: Moment, keep: str = KEEP) -> DataFrame:
    """Rows that are young enough; a stored table's older days are not opened."""
    kept = df.filter(F.col(ts) >= instant(as_of) - width(keep))
    if DAY in df.columns:
        kept = kept.filter(F.col(DAY) >= F.to_date(instant(as_of) - width(keep)))
    return kept


def drop_expired_days(spark: SparkSession, path: str, as_of: Moment, keep: str = KEEP) -> list[str]:
    """Remove the day folders of a stored table that end before the boundary; returns them.

    Costs one listing of the days and one removal for each that goes. The day of
    the boundary stays whole, ``apply_retention`` cuts it to the instant.
    """
    boundary = spark.range(1).select(F.to_date(instant(as_of) - width(keep))).first()[0]
    gone = []
    for name in storage.children(spark, path):
        value = name.removeprefix(f"{DAY}=")
        if value != name and value[:1].isdigit() and date.fromisoformat(value) < boundary:
            storage.remove(spark, f"{path}/{name}")
            gone.append(value)
    spark.catalog.refreshByPath(path)
    return sorted(gone)
