"""Intensity beside demand on a stream, by a join of two windowed averages.

Both sides are averaged per bin under a watermark and joined on the bin. A bin
comes out once, when the watermark has passed its end: with the demand of the
region, or without if there was none. State holds the open bins of both sides
only, one row each, however long the stream runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.plans.monitor import ERCOT
from wattline.sources.events import CARBON_SOURCE, SYNTHETIC_SOURCE
from wattline.streaming.batches import read_store, write_batch
from wattline.streaming.marks import behind_watermark

LATENESS = "10 minutes"

OVERLAY_SCHEMA = "timestamp timestamp, avg_ci double, avg_demand double"


def overlay_stream(
    events: DataFrame, lateness: str = LATENESS, bin_width: str = "30 minutes", region: str = ERCOT
) -> DataFrame:
    """For append output mode. An event later than ``lateness`` counts only while its bin is open.

    Every event moves the watermark, so a region without news holds back no bin.
    """
    marked = events.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", lateness)
    window = F.window("timestamp", bin_width).alias("window")
    is_carbon = F.col("source") == CARBON_SOURCE
    is_demand = (F.col("source") == SYNTHETIC_SOURCE) & (F.col("region") == region)

    def averaged(condition: Column, column: str, name: str) -> DataFrame:
        return marked.filter(behind_watermark("timestamp", condition)).groupBy(window).agg(F.avg(column).alias(name))

    intensity = averaged(is_carbon, "carbon_intensity_gco2_kwh", "avg_ci")
    joined = intensity.join(averaged(is_demand, "demand_mw", "avg_demand"), "window", "left")
    return joined.select(F.col("window.start").alias("timestamp"), "avg_ci", "avg_demand")


def start_overlay(
    events: DataFrame,
    store: str,
    checkpoint: str,
    lateness: str = LATENESS,
    bin_width: str = "30 minutes",
    region: str = ERCOT,
    **trigger,
):
    writer = (
        overlay_stream(events, lateness, bin_width, region)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda bins, batch_id: write_batch(bins, store, batch_id))
    )
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def read_overlay(spark: SparkSession, store: str) -> DataFrame:
    return read_store(spark, store, OVERLAY_SCHEMA)
