"""The five-minute rollup kept up to date by a stream.

Two forms:

* ``watermarked_rollup`` - the built-in stateful aggregate. State is bounded by
  a lateness allowance; readings later than that are ignored.
* the partials store - any lateness is accepted. Each micro-batch appends its
  own partial sums, counts and maxima per bin; the view adds them up. Bins are
  never rewritten, averages are never averaged, and a retried batch replaces
  its own partials. ``compact_rollup`` folds recent batches together.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.time import Moment, time_bin
from wattline.operators.dedup import first_per_key
from wattline.operators.moments import mean, merged, sample_deviation, squares
from wattline.plans.monitor import ROLLUP_BIN, base_bins, outliers_against, windowed_rollup
from wattline.streaming import batches

# Polled readings carry the start of their half-hour slot as time.
LATENESS = "1 hour"

_KEYS = ("region", "source", "timestamp")
_INTENSITY = "carbon_intensity_gco2_kwh"

PARTIAL_SCHEMA = (
    "region string, source string, timestamp timestamp, "
    "demand_sum double, demand_count bigint, demand_max double, "
    "intensity_sum double, intensity_count bigint, intensity_max double, "
    "event_count bigint, demand_squares double"
)


def watermarked_rollup(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """For update output mode, which emits a bin again whenever it changes."""
    return windowed_rollup(events.withWatermark("timestamp", lateness))


ROLLUP_SCHEMA = (
    "region string, source string, timestamp timestamp, "
    "avg_demand_mw double, max_demand_mw double, "
    "avg_carbon_intensity double, max_carbon_intensity double, "
    "event_count bigint, batch_id bigint"
)


def newest_versions(updates: DataFrame) -> DataFrame:
    """A bin is emitted again whenever it changes; its last version counts."""
    return first_per_key(updates, _KEYS, [F.desc("batch_id")])


def start_watermarked_rollup(
    events: DataFrame, store: str, checkpoint: str, lateness: str = LATENESS, **trigger
):
    """Store each micro-batch's changed bins."""

    def write(changed: DataFrame, batch_id: int) -> None:
        versions = changed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        batches.write_batch(versions, store, batch_id)

    writer = (
        watermarked_rollup(events, lateness)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def read_watermarked_rollup(spark: SparkSession, store: str) -> DataFrame:
    return newest_versions(batches.read_store(spark, store, ROLLUP_SCHEMA)).drop("batch_id")


def compact_watermarked_rollup(spark: SparkSession, store: str) -> None:
    batches.compact(spark, store, ROLLUP_SCHEMA, fold=newest_versions)


def without_repeats(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Drop re-emitted readings of the same slot. Optional, as it changes counts."""
    return events.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(list(_KEYS))


def partial_rollup(events: DataFrame) -> DataFrame:
    return events.groupBy(
        "region",
        "source",
        time_bin("timestamp", ROLLUP_BIN).cast("timestamp").alias("timestamp"),
    ).agg(
        F.sum("demand_mw").alias("demand_sum"),
        F.count("demand_mw").alias("demand_count"),
        F.max("demand_mw").alias("demand_max"),
        F.sum(_INTENSITY).alias("intensity_sum"),
        F.count(_INTENSITY).alias("intensity_count"),
        F.max(_INTENSITY).alias("intensity_max"),
        F.count(F.lit(1)).alias("event_count"),
        squares("demand_mw").alias("demand_squares"),
    )


_MOMENTS = ("demand_count", "demand_sum", "demand_squares")


def _others() -> list[Column]:
    return [
        F.max("demand_max").alias("demand_max"),
        F.sum("intensity_sum").alias("intensity_sum"),
        F.sum("intensity_count").alias("intensity_count"),
        F.max("intensity_max").alias("intensity_max"),
        F.sum("event_count").alias("event_count"),
    ]


def add_up(partials: DataFrame) -> DataFrame:
    """What the rollup shows needs no moments, so this is a single aggregate."""
    sums = [F.sum(c).alias(c) for c in ("demand_sum", "demand_count")]
    return partials.groupBy(*_KEYS).agg(*sums, *_others())


def fold(partials: DataFrame) -> DataFrame:
    """Added-up partials with their moments merged."""
    return merged(partials, _KEYS, *_MOMENTS, more=_others())


def finish(partials: DataFrame) -> DataFrame:
    """Rollup columns from added-up partials."""
    return add_up(partials).select(
        *_KEYS,
        F.try_divide("demand_sum", "demand_count").alias("avg_demand_mw"),
        F.col("demand_max").alias("max_demand_mw"),
        F.try_divide("intensity_sum", "intensity_count").alias("avg_carbon_intensity"),
        F.col("intensity_max").alias("max_carbon_intensity"),
        "event_count",
    )


def write_partials(batch: DataFrame, batch_id: int, store: str) -> None:
    batches.write_batch(partial_rollup(batch), store, batch_id)


def read_rollup(spark: SparkSession, store: str) -> DataFrame:
    return finish(batches.read_store(spark, store, PARTIAL_SCHEMA))


def compact_rollup(spark: SparkSession, store: str) -> None:
    batches.compact(spark, store, PARTIAL_SCHEMA, fold=fold)


def outliers(
    spark: SparkSession,
    store: str,
    events: DataFrame,
    as_of: Moment,
    base: str = "24 hours",
    recent: str = "1 hour",
    k: float = 2.0,
) -> DataFrame:
    """``monitor.zscore_outliers`` of demand by region with the base read from the store.

    Only recent events are opened; the base is the moments of the bins that lie whole in
    its range, a few hundred rows per region and day. A base range that starts within a
    bin therefore begins with the next one.
    """
    bins = base_bins(batches.read_store(spark, store, PARTIAL_SCHEMA), base, as_of)
    count, total, deviations = _MOMENTS
    stats = merged(bins, ["region"], *_MOMENTS).select(
        "region",
        mean(count, total).alias("_mean"),
        sample_deviation(count, deviations).alias("_deviation"),
    )
    return outliers_against(events, stats, as_of, recent=recent, k=k)


#: Batches between two compactions: an hour of five-second ticks.
COMPACT_EVERY = 720


def keep_rollup(
    batch: DataFrame, batch_id: int, store: str, compact_every: int = COMPACT_EVERY
) -> None:
    """One micro-batch to the partials store, which is compacted every so often."""
    write_partials(batch, batch_id, store)
    if (batch_id + 1) % compact_every == 0:
        compact_rollup(batch.sparkSession, store)


def start_rollup(
    events: DataFrame, store: str, checkpoint: str, compact_every: int = COMPACT_EVERY, **trigger
):
    """Keep the partials store current. ``trigger`` as for ``writeStream.trigger``."""
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: keep_rollup(batch, batch_id, store, compact_every)
    )
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
