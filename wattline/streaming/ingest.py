"""From the event stream to stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.contracts import REASON
from wattline.sources.events import BODY, accepted, rejected
from wattline.streaming.alerts import RULES, Rule, edge_alert_batch, level_alerts
from wattline.streaming.batches import read_store, write_batch
from wattline.streaming.rollup import keep_rollup

TICK = "5 seconds"

EVENT_SCHEMA = (
    "event_id string, region string, timestamp timestamp, demand_mw double, "
    "generation_mw double, carbon_intensity_gco2_kwh double, source string"
)


REJECT_SCHEMA = f"{BODY} string, {REASON} string"


def start_raw_sink(events: DataFrame, path: str, checkpoint: str, **trigger):
    """Append good events to a table partitioned by day, each exactly once."""
    return (
        accepted(events)
        .withColumn("event_date", F.to_date("timestamp"))
        .writeStream.format("parquet")
        .partitionBy("event_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TICK}))
        .start()
    )


def start_reject_sink(checked: DataFrame, path: str, checkpoint: str, **trigger):
    """Append the lines that are no events, with the reason, each exactly once."""
    return (
        rejected(checked)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TICK}))
        .start()
    )


def fan_out_batch(
    batch: DataFrame, batch_id: int, store: str, rules: Sequence[Rule] = RULES, mode: str = "level"
) -> None:
    """One micro-batch to the raw table, the rollup and the alerts; rejects to their own."""
    whole = batch.persist()
    try:
        if REASON in whole.columns:
            write_batch(rejected(whole), f"{store}/rejected", batch_id)
        batch = accepted(whole)
        write_batch(batch, f"{store}/events", batch_id)
        keep_rollup(batch, batch_id, f"{store}/rollup")
        if mode == "edge":
            edge_alert_batch(batch, batch_id, f"{store}/alerts", f"{store}/alert_state", rules)
        else:
            write_batch(level_alerts(batch, rules), f"{store}/alerts", batch_id)
    finally:
        whole.unpersist()


def read_rejects(spark: SparkSession, store: str) -> DataFrame:
    return read_store(spark, f"{store}/rejected", REJECT_SCHEMA)


def read_fan_out_events(spark: SparkSession, store: str) -> DataFrame:
    return read_store(spark, f"{store}/events", EVENT_SCHEMA)


def start_fan_out(
    events: DataFrame,
    store: str,
    checkpoint: str,
    rules: Sequence[Rule] = RULES,
    mode: str = "level",
    **trigger,
):
    """One stream, three sinks. A failed batch is retried whole and loses nothing."""
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: fan_out_batch(batch, batch_id, store, rules, mode)
    )
    return writer.trigger(**(trigger or {"processingTime": TICK})).start()
