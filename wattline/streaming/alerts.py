"""Threshold rules over events.

``level`` fires on every reading beyond the threshold. ``edge`` fires when a
series rises past it: the previous reading of the same region and source was at
or below the threshold. The first reading of a series has no previous one and
does not fire.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.measures import whole_number_text
from wattline.operators.ordered import with_previous
from wattline.sources.events import CARBON_SOURCE, SYNTHETIC_SOURCE
from wattline.streaming.batches import forget_states, read_state, read_store, write_batch

SERIES = ("region", "source")
ORDER = ("timestamp", "event_id")


@dataclass(frozen=True)
class Rule:
    """``subject`` is the message with ``{}`` where the rounded value goes."""

    name: str
    column: str
    threshold: float
    subject: str
    region: str | None = None
    source: str | None = None

    def applies(self) -> Column:
        scope = F.lit(True)
        if self.region is not None:
            scope = scope & (F.col("region") == self.region)
        if self.source is not None:
            scope = scope & (F.col("source") == self.source)
        return scope

    def exceeded(self) -> Column:
        return F.col(self.column) > self.threshold

    def alert(self) -> Column:
        before, after = self.subject.split("{}")
        return F.struct(
            F.lit(self.name).alias("rule"),
            F.col("event_id").alias("event_id"),
            F.col("region").alias("region"),
            F.col("source").alias("source"),
            F.col("timestamp").alias("timestamp"),
            F.col(self.column).alias("value"),
            F.concat(F.lit(before), whole_number_text(self.column), F.lit(after)).alias("subject"),
        )


# The two rules in operation.
DEMAND_SPIKE = Rule(
    "ERCOT Demand Spike",
    "demand_mw",
    60_000,
    "ALERT: ERCOT demand spike — {} MW",
    region="ERCOT",
    source=SYNTHETIC_SOURCE,
)
HIGH_INTENSITY = Rule(
    "GB High Carbon Intensity",
    "carbon_intensity_gco2_kwh",
    250,
    "ALERT: GB carbon intensity high — {} gCO₂/kWh",
    source=CARBON_SOURCE,
)
RULES = (DEMAND_SPIKE, HIGH_INTENSITY)


def _emit(df: DataFrame, fired: Sequence[tuple[Rule, Column]]) -> DataFrame:
    """All rules in one pass over the rows; rows no rule wants go first."""
    wanted = reduce(or_, [condition for _, condition in fired])
    alerts = F.array_compact(F.array(*[F.when(c, rule.alert()) for rule, c in fired]))
    return df.filter(wanted).select(F.inline(alerts))


def level_alerts(events: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Stateless, so it takes a batch or a stream."""
    return _emit(events, [(r, r.applies() & r.exceeded()) for r in rules])


def _watched(rules: Sequence[Rule]) -> list[str]:
    return list(dict.fromkeys(r.column for r in rules))


def _previous(column: str) -> Column:
    return F.col("_previous")[column]


def _edge(rows: DataFrame, rules: Sequence[Rule], eligible: Column) -> DataFrame:
    readings = rows.withColumn("_values", F.struct(*_watched(rules)))
    linked = with_previous(readings, SERIES, ORDER, "_values", "_previous").filter(eligible)
    return _emit(
        linked,
        [(r, r.applies() & r.exceeded() & (_previous(r.column) <= r.threshold)) for r in rules],
    )


def edge_alerts(events: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Batch form, in order of time and then id within a region and source."""
    scope = reduce(or_, [r.applies() for r in rules])
    rows = events.filter(scope).select(*SERIES, *ORDER, *_watched(rules))
    return _edge(rows, rules, F.lit(True))


def alert_rules(
    events: DataFrame, rules: Sequence[Rule] = RULES, mode: str = "level"
) -> DataFrame:
    return {"level": level_alerts, "edge": edge_alerts}[mode](events, rules)


# ---- edge alerts on a stream -------------------------------------------------
# The last reading per series is carried from batch to batch as a small table,
# one folder per batch, so that a retried batch starts from the same state.


def _state_schema(rules: Sequence[Rule]) -> str:
    measures = ", ".join(f"{c} double" for c in _watched(rules))
    return f"region string, source string, timestamp timestamp, event_id string, {measures}"


def edge_alert_batch(
    batch: DataFrame,
    batch_id: int,
    alerts_store: str,
    state_store: str,
    rules: Sequence[Rule] = RULES,
) -> None:
    """Write the alerts of one micro-batch and the state it leaves behind.

    A reading older than the last one seen has no earlier reading to rise from
    unless its own batch holds one.
    """
    spark = batch.sparkSession
    columns = [*SERIES, *ORDER, *_watched(rules)]
    scope = reduce(or_, [r.applies() for r in rules])
    fresh = batch.filter(scope).select(*columns).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    )
    last_seen = read_state(spark, state_store, batch_id, _state_schema(rules))

    rows = fresh.withColumn("_new", F.lit(True)).unionByName(
        last_seen.select(*columns).withColumn("_new", F.lit(False))
    )
    write_batch(_edge(rows, rules, F.col("_new")), alerts_store, batch_id)

    newest = rows.groupBy(*SERIES).agg(
        F.max_by(F.struct(*ORDER, *_watched(rules)), F.struct(*ORDER)).alias("_last")
    )
    write_batch(newest.select(*SERIES, "_last.*"), state_store, batch_id)
    forget_states(spark, state_store, batch_id)


ALERT_SCHEMA = (
    "rule string, event_id string, region string, source string, "
    "timestamp timestamp, value double, subject string"
)


def read_alerts(spark: SparkSession, alerts_store: str) -> DataFrame:
    return read_store(spark, alerts_store, ALERT_SCHEMA)


def start_edge_alerts(
    events: DataFrame,
    alerts_store: str,
    state_store: str,
    checkpoint: str,
    rules: Sequence[Rule] = RULES,
    **trigger,
):
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: edge_alert_batch(
            batch, batch_id, alerts_store, state_store, rules
        )
    )
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
