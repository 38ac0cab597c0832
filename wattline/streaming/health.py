"""Counters of a running stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRIC = "event_health"


def with_health_metrics(events: DataFrame) -> DataFrame:
    """Count events and track the newest one as a side effect of the batch."""
    return events.observe(
        METRIC,
        F.count(F.lit(1)).alias("events"),
        F.max("timestamp").alias("last_event_time"),
    )


class StreamHealth(StreamingQueryListener):
    """Events sent, errors, newest event time and a status.

    An error turns the status to ``degraded``; the next batch with events turns
    it back to ``ok``. Register with ``spark.streams.addListener``.
    """

    def __init__(self) -> None:
        self.status = "ok"
        self.events_sent = 0
        self.errors = 0
        self.last_event_time = None

    def snapshot(self) -> dict:
        return {
            "status": self.status,
            "events_sent": self.events_sent,
            "errors": self.errors,
            "last_event_time": self.last_event_time,
        }

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        sent = event.progress.numInputRows
        if not sent:
            return
        self.events_sent += sent
        self.status = "ok"
        row = event.progress.observedMetrics.get(METRIC)
        if row is not None and row["last_event_time"] is not None:
            newest = row["last_event_time"]
            if self.last_event_time is None or newest > self.last_event_time:
                self.last_event_time = newest

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            self.errors += 1
            self.status = "degraded"
