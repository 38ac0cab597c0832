"""Rises and silences by keyed state and event-time timers.

Readings settle in order of time and id once nothing earlier can arrive, so the
alerts are those of the batch form in whatever order events came within
``lateness``; later ones are dropped. A timer settles what is due without a new
event of the series: a series that has been quiet for ``quiet`` raises one
silence alert, and another only after it has spoken again. Other series must move
the watermark; if every one stops, a scheduled check on the stored events remains
the way to notice.

The work is keyed twice. First by series and hour: readings wait for the watermark
there and settle against each other, so the hours of one series spread over the
tasks. What settles at a time is a piece; its first and last reading go on to the
series, which judges the steps from piece to piece and keeps its last reading. The
alerts found within a piece pass beside that, each hour under a key of its own.

State is one reading for each series and what waits, which ``lateness`` bounds; the
task of a series sees two readings of each piece. ``alerts.start_edge_alerts`` takes
readings in the order of their micro-batches instead. Checkpoints from before series
were spread over hours hold another state and cannot be taken up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wattline.functions.measures import whole_number_text
from wattline.functions.time import width
from wattline.operators.ordered import with_previous
from wattline.streaming.alerts import ALERT_SCHEMA, ORDER, RULES, SERIES, Rule, edge_alerts
from wattline.streaming.batches import read_store, write_batch
from wattline.streaming.marks import behind_watermark

SILENCE = "Producer Silence"
QUIET = "90 seconds"
LATENESS = "1 minute"

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Microseconds of a series that settle in one task.
STRETCH = 3_600_000_000

# The lane of the series itself; others are numbers of hours. Ends of pieces have a rule
# of their own, in the order of their places.
_LANE, _JOINTS, _FIRST, _LAST = "lane", -(2**63), -3, -2
_FOUND = ["rule", "event_id", "region", "source", "at", "value"]


def settle(
    last: pd.DataFrame,
    ready: pd.DataFrame,
    told: bool,
    limits: Sequence[float],
    quiet: int,
    mark: int,
    pieces: bool = False,
) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """Alerts of the ready readings, the new last reading, and whether its silence has been told.

    Frames have ``at`` in microseconds, ``event_id`` and a value ``v0, v1 ...`` for each rule;
    ``last`` has one row or none. Alerts have ``rule`` (-1: silence), ``at, event_id, value``.
    With ``pieces`` the ready readings are first and last ones of pieces in turn, and only
    the steps from piece to piece are judged.
    """
    ready = ready.sort_values(["at", "event_id"])
    values = {f"v{k}": float for k in range(len(limits))}
    line = pd.concat([f.astype(values) for f in (last, ready) if len(f)] or [ready], ignore_index=True)
    # The step after a piece's first reading has been judged where the piece settled.
    judged = pd.Series(True, index=line.index)
    if pieces:
        judged.iloc[len(last) :: 2] = False
    reached = judged.shift(1, fill_value=True)
    found = []
    for k, limit in enumerate(limits):
        value = line[f"v{k}"].astype(float)
        risen = line[(value > limit) & (value.shift(1) <= limit) & reached]
        found.append(pd.DataFrame({"rule": k, "at": risen["at"], "event_id": risen["event_id"], "value": risen[f"v{k}"]}))
    until = line["at"].shift(-1, fill_value=mark + 1)
    silent = (until - line["at"] > quiet) & judged
    if len(last) and told:
        silent.iloc[0] = False
    ends = line[silent]
    found.append(pd.DataFrame({"rule": -1, "at": ends["at"] + quiet, "event_id": ends["event_id"], "value": float("nan")}))
    newest = line.tail(1)
    told = bool(silent.iloc[-1]) or (told and not len(ready)) if len(line) else False
    return pd.concat(found, ignore_index=True), newest, told


class _Watch(StatefulProcessor):
    def __init__(self, limits: Sequence[float], quiet: int) -> None:
        self._limits, self._quiet = list(limits), quiet
        self._values = [f"v{k}" for k in range(len(self._limits))]
        self._columns = ["at", "event_id", *self._values]
        self._kept = ", ".join(["at long, event_id string", *[f"{v} double" for v in self._values]])

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self._columns)

    def _plain(self, frame: pd.DataFrame) -> list[tuple]:
        """State keeps an absent value as null, not as NaN."""
        values = [[None if v != v else v for v in frame[c].tolist()] for c in self._values]
        return list(zip(frame["at"].astype("int64").tolist(), frame["event_id"].tolist(), *values))

    def close(self) -> None:
        pass


class StretchWatch(_Watch):
    """One hour of a series: what waits there, and the steps within what settles at a time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", self._kept)

    def _wake(self, waiting: pd.DataFrame) -> None:
        # A timer that is no longer needed finds nothing due.
        self._handle.registerTimer(-(-int(waiting["at"].min()) // 1000))

    def _settled(self, key: tuple, fresh: list[pd.DataFrame], mark: int) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self._waiting.get()] if self._waiting.exists() else []
        frames = [f for f in (self._frame(held), *fresh) if len(f)]
        if not frames:
            return
        waiting = pd.concat(frames, ignore_index=True)
        due = waiting["at"].astype("int64") <= mark
        rest = waiting[~due]
        if len(rest):
            self._waiting.put(self._plain(rest))
            self._wake(rest)
        else:
            self._waiting.clear()
        if due.any():
            yield self._piece(key, waiting[due].sort_values(["at", "event_id"]))

    def _piece(self, key: tuple, ready: pd.DataFrame) -> pd.DataFrame:
        # Whether silence follows the piece is not known here.
        known = int(ready["at"].iloc[-1]) - 1
        found, _, _ = settle(self._frame([]), ready, False, self._limits, self._quiet, known)
        parts = [
            ready.head(1).assign(**{_LANE: _JOINTS, "rule": _FIRST}),
            ready.tail(1).assign(**{_LANE: _JOINTS, "rule": _LAST}),
            *([found.assign(**{_LANE: key[2]})] if len(found) else []),
        ]
        piece = pd.concat([p.reindex(columns=[_LANE, "rule", "value", *self._columns]) for p in parts], ignore_index=True)
        piece[["value", *self._values]] = piece[["value", *self._values]].astype(float)
        settled = pd.to_datetime(piece["at"].astype("int64"), unit="us", utc=True)
        return piece.assign(region=key[0], source=key[1], settled=settled)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = [f[self._columns] for f in rows if len(f)]
        if fresh and min(int(f["at"].min()) for f in fresh) > mark:
            # Readings that wait already have their timer.
            whole = pd.concat(fresh, ignore_index=True)
            self._waiting.appendList(self._plain(whole))
            self._wake(whole)
        else:
            yield from self._settled(key, fresh, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(key, [], timerValues.getCurrentWatermarkInMs() * 1000)


class SeriesWatch(_Watch):
    """A series: its last settled reading, and the steps from piece to piece."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", f"{self._kept}, told boolean")

    def _settled(self, key: tuple, ends: Iterable[pd.DataFrame], mark: int) -> Iterator[pd.DataFrame]:
        kept = self._last.get() if self._last.exists() else None
        last = self._frame([tuple(kept)[:-1]] if kept else [])
        ends = [f for f in ends if len(f)]
        ready = self._frame([])
        if ends:
            ready = pd.concat(ends, ignore_index=True).sort_values(["at", "event_id", "rule"])[self._columns]
        found, last, told = settle(last, ready, bool(kept and kept[-1]), self._limits, self._quiet, mark, pieces=True)
        if len(last):
            row = self._plain(last)[0]
            self._last.update((*row, told))
            if not told:
                self._handle.registerTimer(-(-(row[0] + self._quiet) // 1000))
        if len(found):
            yield found.assign(region=key[0], source=key[1])[_FOUND]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[2] == _JOINTS:
            yield from self._settled(key, rows, timerValues.getCurrentWatermarkInMs() * 1000)
        else:
            for found in rows:
                yield found[_FOUND]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(key, [], timerValues.getCurrentWatermarkInMs() * 1000)


def _watched(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return events.filter(reduce(or_, [r.applies() for r in rules]))


def _silence_text(quiet_seconds: Column) -> Column:
    return F.concat(
        F.lit("ALERT: no events from "), "region", F.lit(" ("), "source", F.lit(") for "),
        quiet_seconds.cast("string"), F.lit(" s"),
    )


def _seconds(spark: SparkSession, quiet: str) -> int:
    start = F.lit("1970-01-01 00:00:00Z").cast("timestamp")
    return spark.range(1).select(F.unix_seconds(start + width(quiet))).first()[0]


def keyed_alerts(
    events: DataFrame, rules: Sequence[Rule] = RULES, quiet: str = QUIET, lateness: str = LATENESS
) -> DataFrame:
    """A stream of alerts, for append output mode. Every event moves the watermark, watched or not."""
    seconds = _seconds(events.sparkSession, quiet)
    values = [F.when(r.applies(), F.col(r.column).cast("double")).alias(f"v{k}") for k, r in enumerate(rules)]
    readings = (
        events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withWatermark("timestamp", lateness)
        .filter(behind_watermark("timestamp", reduce(or_, [r.applies() for r in rules])))
        .select(*SERIES, "timestamp", "event_id", F.unix_micros("timestamp").alias("at"), *values)
        .withColumn(_LANE, F.expr(f"at div {STRETCH}"))
    )
    watch = ([r.threshold for r in rules], seconds * 1_000_000)
    schema = "rule int, event_id string, region string, source string, at long, value double"
    kept = "".join(f", v{k} double" for k in range(len(rules)))
    pieces = readings.groupBy(*SERIES, _LANE).transformWithStateInPandas(
        StretchWatch(*watch),
        f"{schema}, {_LANE} long, settled timestamp{kept}",
        "append",
        "eventTime",
        eventTimeColumnName="settled",
    )
    found = pieces.groupBy(*SERIES, _LANE).transformWithStateInPandas(
        SeriesWatch(*watch), schema, "append", "eventTime"
    )
    rule, subject = F.when(F.col("rule") < 0, SILENCE), F.when(F.col("rule") < 0, _silence_text(F.lit(seconds)))
    for k, r in enumerate(rules):
        head, tail = r.subject.split("{}")
        rule = rule.when(F.col("rule") == k, r.name)
        subject = subject.when(
            F.col("rule") == k, F.concat(F.lit(head), whole_number_text("value"), F.lit(tail))
        )
    value = F.when(F.col("rule") >= 0, F.col("value"))
    return found.select(
        rule.alias("rule"), "event_id", "region", "source",
        F.timestamp_micros("at").alias("timestamp"), value.alias("value"), subject.alias("subject"),
    )


def batch_alerts(
    events: DataFrame, until: Column, rules: Sequence[Rule] = RULES, quiet: str = QUIET
) -> DataFrame:
    """The same alerts from stored events, as known when the watermark stands at ``until``."""
    seconds = _seconds(events.sparkSession, quiet)
    seen = _watched(events, rules).filter(F.col("timestamp") <= until).select(*SERIES, *ORDER)
    reading = F.struct("timestamp", "event_id")
    linked = with_previous(seen.withColumn("_own", reading), SERIES, ORDER, "_own", "_before")
    gaps = linked.select(*SERIES, "_before", F.col("timestamp").alias("_next")).where("_before is not null")
    ends = (
        seen.groupBy(*SERIES)
        .agg(F.max(reading).alias("_before"))
        .withColumn("_next", until + F.make_dt_interval(secs=F.lit(0.000001).cast("decimal(18,6)")))
    )
    due = F.col("_before.timestamp") + width(quiet)
    silences = gaps.unionByName(ends).where(F.col("_next") > due).select(
        F.lit(SILENCE).alias("rule"), F.col("_before.event_id").alias("event_id"), *SERIES,
        due.alias("timestamp"), F.lit(None).cast("double").alias("value"),
        _silence_text(F.lit(seconds)).alias("subject"),
    )
    return edge_alerts(events.filter(F.col("timestamp") <= until), rules).unionByName(silences)


def start_keyed_alerts(
    events: DataFrame,
    store: str,
    checkpoint: str,
    rules: Sequence[Rule] = RULES,
    quiet: str = QUIET,
    lateness: str = LATENESS,
    **trigger,
):
    """Keyed state of this kind needs the RocksDB store; other streams of the session keep theirs."""
    spark = events.sparkSession
    writer = (
        keyed_alerts(events, rules, quiet, lateness)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda found, batch_id: write_batch(found, store, batch_id))
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
    )
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def read_keyed_alerts(spark: SparkSession, store: str) -> DataFrame:
    return read_store(spark, store, ALERT_SCHEMA)
