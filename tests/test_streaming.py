import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline.plans import monitor
from wattline.sources import events as source
from wattline.streaming import alerts, batches, health, ingest, rollup

START = datetime(2024, 3, 1)


def event(n, minute, demand=40_000.0, region="ERCOT", ci=200.0, src="synthetic"):
    at = START + timedelta(minutes=minute)
    return {
        "event_id": f"e{n:04d}",
        "region": region,
        "timestamp": at.isoformat() + "+00:00",
        "demand_mw": demand,
        "generation_mw": demand,
        "carbon_intensity_gco2_kwh": ci,
        "source": src,
    }


class Inbox:
    def __init__(self, path):
        self.path = path
        os.makedirs(path)
        self.files = 0

    def put(self, *events):
        self.files += 1
        name = f"{self.path}/f{self.files:03d}.json"
        with open(name + ".tmp", "w") as f:
            f.write("\n".join(json.dumps(e) for e in events))
        os.rename(name + ".tmp", name)
        # The file source takes files in order of modification time.
        stamp = time.time() - 1_000 + self.files
        os.utime(name, (stamp, stamp))


@pytest.fixture
def inbox(tmp_path):
    return Inbox(str(tmp_path / "in"))


def stream(spark, inbox):
    return source.read_events_stream(spark, inbox.path, max_files_per_trigger=1)


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


def mixed(n=60):
    out = []
    for i in range(n):
        if i % 4 == 0:
            out.append(event(i, i * 1.5, 0.0, "GB", 100.0 + i, source.CARBON_SOURCE))
        else:
            out.append(event(i, i * 1.5, 30_000.0 + i, ("ERCOT", "MISO")[i % 2]))
    return out


def test_rollup_with_late_files_equals_the_batch(spark, inbox, folder, rows):
    data = mixed()
    inbox.put(*data[30:])  # the older half comes last
    inbox.put(*data[:30:2])
    inbox.put(*data[1:30:2])
    drain(rollup.start_rollup(stream(spark, inbox), folder("s"), folder("c"), availableNow=True))
    expected = rows(monitor.five_minute_rollup(source.read_events(spark, inbox.path)), *COLUMNS)
    assert rows(rollup.read_rollup(spark, folder("s")), *COLUMNS) == expected
    rollup.compact_rollup(spark, folder("s"))
    assert rows(rollup.read_rollup(spark, folder("s")), *COLUMNS) == expected

    inbox.put(event(900, 1, 99_000.0))
    drain(rollup.start_rollup(stream(spark, inbox), folder("s"), folder("c"), availableNow=True))
    rollup.compact_rollup(spark, folder("s"))
    expected = rows(monitor.five_minute_rollup(source.read_events(spark, inbox.path)), *COLUMNS)
    assert rows(rollup.read_rollup(spark, folder("s")), *COLUMNS) == expected


COLUMNS = (
    "region",
    "source",
    "timestamp",
    "avg_demand_mw",
    "max_demand_mw",
    "avg_carbon_intensity",
    "max_carbon_intensity",
    "event_count",
)


def frame(spark, *events):
    texts = [(json.dumps(e),) for e in events]
    return source.parse_event_json(spark.createDataFrame(texts, "value string"))


def test_retried_batch_counts_once(spark, folder, rows):
    store = folder("s")
    first, second = frame(spark, *mixed(20)), frame(spark, *mixed(40)[20:])
    rollup.write_partials(first, 0, store)
    rollup.write_partials(second, 1, store)
    rollup.write_partials(second, 1, store)
    expected = rows(monitor.five_minute_rollup(frame(spark, *mixed(40))), *COLUMNS)
    assert rows(rollup.read_rollup(spark, store), *COLUMNS) == expected
    rollup.compact_rollup(spark, store)
    rollup.write_partials(second, 1, store)  # retried after it was folded in
    assert rows(rollup.read_rollup(spark, store), *COLUMNS) == expected


def test_a_reader_survives_a_compaction(spark, folder):
    store = folder("s")
    for k in range(3):
        rollup.write_partials(frame(spark, *mixed(8)), k, store)
    before = rollup.read_rollup(spark, store)  # listed, not read yet
    rollup.compact_rollup(spark, store)
    assert before.agg(F.sum("event_count")).first()[0] == 24
    rollup.keep_rollup(frame(spark, *mixed(8)), 3, store, compact_every=4)
    assert sorted(os.listdir(f"{store}/new")) == ["batch_id=3"]  # the covered ones went, the last cycle stays
    assert rollup.read_rollup(spark, store).agg(F.sum("event_count")).first()[0] == 32


def test_unfinished_batch_does_not_count(spark, folder):
    store = folder("s")
    rollup.write_partials(frame(spark, *mixed(8)), 0, store)
    rollup.write_partials(frame(spark, *mixed(8)), 1, store)
    os.remove(f"{store}/new/batch_id=1/_SUCCESS")
    assert rollup.read_rollup(spark, store).agg(F.sum("event_count")).first()[0] == 8


def test_empty_store(spark, folder):
    assert rollup.read_rollup(spark, folder("none")).count() == 0
    rollup.compact_rollup(spark, folder("none"))


def test_watermarked_rollup_takes_late_readings_within_the_allowance(spark, inbox):
    inbox.put(event(1, 60), event(2, 61))
    inbox.put(event(3, 40, 10.0))  # late, but by less than an hour
    query = (
        rollup.watermarked_rollup(stream(spark, inbox))
        .writeStream.outputMode("update")
        .format("memory")
        .queryName("watermarked")
        .trigger(availableNow=True)
        .start()
    )
    drain(query)
    got = {r["timestamp"].minute: r["event_count"] for r in spark.table("watermarked").collect()}
    assert got == {0: 2, 40: 1}


def test_watermarked_rollup_ignores_what_is_later_than_the_allowance(spark, inbox, folder):
    for batch in ([event(1, 600)], [event(2, 0), event(3, 570), event(4, 538), event(5, 541)], [event(6, 700)]):
        inbox.put(*batch)
        drain(
            rollup.start_watermarked_rollup(stream(spark, inbox), folder("s"), folder("c"), availableNow=True)
        )
    got = rollup.read_watermarked_rollup(spark, folder("s")).collect()
    assert sum(r["event_count"] for r in got) == 4  # 0 and 538 ended before the mark of minute 540


def test_watermarked_store_keeps_the_last_version_of_a_bin(spark, inbox, folder, rows):
    inbox.put(event(1, 60), event(2, 61))
    inbox.put(event(3, 62, 99_000.0), event(4, 66))
    drain(
        rollup.start_watermarked_rollup(
            stream(spark, inbox), folder("s"), folder("c"), availableNow=True
        )
    )
    expected = rows(monitor.five_minute_rollup(source.read_events(spark, inbox.path)), *COLUMNS)
    assert rows(rollup.read_watermarked_rollup(spark, folder("s")), *COLUMNS) == expected
    rollup.compact_watermarked_rollup(spark, folder("s"))
    assert rows(rollup.read_watermarked_rollup(spark, folder("s")), *COLUMNS) == expected


def test_repeated_readings_can_be_dropped(spark, inbox, folder):
    same = [event(i, 30, 0.0, "GB", 120.0, source.CARBON_SOURCE) for i in range(3)]
    inbox.put(*same[:2])
    inbox.put(same[2])
    query = (
        rollup.without_repeats(stream(spark, inbox))
        .writeStream.format("parquet")
        .option("path", folder("out"))
        .option("checkpointLocation", folder("c"))
        .trigger(availableNow=True)
        .start()
    )
    drain(query)
    assert spark.read.parquet(folder("out")).count() == 1


def test_raw_sink_is_partitioned_by_day_and_restarts_where_it_stopped(spark, inbox, folder):
    inbox.put(event(1, 10), event(2, 24 * 60 + 10))
    drain(ingest.start_raw_sink(stream(spark, inbox), folder("t"), folder("c"), availableNow=True))
    inbox.put(event(3, 20))
    drain(ingest.start_raw_sink(stream(spark, inbox), folder("t"), folder("c"), availableNow=True))
    table = spark.read.parquet(folder("t"))
    assert table.count() == 3
    assert {p for p in os.listdir(folder("t")) if "=" in p} == {
        "event_date=2024-03-01",
        "event_date=2024-03-02",
    }


def test_level_alerts_on_a_stream(spark, inbox, folder):
    inbox.put(event(1, 1, 60_500.0), event(2, 2, 10.0))
    query = (
        alerts.level_alerts(stream(spark, inbox))
        .writeStream.format("parquet")
        .option("path", folder("a"))
        .option("checkpointLocation", folder("c"))
        .trigger(availableNow=True)
        .start()
    )
    drain(query)
    assert [r["event_id"] for r in spark.read.parquet(folder("a")).collect()] == ["e0001"]


def start_edges(spark, inbox, folder):
    return alerts.start_edge_alerts(
        stream(spark, inbox), folder("a"), folder("st"), folder("c"), availableNow=True
    )


def test_edge_alerts_carry_the_last_reading_across_batches(spark, inbox, folder, rows):
    levels = [50_000.0, 61_000.0, 62_000.0, 59_000.0, 63_000.0, 64_000.0]
    data = [event(i, i, v) for i, v in enumerate(levels)]
    inbox.put(*data[:1])
    inbox.put(*data[1:2])
    inbox.put(*data[2:4])
    drain(start_edges(spark, inbox, folder))
    inbox.put(*data[4:])
    drain(start_edges(spark, inbox, folder))
    expected = rows(alerts.edge_alerts(source.read_events(spark, inbox.path)), "event_id")
    assert expected == [("e0001",), ("e0004",)]
    assert rows(alerts.read_alerts(spark, folder("a")), "event_id") == expected


def test_retried_edge_batch_starts_from_the_same_state(spark, folder, rows):
    first = frame(spark, event(1, 1, 10.0))
    second = frame(spark, event(2, 2, 61_000.0))
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        alerts.edge_alert_batch(batch, batch_id, folder("a"), folder("s"))
    assert rows(alerts.read_alerts(spark, folder("a")), "event_id") == [("e0002",)]


@pytest.mark.parametrize("mode", ["level", "edge"])
def test_fan_out(spark, inbox, folder, rows, mode):
    data = [event(i, i, 59_990.0 + i * 7) for i in range(6)]
    inbox.put(*data[:3])
    inbox.put(*data[3:])
    drain(
        ingest.start_fan_out(
            stream(spark, inbox), folder("s"), folder("c"), mode=mode, availableNow=True
        )
    )
    everything = source.read_events(spark, inbox.path)
    assert rows(ingest.read_fan_out_events(spark, folder("s"))) == rows(everything)
    assert rows(rollup.read_rollup(spark, folder("s/rollup")), *COLUMNS) == rows(
        monitor.five_minute_rollup(everything), *COLUMNS
    )
    assert rows(alerts.read_alerts(spark, folder("s/alerts"))) == rows(
        alerts.alert_rules(everything, mode=mode)
    )
    batches.compact(spark, folder("s/events"), ingest.EVENT_SCHEMA)
    assert rows(ingest.read_fan_out_events(spark, folder("s"))) == rows(everything)


def settle(condition):
    for _ in range(100):
        if condition():
            return
        time.sleep(0.1)
    raise AssertionError("listener did not catch up")


def test_health_counts_errors_and_recovers(spark, inbox, folder):
    listener = health.StreamHealth()
    spark.streams.addListener(listener)
    try:
        inbox.put(event(1, 1), event(2, 5))
        watched = health.with_health_metrics(stream(spark, inbox))
        fails = {"yes": False}

        def sink(batch, batch_id):
            batch.count()
            if fails["yes"]:
                raise RuntimeError("sink down")

        def run():
            return (
                watched.writeStream.foreachBatch(sink)
                .option("checkpointLocation", folder("c"))
                .trigger(availableNow=True)
                .start()
            )

        drain(run())
        settle(lambda: listener.events_sent == 2)
        assert listener.snapshot()["status"] == "ok"
        inbox.put(event(3, 9))
        fails["yes"] = True
        with pytest.raises(Exception):
            run().awaitTermination(60)
        settle(lambda: listener.errors == 1)
        assert listener.status == "degraded"
        fails["yes"] = False
        drain(run())  # the failed batch is retried, nothing is lost
        settle(lambda: listener.events_sent == 3)
        assert listener.status == "ok"
    finally:
        spark.streams.removeListener(listener)


def test_health_reports_the_newest_event(spark, inbox, folder):
    listener = health.StreamHealth()
    spark.streams.addListener(listener)
    try:
        inbox.put(event(1, 1), event(2, 5))
        watched = health.with_health_metrics(stream(spark, inbox))
        drain(ingest.start_raw_sink(watched, folder("t"), folder("c"), availableNow=True))
        settle(lambda: listener.last_event_time is not None)
        assert listener.last_event_time.minute == 5
    finally:
        spark.streams.removeListener(listener)


def test_event_ids_of_readings_survive_recomputation(spark, rows):
    df = spark.createDataFrame(
        [("2024-03-01T00:00Z", "2024-03-01T00:30Z", 10.0, 20.0)],
        "from string, to string, intensity_actual double, intensity_forecast double",
    )
    assert rows(source.readings_to_events(df)) == rows(source.readings_to_events(df))
