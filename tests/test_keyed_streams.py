import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_streaming import Inbox, drain, event
from wattline.plans import monitor
from wattline.sources import events as source
from wattline.streaming import keyed, overlay

START = datetime(2024, 3, 1)


@pytest.fixture
def inbox(tmp_path):
    return Inbox(str(tmp_path / "in"))


def clock(n, minute):
    return event(n, minute, region="clock", src="clock")


def readings(count=60, seed=5):
    """Demand around the threshold with gaps, equal times included."""
    rng, minute, out = random.Random(seed), 0, []
    for n in range(count):
        minute += rng.choice((0, 1, 1, 2, 9))
        out.append(event(n, minute, demand=rng.choice((50_000.0, 60_000.0, 70_000.0))))
    return out


def frame(*rows):
    return pd.DataFrame(list(rows), columns=["at", "event_id", "v0"])


def test_settling_in_pieces_equals_settling_at_once():
    rng = random.Random(2)
    line = [(at * 10, f"e{k}", rng.choice((1.0, 5.0, None))) for k, at in enumerate(sorted(rng.choices(range(60), k=40)))]
    end = 2_000
    whole, _, told = keyed.settle(frame(), frame(*line), False, [3.0], 35, end)
    assert told
    last, told, parts = frame(), False, []
    for mark in (0, 50, 55, 200, 201, 480, end):
        before = last["at"].iloc[0] if len(last) else -1
        due = [r for r in line if before < r[0] <= mark]
        found, last, told = keyed.settle(last, frame(*due), told, [3.0], 35, mark)
        parts += found.itertuples(index=False, name=None)
    key = [tuple(map(str, r)) for r in whole.itertuples(index=False, name=None)]
    assert sorted(key) == sorted(tuple(map(str, r)) for r in parts)


def test_nothing_settles_from_nothing():
    found, last, told = keyed.settle(frame(), frame(), False, [3.0], 35, 100)
    assert not len(found) and not len(last) and not told


def test_keyed_alerts_equal_the_batch_form_over_shuffled_arrivals(spark, inbox, folder, rows):
    events = readings()
    order = sorted(events, key=lambda e: (e["timestamp"], random.Random(e["event_id"]).random()))
    waves = [[], [], []]
    for k, e in enumerate(order):  # up to a third of the span late
        waves[min(2, k // 20 + random.Random(k).choice((0, 1)))].append(e)
    for wave in waves:
        random.Random(1).shuffle(wave)
        inbox.put(*wave)
        query = keyed.start_keyed_alerts(
            source.read_events_stream(spark, inbox.path), folder("store"), folder("ck"),
            quiet="5 minutes", lateness="1 day", availableNow=True,
        )
        drain(query)
    assert keyed.read_keyed_alerts(spark, folder("store")).count() == 0  # nothing is final yet
    inbox.put(clock(999, 60 * 48))
    query = keyed.start_keyed_alerts(
        source.read_events_stream(spark, inbox.path), folder("store"), folder("ck"),
        quiet="5 minutes", lateness="1 day", availableNow=True,
    )
    drain(query)
    stored = source.read_events(spark, inbox.path)
    until = F.lit(START + timedelta(hours=24)).cast("timestamp")
    want = keyed.batch_alerts(stored, until, quiet="5 minutes")
    got = rows(keyed.read_keyed_alerts(spark, folder("store")))
    assert got == rows(want) and len(got) > 10
    assert {r[0] for r in got} == {keyed.SILENCE, "ERCOT Demand Spike"}


def test_a_quiet_series_is_told_once_without_an_event_of_its_own(spark, inbox, folder):
    inbox.put(event(1, 0), clock(2, 1))
    inbox.put(clock(3, 30))
    inbox.put(clock(4, 60))
    inbox.put(event(5, 90), clock(6, 120))
    for _ in range(2):  # the second run finds no new file
        query = keyed.start_keyed_alerts(
            source.read_events_stream(spark, inbox.path, max_files_per_trigger=1), folder("store"), folder("ck"),
            quiet="90 seconds", lateness="1 minute", availableNow=True,
        )
        drain(query)
    got = keyed.read_keyed_alerts(spark, folder("store")).orderBy("timestamp").collect()
    assert [(r["rule"], r["event_id"], r["timestamp"]) for r in got] == [
        (keyed.SILENCE, "e0001", START + timedelta(seconds=90)),
        (keyed.SILENCE, "e0005", START + timedelta(minutes=90, seconds=90)),
    ]
    assert got[0]["subject"] == "ALERT: no events from ERCOT (synthetic) for 90 s"


def test_overlay_stream_equals_the_batch_overlay(spark, inbox, folder, rows):
    carbon = [event(n, n * 17, region="GB", ci=100.0 + n, src=source.CARBON_SOURCE) for n in range(30)]
    load = [event(100 + n, n * 41, demand=40_000.0 + n) for n in range(6)]  # partners end early
    inbox.put(*carbon[:15], *load[::2])
    inbox.put(*carbon[15:], *load[1::2])
    inbox.put(clock(999, 60 * 24))
    query = overlay.start_overlay(
        source.read_events_stream(spark, inbox.path, max_files_per_trigger=1),
        folder("store"), folder("ck"), lateness="6 hours", availableNow=True,
    )
    drain(query)
    stored = source.read_events(spark, inbox.path)
    want = monitor.intensity_demand_overlay(stored, START + timedelta(days=2), "3 days")
    got = rows(overlay.read_overlay(spark, folder("store")))
    assert got == rows(want)
    assert any(r[2] is None for r in got) and any(r[2] is not None for r in got)


def test_a_late_partner_joins_while_its_bin_is_open_and_not_after(spark, inbox, folder, rows):
    inbox.put(event(1, 5, region="GB", ci=100.0, src=source.CARBON_SOURCE), clock(2, 35))
    inbox.put(event(3, 6, demand=50_000.0), clock(4, 120))  # within the allowance
    inbox.put(clock(8, 121))  # the bin is over since the last tick and closes with this one
    inbox.put(event(5, 7, demand=90_000.0), event(6, 65, region="GB", ci=50.0, src=source.CARBON_SOURCE))
    inbox.put(clock(7, 300))
    query = overlay.start_overlay(
        source.read_events_stream(spark, inbox.path, max_files_per_trigger=1),
        folder("store"), folder("ck"), lateness="1 hour", availableNow=True,
    )
    drain(query)
    assert rows(overlay.read_overlay(spark, folder("store"))) == [
        (START, 100.0, 50_000.0),
        (START + timedelta(hours=1), 50.0, None),
    ]
