"""Keyed alerts whose series are spread over hours."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_keyed_streams import START, clock, frame, readings
from tests.test_streaming import Inbox, drain, event
from wattline.sources import events as source
from wattline.streaming import keyed


@pytest.fixture
def inbox(tmp_path):
    return Inbox(str(tmp_path / "in"))


def texts(*found):
    return sorted(tuple(map(str, r)) for f in found for r in f.itertuples(index=False, name=None))


@pytest.mark.parametrize("seed", range(5))
def test_pieces_and_the_steps_between_them_equal_the_whole_line(seed):
    rng = random.Random(seed)
    line = [(at * 10, f"e{k}", rng.choice((1.0, 5.0, None))) for k, at in enumerate(sorted(rng.choices(range(60), k=40)))]
    end, quiet = 2_000, rng.choice((0, 35))
    whole, newest, told = keyed.settle(frame(), frame(*line), False, [3.0], quiet, end)
    parts, last, known = [], frame(), False
    pieces = [p for p in ([r for r in line if low <= r[0] < low + 70] for low in range(0, 600, 70)) if p]
    for piece in pieces:
        parts.append(keyed.settle(frame(), frame(*piece), False, [3.0], quiet, piece[-1][0] - 1)[0])
    for some, mark in ((pieces[:4], pieces[3][-1][0]), (pieces[4:], end)):
        ends = [r for p in some for r in (p[0], p[-1])]
        found, last, known = keyed.settle(last, frame(*ends), known, [3.0], quiet, mark, pieces=True)
        parts.append(found)
    assert texts(*parts) == texts(whole) and len(whole) > 5
    assert texts(last) == texts(newest) and known == told


def run(spark, inbox, folder):
    events = source.read_events_stream(spark, inbox.path)
    query = keyed.start_keyed_alerts(
        events, folder("store"), folder("ck"), quiet="5 minutes", lateness="1 day", availableNow=True
    )
    drain(query)


def test_hours_of_one_series_wait_under_keys_of_their_own(spark, inbox, folder):
    inbox.put(*[event(n, 20 * n, demand=50_000.0) for n in range(18)])
    run(spark, inbox, folder)
    spark.conf.set(keyed._PROVIDER, keyed._ROCKSDB)
    try:
        state = spark.read.format("statestore").options(stateVarName="waiting", operatorId=1).load(folder("ck"))
        assert state.select("key").distinct().count() == 6
    finally:
        spark.conf.unset(keyed._PROVIDER)


def test_many_pieces_of_a_series_equal_the_batch_form(spark, inbox, folder, rows, monkeypatch):
    monkeypatch.setattr(keyed, "STRETCH", 7 * 60_000_000)
    events = readings(count=120, seed=9)
    random.Random(3).shuffle(events)
    for k in range(0, 120, 60):
        # The mark ends amid an hour with readings on both sides of it.
        inbox.put(*events[k : k + 60], clock(900 + k, 24 * 60 + (k and 131)))
        run(spark, inbox, folder)
    inbox.put(clock(999, 60 * 48))
    run(spark, inbox, folder)
    until = F.lit(START + timedelta(hours=24)).cast("timestamp")
    want = keyed.batch_alerts(source.read_events(spark, inbox.path), until, quiet="5 minutes")
    got = rows(keyed.read_keyed_alerts(spark, folder("store")))
    assert got == rows(want)
    assert {r[0] for r in got} == {keyed.SILENCE, "ERCOT Demand Spike"}
