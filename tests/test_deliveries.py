"""Payload files taken once each."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException

from wattline.plans import bronze, medallion
from wattline.sources import deliveries

DAY, NEXT = "2024-03-02 06:00:00", "2024-03-03 06:00:00"
SCHEMA = medallion.BRONZE_SCHEMAS["demand"]


def put(base, name, *rows, feed="in"):
    os.makedirs(f"{base}/{feed}", exist_ok=True)
    with open(f"{base}/{feed}/{name}.json", "w") as f:
        json.dump({"response": {"total": len(rows), "data": list(rows)}}, f)


def row(hour, value, day="2024-03-01"):
    return {"period": f"{day}T{hour:02d}", "respondent": "ERCO", "type": "D", "value": value}


def run(spark, base, as_of=DAY, **options):
    return bronze.deliver(
        spark, f"{base}/in", "demand", f"{base}/bronze", f"{base}/ledger", as_of, **options
    )


def landed(spark, base, **options):
    found = deliveries.read(spark, f"{base}/bronze", SCHEMA, **options)
    return sorted((r["delivery"], r["period"], r["value"], str(r["load_date"])) for r in found.collect())


def test_a_file_is_parsed_by_one_run_only(spark, folder):
    base = folder("feed")
    put(base, "a", row(0, 10), row(1, 20))
    put(base, "old", row(5, 30, day="2001-01-01"))
    assert run(spark, base) == 3
    # Reading the taken file again would halt, as this is no JSON.
    with open(f"{base}/in/a.json", "w") as f:
        f.write("{ not json")
    put(base, "b", row(9, 40, day="2030-01-01"))
    assert run(spark, base) == 1
    assert run(spark, base) == 0
    assert landed(spark, base) == [
        (0, "2001-01-01T05", 30.0, "2024-03-02"),
        (0, "2024-03-01T00", 10.0, "2024-03-02"),
        (0, "2024-03-01T01", 20.0, "2024-03-02"),
        (1, "2030-01-01T09", 40.0, "2024-03-02"),
    ]
    assert [r[0] for r in landed(spark, base, after=0)] == [1]
    assert landed(spark, base, after=1) == []


def test_a_file_with_an_old_time_is_new(spark, folder):
    base = folder("feed")
    put(base, "a", row(0, 10))
    assert run(spark, base) == 1
    put(base, "b", row(1, 20))
    os.utime(f"{base}/in/b.json", (1_000_000_000, 1_000_000_000))
    assert run(spark, base) == 1


def test_a_run_that_died_before_its_record_is_replaced(spark, folder):
    base = folder("feed")
    put(base, "a", row(0, 10))
    run(spark, base)
    for name in ("0", ".0.crc"):
        os.remove(f"{base}/ledger/commits/{name}")
    assert run(spark, base, NEXT) == 1
    assert landed(spark, base) == [(0, "2024-03-01T00", 10.0, "2024-03-03")]


def test_half_written_deliveries_do_not_count(spark, folder):
    base = folder("feed")
    put(base, "a", row(0, 10))
    run(spark, base)
    part = f"{base}/bronze/load_date=2024-03-02"
    os.makedirs(f"{part}/delivery=1")
    name = next(n for n in os.listdir(f"{part}/delivery=0") if n.endswith(".parquet"))
    with open(f"{part}/delivery=0/{name}", "rb") as f, open(f"{part}/delivery=1/{name}", "wb") as g:
        g.write(f.read())
    assert deliveries.newest(spark, f"{base}/bronze") == 0
    assert len(landed(spark, base)) == 1
    put(base, "b", row(1, 20))
    run(spark, base)
    assert [r[0] for r in landed(spark, base)] == [0, 1]


def test_a_bad_record_halts_until_mended_or_is_set_aside(spark, folder):
    base = folder("feed")
    put(base, "a", row(0, 10), row(1, "much"))
    with pytest.raises(StreamingQueryException, match="value: not a valid double"):
        run(spark, base)
    assert deliveries.newest(spark, f"{base}/bronze") == -1 and landed(spark, base) == []
    put(base, "a", row(0, 10), row(1, 11))
    assert run(spark, base) == 2

    aside = folder("aside")
    put(aside, "a", row(0, 10), row(1, "much"))
    assert run(spark, aside, rejects_path=f"{aside}/rejects") == 1
    bad = deliveries.read_rejects(spark, f"{aside}/rejects", SCHEMA).collect()
    assert [(r["period"], r["_reason"]) for r in bad] == [("2024-03-01T01", "value: not a valid double")]


def test_nothing_delivered(spark, folder):
    base = folder("feed")
    os.makedirs(f"{base}/in")
    assert run(spark, base) == 0
    assert deliveries.newest(spark, f"{base}/bronze") == -1 and landed(spark, base) == []


def test_observed_weather_wins_within_a_delivery(spark, folder):
    base = folder("feed")
    for name, hours in (("archive", {"00": 1.0, "01": None}), ("forecast", {"01": 8.0, "02": 9.0})):
        os.makedirs(f"{base}/{name}")
        hourly = {
            "time": [f"2024-03-01T{h}:00" for h in hours],
            **{m: list(hours.values()) for m in ("temperature_2m", "wind_speed_10m", "precipitation")},
        }
        with open(f"{base}/{name}/page.json", "w") as f:
            json.dump({"hourly": hourly}, f)
    assert 3 == bronze.deliver_weather(
        spark, f"{base}/archive", f"{base}/forecast", f"{base}/bronze", f"{base}/ledger", DAY
    )
    found = deliveries.read(spark, f"{base}/bronze", medallion.BRONZE_SCHEMAS["weather"])
    assert sorted((r["time"], r["temperature_2m"]) for r in found.collect()) == [
        ("2024-03-01T00:00", 1.0),
        ("2024-03-01T01:00", 0.0),
        ("2024-03-01T02:00", 9.0),
    ]
