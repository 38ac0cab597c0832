"""Payload folders that the queries fill: compressed files of few lines, nothing lost."""

import glob
import gzip
import json
import os
from datetime import datetime, timedelta

import pytest

from harness import registry
from wattline.sources import deliveries, payloads

DAY = datetime(1996, 5, 1)


def page(n):
    record = {"period": f"1996-05-01T{n % 24:02d}", "respondent": f"R{n}", "type": "D", "value": str(n)}
    return json.dumps({"response": {"total": 1, "data": [record]}})


@pytest.fixture
def tables(spark, folder):
    """A few rows of each table that a payload is made from."""
    orders = [(n, n, "O", 100.0 + n, DAY + timedelta(days=300 * n), "1-URGENT") for n in range(6)]
    lines = [(n, n, n, n % 7, 5.0, 100.0, 0.1, 0.2, "AN"[n % 2], "O", DAY + timedelta(days=n)) for n in range(6)]
    events = [(n, DAY + timedelta(hours=n), n, "view", 10.0 * n, "{}") for n in range(6)]
    schemas = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate timestamp_ntz"),
        "events": (events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (data, schema) in schemas.items():
        spark.createDataFrame(data, schema).write.parquet(folder(f"{name}.parquet"))
    return os.path.dirname(folder("x"))


def test_written_pages_are_small_short_and_whole(spark, folder, monkeypatch, rows):
    monkeypatch.setattr(payloads, "PAGES_PER_FILE", 100)
    texts = [page(n) for n in range(1000)]
    pages = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    payloads.write_pages(pages.limit(400), folder("in"))
    payloads.write_pages(pages.offset(400), folder("in"), mode="append")
    files = glob.glob(f"{folder('in')}/part-*")
    assert sum(map(os.path.getsize, files)) * 3 < sum(map(len, texts))
    lines = [gzip.open(f, "rt").read().splitlines() for f in files]
    assert max(map(len, lines)) <= 100 and sorted(sum(lines, [])) == sorted(texts)
    read = payloads.read_eia(spark, folder("in"), "demand", page_per_line=True)
    assert rows(read, "respondent", "value") == sorted([(f"R{n}", str(n)) for n in range(1000)], key=str)
    taken = []
    streamed = payloads.unwrap_eia(deliveries.stream_pages(spark, folder("in"), "demand", page_per_line=True))
    deliveries.take_new(streamed, folder("ledger"), lambda batch, number: taken.append(batch.count()))
    assert sum(taken) == 1000


@pytest.mark.parametrize("name", ["medallion_by_file", "medallion_two_runs", "medallion_counts"])
def test_a_query_stores_no_plain_pages(spark, tables, monkeypatch, name):
    class Begun(Exception):
        pass

    def begin(spark, paths, *rest, **options):
        raise Begun(paths.payloads)

    monkeypatch.setattr(registry.medallion, "run", begin)
    with pytest.raises(Begun) as begun:
        registry.QUERIES[name](spark, tables)
    files = glob.glob(f"{begun.value.args[0].removeprefix('file:')}/*/part-*")
    assert {os.path.basename(os.path.dirname(f)) for f in files} == {
        "demand", "generation", "carbon", "weather_archive", "weather_forecast",
    }
    assert all(f.endswith(".gz") for f in files)
