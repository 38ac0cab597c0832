"""Order-dependent operators against plain Python, with hot series and hot instants."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wattline.operators import ordered

SCHEMA = "series string, at int, id int, v double"


def sample(n=3_000, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        series = "hot" if i % 3 == 0 else rng.choice("abcde")
        at = 7 if i % 3 == 1 else rng.randrange(200)
        value = None if rng.random() < 0.05 else float(rng.randrange(100))
        rows.append((series, at, i, value))
    rng.shuffle(rows)
    return rows


@pytest.fixture
def many_slices(spark):
    """Keep adaptive execution from merging the small slices of a test."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def by_series(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups[row[0]].append(row)
    return groups


def test_previous(spark, many_slices):
    rows = sample()
    expected = {}
    for members in by_series(rows).values():
        last = None
        for r in members:
            expected[r[2]] = last
            last = r[3]
    out = ordered.with_previous(spark.createDataFrame(rows, SCHEMA), ["series"], ["at", "id"], "v")
    assert {r["id"]: r["previous"] for r in out.collect()} == expected


def test_running_total(spark, many_slices):
    rows = sample()
    expected = {}
    for members in by_series(rows).values():
        total = 0
        for r in members:
            total += r[1]
            expected[r[2]] = total
    df = spark.createDataFrame(rows, SCHEMA)
    out = ordered.with_running_total(df, ["series"], ["at", "id"], F.col("at"))
    assert {r["id"]: r["running"] for r in out.collect()} == expected


def test_one_series_without_a_key(spark, many_slices):
    df = spark.range(1_000).select(F.col("id").cast("int").alias("at"), F.col("id").alias("id"))
    out = ordered.with_running_total(df, [], ["at"], F.lit(1), "n")
    assert out.filter("n <> at + 1").count() == 0
    previous = ordered.with_previous(df, [], ["at"], "id")
    assert previous.filter("not (previous <=> nullif(id, 0) - 1)").count() == 0


def test_hot_series_and_hot_instant_are_spread(spark, many_slices):
    out = ordered.sliced(spark.createDataFrame(sample(), SCHEMA), ["series"], ["at", "id"])
    sizes = [r["count"] for r in out.groupBy(ordered.SLICE).count().collect()]
    assert len(sizes) > 10
    assert max(sizes) < 3_000 / 6  # a third of the rows is one series
