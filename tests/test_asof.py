"""Facts against versions of their members, and moments that merge."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattline.operators.asof import as_of_join
from wattline.operators.moments import mean, merged, sample_deviation, squares

START = datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


def frames(spark, facts, versions):
    return (
        spark.createDataFrame(
            [(i, k, at(t)) for i, (k, t) in enumerate(facts)], "id int, member string, time timestamp"
        ),
        spark.createDataFrame(
            [(k, a, at(s), at(e)) for k, a, s, e in versions],
            "member string, desk string, valid_from timestamp, valid_to timestamp",
        ),
    )


def joined(spark, facts, versions):
    found = as_of_join(*frames(spark, facts, versions), ["member"], "time", ["desk"]).collect()
    return [r["desk"] for r in sorted(found, key=lambda r: r["id"])]


def test_bounds_gaps_and_missing_members(spark):
    versions = [("a", "one", 0, 5), ("a", "two", 8, None), ("b", "late", 3, None)]
    facts = [("a", 0), ("a", 4), ("a", 5), ("a", 8), ("a", 99), ("b", 2), ("b", 3), ("c", 4)]
    assert joined(spark, facts, versions) == ["one", "one", None, "two", "two", None, "late", None]


def test_nulls_repeats_and_empty_sides(spark):
    versions = [("a", "ever", None, 5), (None, "nobody", 0, None)]
    facts = [(None, 1), ("a", None), ("a", -100), ("a", 1), ("a", 1)]
    assert joined(spark, facts, versions) == [None, None, "ever", "ever", "ever"]
    assert joined(spark, facts, []) == [None] * 5
    assert joined(spark, [], versions) == []


def test_clashing_columns_are_refused(spark):
    facts, versions = frames(spark, [("a", 1)], [("a", "x", 0, None)])
    with pytest.raises(ValueError, match="desk"):
        as_of_join(facts.withColumn("desk", F.lit(1)), versions, ["member"], "time", ["desk"])


def test_hot_member_against_a_plain_search(spark):
    rng = random.Random(7)
    cuts = {k: sorted(rng.sample(range(500), 12)) for k in "abcd"}
    versions = [
        (k, f"{k}{s}", s, e) for k, c in cuts.items() for s, e in zip(c, [*c[1:], None])
    ]
    facts = [(rng.choice("aaaaaaaaaabce"), rng.randrange(520)) for _ in range(3000)]
    expected = [
        next((a for m, a, s, e in versions if m == k and s <= t and (e is None or t < e)), None)
        for k, t in facts
    ]
    assert joined(spark, facts, versions) == expected


def test_moments_merge_in_any_order(spark):
    rng = random.Random(3)
    # Far from zero, so that sums of squares would lose every digit.
    values = [1e9 + rng.random() for _ in range(400)]
    rows = spark.createDataFrame([(i % 37, v) for i, v in enumerate(values)], "part int, v double")
    rows = rows.unionByName(spark.createDataFrame([(99, None)], "part int, v double"))
    parts = rows.groupBy("part").agg(
        F.count("v").alias("n"), F.sum("v").alias("s"), squares("v").alias("d")
    )
    twice = merged(
        parts.withColumn("half", F.col("part") % 2), ["half"], "n", "s", "d"
    ).withColumn("half", F.lit(None).cast("int"))
    whole = parts.withColumn("half", F.lit(None).cast("int"))
    for frame in (twice, whole):
        got = merged(frame, ["half"], "n", "s", "d").select(
            mean("n", "s").alias("m"), sample_deviation("n", "d").alias("sd"), "n"
        ).collect()[0]
        assert got["n"] == 400
        assert got["m"] == pytest.approx(statistics.fmean(values), rel=1e-14)
        assert got["sd"] == pytest.approx(statistics.stdev(values), rel=1e-6)


def test_one_value_has_no_deviation_and_old_parts_no_moments(spark):
    one = spark.createDataFrame([("x", 1, 5.0, 0.0), ("y", 2, 6.0, None)], "k string, n int, s double, d double")
    got = {r["k"]: r["sd"] for r in merged(one, ["k"], "n", "s", "d").select(
        "k", sample_deviation("n", "d").alias("sd")).collect()}
    assert got == {"x": None, "y": None}
