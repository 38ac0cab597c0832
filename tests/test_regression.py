from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import regression
from wattline.plans import insights

START = datetime(2024, 1, 1)


def table(spark, seed=1, groups=("A", "B"), rows=200, shift=0.0):
    rng, out = np.random.default_rng(seed), []
    for k, g in enumerate(groups):
        x = rng.normal(size=(rows, 3)) * (1, 10, 100) + shift
        y = 3 + k + x @ np.array([2.0, -1.0, 0.5]) + rng.normal(size=rows)
        out += [(g, i // 40, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(out, "g string, part int, x0 double, x1 double, x2 double, y double")


def fitted(rows):
    data = np.array([[r["x0"], r["x1"], r["x2"], r["y"]] for r in rows])
    left = np.column_stack([np.ones(len(data)), data[:, :3]])
    return np.linalg.lstsq(left, data[:, 3], rcond=None)[0]


NAMES = ["x0", "x1", "x2", "y"]


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_coefficients_are_those_of_least_squares(spark, shift):
    df = table(spark, shift=shift)
    got = regression.solve(regression.moments(df, ["g"], NAMES), ["g"], 4).collect()
    for r in got:
        base, *slopes = fitted(df.where(F.col("g") == r["g"]).collect())
        assert [r[f"_slope_{i}"] for i in range(3)] == pytest.approx(slopes, rel=1e-6)
        assert r["_base"] == pytest.approx(base, rel=1e-4, abs=1e-4 * max(shift, 1))


def test_merged_stretches_equal_a_fit_of_all_earlier_rows(spark):
    df = table(spark)
    merged = regression.before(regression.moments(df, ["g", "part"], NAMES), ["g"], "part", 4)
    for r in regression.solve(merged, ["g", "part"], 4).collect():
        earlier = df.where((F.col("g") == r["g"]) & (F.col("part") < r["part"])).collect()
        assert r["_n"] == len(earlier)
        if not earlier:
            assert r["_base"] is None and r["_level"] is None
            continue
        base, *slopes = fitted(earlier)
        assert [r["_base"], *[r[f"_slope_{i}"] for i in range(3)]] == pytest.approx([base, *slopes], rel=1e-8)


def test_explained_and_constant_regressors_count_for_nothing(spark):
    df = table(spark, groups=("A",)).withColumn("x1", F.col("x0") * 2).withColumn("x2", F.lit(7.0))
    r = regression.solve(regression.moments(df, ["g"], NAMES), ["g"], 4).first()
    line = np.polyfit(*zip(*[(x["x0"], x["y"]) for x in df.collect()]), 1)
    assert r["_slope_0"] == pytest.approx(line[0]) and r["_slope_1"] == 0 and r["_slope_2"] == 0


def test_incomplete_rows_and_small_groups(spark):
    few = table(spark, groups=("A",), rows=regression.LEAST_ROWS - 1)
    gap = few.limit(3).withColumn("x1", F.lit(None).cast("double")).withColumn("g", F.lit("gap"))
    got = regression.solve(regression.moments(few.union(gap), ["g"], NAMES), ["g"], 4)
    by = {r["g"]: r for r in got.collect()}
    assert by["A"]["_slope_0"] is None and by["A"]["_level"] is not None
    assert by["gap"]["_n"] == 0 and by["gap"]["_level"] is None
    assert regression.solve(regression.moments(few.limit(0), ["g"], NAMES), ["g"], 4).count() == 0


def hourly(spark, hours=24 * 40, hot=None):
    """Two respondents with a daily wave, a trend of their own and the weather's effect."""
    rng, rows = np.random.default_rng(3), []
    warm = rng.normal(size=hours).round(2)
    for k, name in enumerate(("A", "B")):
        for h in range(hours):
            if rng.random() < 0.97:
                load = 1000 * (k + 1) + 50 * np.sin(h / 24 * 6.283) + h * 0.1 + 20 * warm[h] + rng.normal()
                rows.append((name, START + timedelta(hours=h), float(round(load, 3))))
    demand = spark.createDataFrame(rows, "respondent string, period_utc timestamp, demand_mwh double")
    weather = spark.createDataFrame(
        [(START + timedelta(hours=h), float(warm[h])) for h in range(hours)],
        "period_utc timestamp, temperature_c double",
    )
    return demand, weather, {(n, t): v for n, t, v in rows}, {START + timedelta(hours=h): warm[h] for h in range(hours)}


def test_backtest_equals_a_fit_at_every_origin(spark):
    demand, weather, load, warm = hourly(spark)
    origin, step = START + timedelta(days=15), 96
    got = insights.backtest_demand(demand, origin, weather, (24, 48), step_hours=step).collect()

    def features(name, t):
        values = [load.get((name, t - timedelta(hours=h))) for h in (24, 48)]
        return None if None in values else [1.0, *values, float(warm[t])]

    errors: dict = {}
    for name in ("A", "B"):
        at = origin
        while at < START + timedelta(days=40):
            train = [(features(n, t), v) for (n, t), v in load.items() if n == name and t <= at]
            train = [(x, v) for x, v in train if x]
            fit = np.linalg.lstsq(np.array([x for x, _ in train]), np.array([v for _, v in train]), rcond=None)[0]
            mean = np.mean([v for _, v in train])
            for ahead in range(1, 25):
                t = at + timedelta(hours=ahead)
                if (name, t) in load:
                    x = features(name, t)
                    guess = np.dot(fit, x) if x else mean
                    errors.setdefault((name, ahead), []).append(guess - load[name, t])
            at += timedelta(hours=step)
    assert {(r["respondent"], r["hours_ahead"]) for r in got} == set(errors)
    for r in got:
        e = np.array(errors[r["respondent"], r["hours_ahead"]])
        assert r["hours"] == len(e) == r["modelled"]
        assert r["bias"] == pytest.approx(e.mean(), abs=2e-3)
        assert r["mean_abs_error"] == pytest.approx(abs(e).mean(), abs=2e-3)
        assert r["rms_error"] == pytest.approx(np.sqrt((e**2).mean()), abs=2e-3)
    # The weather is no part of yesterday's load, so the model must beat repeating it.
    assert np.mean([r["mean_abs_error"] for r in got]) < np.mean([r["naive_abs_error"] for r in got])


def test_forecast_without_history_or_regressors(spark):
    demand, weather, *_ = hourly(spark, hours=24 * 10)
    cut = START + timedelta(days=8)
    late = spark.createDataFrame([("new", cut + timedelta(hours=5), 7.0)], demand.schema)
    out = insights.regress_demand(demand.union(late), cut, weather, (24, 48)).collect()
    assert all(r["period_utc"] > cut for r in out)
    assert [r["forecast_mwh"] for r in out if r["respondent"] == "new"] == [None]
    assert all(r["forecast_mwh"] is not None for r in out if r["respondent"] != "new")


def test_origins_do_not_multiply_the_scan(spark):
    demand, weather, *_ = hourly(spark, hours=24 * 4)
    plan = insights.backtest_demand(demand, START, weather, (24,), step_hours=24)._jdf.queryExecution().optimizedPlan()
    assert "CartesianProduct" not in plan.toString() and "Join Cross" not in plan.toString()
