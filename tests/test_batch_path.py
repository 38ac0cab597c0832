"""Bronze landing, silver merging, gold building and their idempotence."""

import json
import os

import pytest
from pyspark.sql import functions as F

from wattline.operators import contracts, storage, upsert, versions
from wattline.operators.contracts import validate
from wattline.operators.dedup import latest_per_key, prefer_first
from wattline.operators.quality import QualityError
from wattline.plans import bronze, gold, medallion, silver
from wattline.sources import payloads, tables, watermarks

AS_OF = "2024-03-02 06:00:00"


def put(folder, *bodies):
    os.makedirs(folder, exist_ok=True)
    start = len(os.listdir(folder))
    for i, body in enumerate(bodies):
        with open(f"{folder}/page{start + i}.json", "w") as f:
            json.dump(body, f)


def eia(*rows):
    return {"response": {"total": len(rows), "data": list(rows)}}


def demand_row(hour, value, day="2024-03-01", respondent="ERCO"):
    return {"period": f"{day}T{hour:02d}", "respondent": respondent, "type": "D", "value": value}


def load(spark, base, as_of=AS_OF):
    return bronze.eia(
        spark, f"{base}/in", "demand", f"{base}/bronze", f"{base}/marks", as_of
    )


def landed(spark, base):
    return tables.read_table(spark, f"{base}/bronze", medallion.BRONZE_SCHEMAS["demand"])


def test_landing_stamps_rows_and_moves_the_mark(spark, tmp_path, rows):
    base = str(tmp_path)
    put(f"{base}/in", eia(demand_row(0, 100), demand_row(1, 200)), eia(demand_row(5, 300)))
    assert load(spark, base) == 3
    assert watermarks.read_watermark(spark, f"{base}/marks", "eia_demand") == "2024-03-01T05"
    assert rows(landed(spark, base).select("load_date").distinct().select(F.col("load_date").cast("string"))) == [
        ("2024-03-02",)
    ]


def test_empty_load_leaves_the_mark(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in", eia())
    assert load(spark, base) == 0
    assert watermarks.read_watermark(spark, f"{base}/marks", "eia_demand") is None
    watermarks.write_watermark(spark, f"{base}/marks", "eia_demand", "2024-03-01T00", AS_OF)
    assert load(spark, base) == 0
    assert watermarks.read_watermark(spark, f"{base}/marks", "eia_demand") == "2024-03-01T00"


def test_next_load_starts_at_the_mark(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in", eia(*[demand_row(h, h) for h in range(6)]))
    watermarks.write_watermark(spark, f"{base}/marks", "eia_demand", "2024-03-01T04", AS_OF)
    assert load(spark, base) == 2  # hours 4 (read again) and 5


def test_first_load_looks_back_two_days_and_lags_an_hour(spark, tmp_path, rows):
    base = str(tmp_path)
    put(
        f"{base}/in",
        eia(
            demand_row(5, 1, day="2024-02-29"),
            demand_row(6, 2, day="2024-02-29"),
            demand_row(5, 3, day="2024-03-02"),
            demand_row(6, 4, day="2024-03-02"),
        ),
    )
    load(spark, base)
    assert rows(landed(spark, base), "value") == [(2.0,), (3.0,)]


def test_ranges():
    assert watermarks.next_range(watermarks.EIA, "2024-03-02T05", AS_OF) is None
    assert watermarks.next_range(watermarks.CARBON, "2024-03-02T06:00Z", AS_OF) is None
    start, end = watermarks.next_range(watermarks.WEATHER, "2024-02-27T23:00", AS_OF)
    assert (str(start), str(end)) == ("2024-02-27 00:00:00", "2024-03-03 23:59:00")
    start, _ = watermarks.next_range(watermarks.WEATHER, None, AS_OF)
    assert str(start) == "2024-02-28 00:00:00"


def test_marks_of_feeds_are_apart_and_the_latest_counts(spark, folder):
    path = folder("marks")
    watermarks.write_watermark(spark, path, "a", "1", "2024-01-01")
    watermarks.write_watermark(spark, path, "b", "7", "2024-01-01")
    watermarks.write_watermark(spark, path, "a", "2", "2024-01-02")
    assert watermarks.read_watermark(spark, path, "a") == "2"
    assert watermarks.read_watermark(spark, path, "b") == "7"
    assert watermarks.read_watermark(spark, path, "c") is None


def hourly(*rows):
    names = ("time", "temperature_2m", "wind_speed_10m", "precipitation", "weather_code")
    return {"hourly": {n: [r[i] for r in rows] for i, n in enumerate(names)}}


def test_archived_weather_wins_and_the_mark_stops_at_now(spark, tmp_path, rows):
    base = str(tmp_path)
    put(f"{base}/archive", hourly(("2024-03-01T23:00", 10.0, 1.0, 0.0, 1)))
    put(
        f"{base}/forecast",
        hourly(
            ("2024-03-01T23:00", 99.0, 1.0, 0.0, 1),
            ("2024-03-02T12:00", 12.0, 1.0, 0.0, 1),
        ),
    )
    count = bronze.weather(
        spark, f"{base}/archive", f"{base}/forecast", f"{base}/bronze", f"{base}/marks", AS_OF
    )
    assert count == 2
    stored = tables.read_table(spark, f"{base}/bronze", medallion.BRONZE_SCHEMAS["weather"])
    assert rows(stored, "time", "temperature_2m") == [
        ("2024-03-01T23:00", 10.0),
        ("2024-03-02T12:00", 12.0),
    ]
    assert watermarks.read_watermark(spark, f"{base}/marks", "weather") == "2024-03-02T06:00"


def test_bad_record_halts_the_load(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in", eia(demand_row(0, 100), demand_row(1, "broken")))
    with pytest.raises(Exception, match="contract violated"):
        load(spark, base)
    assert watermarks.read_watermark(spark, f"{base}/marks", "eia_demand") is None
    assert not storage.is_complete(spark, f"{base}/bronze")


def test_bad_record_of_an_old_page_does_not_block(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in", eia(demand_row(0, "broken"), demand_row(5, 300)))
    watermarks.write_watermark(spark, f"{base}/marks", "eia_demand", "2024-03-01T04", AS_OF)
    assert load(spark, base) == 1


def test_record_without_a_time_halts_the_load(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/in", eia(demand_row(0, 100), {"respondent": "ERCO", "type": "D", "value": 1}))
    with pytest.raises(Exception, match="period: missing"):
        load(spark, base)


# ---- dedup and upsert -------------------------------------------------------------

BRONZE = "period string, respondent string, respondent_name string, value string, _ingested_at timestamp"


def bronze_rows(spark, *rows):
    from datetime import datetime

    return spark.createDataFrame(
        [(p, r, n, v, datetime(2024, 3, 2, h)) for p, r, n, v, h in rows], BRONZE
    )


def test_silver_drops_unreadable_rows_before_choosing_the_latest(spark, rows):
    df = bronze_rows(
        spark,
        ("2024-03-01T00", "ERCO", "old", "100", 1),
        ("2024-03-01T00", "ERCO", "new", "110", 2),
        ("2024-03-01T00", "ERCO", "bad", "n/a", 3),
        ("sometime", "ERCO", "bad", "1", 3),
    )
    assert rows(silver.demand(df, AS_OF), "respondent_name", "demand_mwh", "demand_mw") == [
        ("new", 110.0, 110.0)
    ]


def test_ties_are_broken_by_the_rows_alone(spark, rows):
    data = [("2024-03-01T00", "ERCO", n, v, 1) for n, v in (("a", "1"), ("b", "3"), ("b", "2"))]
    forward = silver.demand(bronze_rows(spark, *data), AS_OF)
    backward = silver.demand(bronze_rows(spark, *data[::-1]).repartition(3), AS_OF)
    assert rows(forward) == rows(backward)
    assert rows(forward, "demand_mwh") == [(3.0,)]


def test_generation_labels(spark, rows):
    df = bronze_rows(spark, ("2024-03-01T00", "ERCO", "x", "5", 1)).select(
        "*", F.explode(F.array(F.lit("SUN"), F.lit("GEO"), F.lit("??"))).alias("fuel_type")
    )
    assert rows(silver.generation(df, AS_OF), "fuel_type", "fuel_type_label") == [
        ("??", "??"),
        ("GEO", "GEO"),
        ("SUN", "Solar"),
    ]


CARBON = "from string, to string, intensity_index string, intensity_actual double, intensity_forecast double, _ingested_at timestamp"


def test_carbon_prefers_the_measured_value(spark, rows):
    from datetime import datetime

    at = datetime(2024, 3, 2)
    slot = lambda h: (f"2024-03-01T{h:02d}:00Z", f"2024-03-01T{h:02d}:30Z", "low")
    df = spark.createDataFrame(
        [
            (*slot(0), 120.0, 130.0, at),
            (*slot(1), None, 140.0, at),
            (*slot(2), float("nan"), 150.0, at),
            (*slot(3), None, None, at),
        ],
        CARBON,
    )
    out = silver.carbon(df, AS_OF)
    assert rows(out, "intensity_gco2_kwh", "is_estimated", "duration_minutes") == [
        (120.0, False, 30.0),
        (140.0, True, 30.0),
        (150.0, True, 30.0),
    ]


def test_prefer_first_ignores_arrival(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 0, 9), ("b", 1, 7)], "k string, rank int, v int")
    assert rows(prefer_first(df, ["k"], "rank"), "k", "v") == [("a", 9), ("b", 7)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("at")
    )
    out = latest_per_key(df, ["k"], newest="at")
    plan = out._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange hashpartitioning") < partial
    assert out.filter("k = -1").first()["at"] == 19_998
    assert out.count() == df.select("k").distinct().count()


def test_upsert(spark, rows):
    schema = "k string, part string, v int"
    target = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), (None, "x", 3)], schema)
    source = spark.createDataFrame([("b", "x", 20), ("c", "x", 30), (None, "x", 40)], schema)
    merged = upsert.upsert(target, source, ["k", "part"])
    assert rows(merged, "k", "v") == [("a", 1), ("b", 20), ("c", 30), (None, 40)]
    assert rows(upsert.upsert(merged, source, ["k", "part"])) == rows(merged)
    empty = spark.createDataFrame([], schema)
    assert rows(upsert.upsert(empty, source, ["k", "part"])) == rows(source)
    assert rows(upsert.upsert(target, empty, ["k", "part"])) == rows(target)


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string, month int")


def merge(spark, path, *rows):
    upsert.merge_table(spark, path, keyed(spark, *rows), ["k"], "month")


def files_named(spark, path):
    """Folders that the table's newest pointer names, with their files."""
    at = versions.pointer(spark, path)
    return {
        f"{versions.folder(path, n)}/{name}/{f}"
        for name, n in at.folders.items()
        for f in os.listdir(f"{versions.folder(path, n)}/{name}")
        if f.endswith(".parquet")
    }


def test_merge_table_touches_only_named_partitions(spark, folder, rows):
    path = folder("t")
    merge(spark, path, (1, "a", 1), (2, "a", 1), (3, "a", 2))
    untouched = {f for f in files_named(spark, path) if "month=2" in f}
    merge(spark, path, (2, "b", 1), (4, "b", 3))
    assert rows(upsert.read_merged(spark, path), "k", "v") == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]
    assert {f for f in files_named(spark, path) if "month=2" in f} == untouched
    merge(spark, path, (2, "b", 1), (4, "b", 3))
    assert rows(upsert.read_merged(spark, path), "k", "v") == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]


def test_a_merge_that_dies_changes_nothing(spark, folder, rows, monkeypatch):
    path = folder("t")
    merge(spark, path, (1, "a", 1), (2, "a", 2))

    def dies(*args):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(storage, "write_text_once", dies)
        with pytest.raises(OSError):
            merge(spark, path, (1, "b", 1), (2, "b", 2))
    assert rows(upsert.read_merged(spark, path), "k", "v") == [(1, "a"), (2, "a")]
    merge(spark, path, (3, "c", 3))
    assert rows(upsert.read_merged(spark, path), "k", "v") == [(1, "a"), (2, "a"), (3, "c")]


def test_a_reader_during_a_merge_sees_the_table_before_it(spark, folder, rows):
    path = folder("t")
    merge(spark, path, (1, "a", 1), (2, "a", 2))
    before = upsert.read_merged(spark, path)
    merge(spark, path, (1, "b", 1), (3, "b", 3))
    versions.vacuum(spark, path)
    assert rows(before, "k", "v") == [(1, "a"), (2, "a")]
    assert rows(upsert.read_merged(spark, path), "k", "v") == [(1, "b"), (2, "a"), (3, "b")]
    merge(spark, path, (1, "c", 1))
    versions.vacuum(spark, path)
    assert not os.path.exists(f"{versions.folder(path, 1)}/month=1")
    assert rows(upsert.read_merged(spark, path), "k", "v") == [(1, "c"), (2, "a"), (3, "b")]


def test_two_writers_of_one_number(spark, folder, rows):
    path = folder("t")
    merge(spark, path, (1, "a", 1))
    base = versions.pointer(spark, path)
    merge(spark, path, (2, "b", 1))
    with pytest.raises(RuntimeError, match="another writer"):
        versions.commit(spark, path, base, keyed(spark, (9, "z", 1)), "month")
    with pytest.raises(Exception, match="exist"):
        storage.write_text_once(spark, f"{path}/_commits/{2:020d}.json", "{}")
    assert rows(upsert.read_merged(spark, path), "k", "v") == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("months", [3, 150])
def test_merge_keeps_untouched_rows_of_the_null_partition(spark, folder, rows, months):
    path = folder("t")
    first = [(k, "a", k % months if k % 4 else None) for k in range(400)]
    second = [(k, "b", k % months if k % 4 else None) for k in range(0, 400, 6)]
    merge(spark, path, *first)
    merge(spark, path, *second)
    expected = {k: v for k, v, _ in first} | {k: v for k, v, _ in second}
    assert rows(upsert.read_merged(spark, path), "k", "v") == sorted(expected.items(), key=str)


def test_merge_of_only_null_or_no_rows(spark, folder, rows):
    path = folder("t")
    merge(spark, path, (1, "a", 1), (2, "a", None))
    merge(spark, path, (3, "b", None))
    merge(spark, path, *[(9, "z", 1)][:0])
    assert rows(upsert.read_merged(spark, path), "k", "v") == [(1, "a"), (2, "a"), (3, "b")]


# ---- gold ---------------------------------------------------------------------------


def test_dim_date_spans_start_to_a_year_ahead(spark):
    dates = gold.dim_date(spark, "2024-01-01 10:00:00", "2023-01-01")
    assert dates.count() == 731
    assert dates.filter("is_today").collect()[0]["date_key"] == 20240101
    row = dates.filter("date_key = 20240106").first()
    assert (row["day_name"], row["day_of_week"], row["is_weekend"]) == ("Saturday", 7, True)
    assert (row["month_name"], row["year_month"], row["quarter"]) == ("January", "2024-01", 1)


def test_seed_dimensions(spark):
    regions = {r["respondent_code"]: r["region_key"] for r in gold.dim_region(spark).collect()}
    assert sorted(regions, key=regions.get) == sorted(regions) and len(regions) == 9
    fuels = {r["fuel_type_code"]: r for r in gold.dim_fuel_type(spark).collect()}
    assert sorted(r["fuel_type_key"] for r in fuels.values()) == list(range(1, 12))
    assert fuels["BIO"]["is_renewable"] and not fuels["BIO"]["is_low_carbon"]
    assert fuels["NUC"]["is_low_carbon"] and not fuels["NUC"]["is_renewable"]


def test_facts_keep_rows_without_members(spark, rows):
    df = bronze_rows(spark, ("2024-03-01T00", "NOWHERE", "x", "1000", 1)).withColumn(
        "fuel_type", F.lit("??")
    )
    dates, regions = gold.dim_date(spark, AS_OF), gold.dim_region(spark)
    demand = gold.fact_demand(
        gold.stage_demand(silver.demand(df, AS_OF)), dates, regions, AS_OF
    )
    assert rows(demand, "date_key", "region_key") == [(20240301, None)]
    generation = gold.fact_generation(
        gold.stage_generation(silver.generation(df, AS_OF)),
        dates,
        regions,
        gold.dim_fuel_type(spark),
        AS_OF,
    )
    assert rows(generation, "fuel_type_key", "estimated_co2_tonnes", "is_renewable") == [
        (None, 0.0, False)
    ]


def test_new_respondents_extend_the_dimension(spark):
    seen = spark.createDataFrame([("ZZ",), ("AA",), ("ZZ",), ("GB",), (None,)], "code string")
    out = gold.extend_regions(gold.dim_region(spark), seen, "code")
    added = {r["respondent_code"]: r["region_key"] for r in out.collect() if r["country"] == "Unknown"}
    assert added == {"AA": 10, "ZZ": 11}


def test_incremental_fact_takes_only_newer_rows(spark, rows):
    dates, regions = gold.dim_date(spark, AS_OF), gold.dim_region(spark)

    def staged(value, when):
        df = bronze_rows(spark, ("2024-03-01T00", "ERCO", "x", value, 1))
        return gold.stage_demand(silver.demand(df, when))

    fact = gold.fact_demand(staged("1", "2024-03-02"), dates, regions, "2024-03-02")
    assert gold.not_yet_loaded(staged("2", "2024-03-02"), fact).count() == 0
    fresh = gold.not_yet_loaded(staged("2", "2024-03-03"), fact)
    built = gold.fact_demand(fresh, dates, regions, "2024-03-03")
    merged = gold.incremental_fact(fact, built, "demand_key")
    assert rows(merged, "demand_mwh") == [(2.0,)]
    assert gold.not_yet_loaded(staged("2", "1950-01-01"), fact.filter("false")).count() == 1


# ---- the whole path -------------------------------------------------------------------


def test_loading_twice_equals_loading_once(spark, tmp_path, rows):
    base = str(tmp_path)
    paths = medallion.Paths(f"{base}/in", f"{base}/lake")
    put(paths.payload("demand"), eia(demand_row(0, 100), demand_row(1, 200, respondent="XX")))
    put(
        paths.payload("generation"),
        eia({"period": "2024-03-01T00", "respondent": "ERCO", "fueltype": "NG", "value": 2000}),
    )
    put(
        paths.payload("carbon"),
        {
            "data": [
                {
                    "from": "2024-03-01T00:00Z",
                    "to": "2024-03-01T00:30Z",
                    "intensity": {"actual": None, "forecast": 90, "index": "low"},
                }
            ]
        },
    )
    put(paths.payload("weather_archive"), hourly(("2024-03-01T00:00", 10.0, 1.0, 0.0, 1)))
    put(paths.payload("weather_forecast"), hourly(("2024-03-02T12:00", None, 1.0, 0.0, None)))

    checks = medallion.run(spark, paths, AS_OF)
    assert checks.count() == 55
    assert {r["status"] for r in checks.collect()} == {"pass"}
    names = ("fact_demand", "fact_generation", "fact_carbon_intensity", "fact_weather")

    def facts():
        return {
            n: rows(gold.read_fact(spark, paths.table("gold", n)).drop("_loaded_at"))
            for n in names
        }

    once = facts()
    assert [len(once[n]) for n in names] == [2, 1, 1, 2]
    assert once["fact_generation"][0][10] == 980.0

    later = "2024-03-02 07:00:00"
    medallion.ingest(spark, paths, later)
    medallion.cleanse(spark, paths, later, since_load="2024-03-02")
    medallion.model(spark, paths, later)
    assert facts() == once
    assert medallion.read_bronze(spark, paths, "demand").count() == 3  # the boundary hour again


def test_second_run_rewrites_only_touched_months(spark, tmp_path, rows):
    base = str(tmp_path)
    paths = medallion.Paths(f"{base}/in", f"{base}/lake")
    first, second = "2024-03-02 06:00:00", "2024-04-01 06:00:00"
    put(paths.payload("demand"), eia(demand_row(0, 100, "2024-02-29"), demand_row(1, 200)))
    for name, body in (
        ("generation", eia({"period": "2024-03-01T00", "respondent": "ERCO", "fueltype": "NG", "value": 20})),
        ("carbon", {"data": []}),
        ("weather_archive", hourly(("2024-03-01T00:00", 10.0, 1.0, 0.0, 1))),
        ("weather_forecast", hourly()),
    ):
        put(paths.payload(name), body)
    watermarks.write_watermark(spark, paths.watermarks, "eia_demand", "2024-02-01T00", "2024-02-01 00:00:00")
    medallion.run(spark, paths, first)
    old = {layer: files_named(spark, f"{base}/lake/{layer}/{name}") for layer, name in (("silver", "demand"), ("gold", "fact_demand"))}
    put(paths.payload("demand"), eia(demand_row(1, 250), demand_row(5, 300, "2024-03-31")))
    medallion.run(spark, paths, second)
    for layer, name in (("silver", "demand"), ("gold", "fact_demand")):
        kept = old[layer] & files_named(spark, f"{base}/lake/{layer}/{name}")
        assert kept and all("period_month=202402" in f for f in kept), layer
    fact = gold.read_fact(spark, paths.table("gold", "fact_demand"))
    assert sorted(r["demand_mwh"] for r in fact.collect()) == [100.0, 250.0, 300.0]
    stamps = {str(r["_loaded_at"]) for r in fact.where("demand_mwh = 100").collect()}
    assert stamps == {first}
    before = files_named(spark, f"{base}/lake/silver/demand")
    medallion.cleanse(spark, paths, "2024-04-02 06:00:00")  # all loads again change nothing
    assert files_named(spark, f"{base}/lake/silver/demand") == before


def test_silver_loads_reach_the_facts_at_any_time(spark, tmp_path, rows):
    base = str(tmp_path)
    paths = medallion.Paths(f"{base}/in", f"{base}/lake")
    months = ("2024-03-01", "2024-03-01", "2024-02-01", "2024-04-01")
    moments = ("2024-05-02 06:00:00", "2024-05-02 06:00:00", "2024-04-20 06:00:00", "2024-05-03 06:00:00")
    for n, (day, as_of) in enumerate(zip(months, moments), 1):
        put(f"{base}/load{n}", eia(demand_row(n, 100 + n, day)))
        delivered = payloads.read_eia(spark, f"{base}/load{n}", "demand")
        tables.land_bronze(contracts_of(delivered), paths.table("bronze", "demand"), as_of)
        medallion.cleanse(spark, paths, as_of, only_new=True)
        medallion.model(spark, paths, as_of, gate=False)
        for name, path in (("silver", "demand"), ("gold", "fact_demand")):
            assert upsert.read_merged(spark, paths.table(name, path)).count() == n, (n, name)
    number = versions.pointer(spark, paths.table("gold", "fact_demand")).number
    medallion.cleanse(spark, paths, moments[-1], only_new=True)
    medallion.model(spark, paths, moments[-1], gate=False)
    assert versions.pointer(spark, paths.table("gold", "fact_demand")).number == number


def test_a_fact_that_failed_takes_its_rows_later(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    paths = medallion.Paths(f"{base}/in", f"{base}/lake")
    put(f"{base}/load", eia(demand_row(1, 100)))
    delivered = payloads.read_eia(spark, f"{base}/load", "demand")
    tables.land_bronze(contracts_of(delivered), paths.table("bronze", "demand"), AS_OF)
    medallion.cleanse(spark, paths, AS_OF, only_new=True)

    def dies(*args):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(gold, "merge_fact", dies)
        with pytest.raises(OSError):
            medallion.model(spark, paths, AS_OF, gate=False)
    medallion.cleanse(spark, paths, AS_OF, only_new=True)
    medallion.model(spark, paths, AS_OF, gate=False)
    assert gold.read_fact(spark, paths.table("gold", "fact_demand")).count() == 1


def contracts_of(rows):
    return validate(rows, contracts.EIA_DEMAND)


def test_run_stops_at_a_fact_that_fails_its_checks(spark, tmp_path):
    base = str(tmp_path)
    paths = medallion.Paths(f"{base}/in", f"{base}/lake")
    put(paths.payload("demand"), eia(demand_row(0, 100)))
    put(paths.payload("generation"), eia())
    put(paths.payload("carbon"), {"data": []})
    put(paths.payload("weather_archive"), hourly(("2024-03-01T00:00", 10.0, 1.0, 0.0, 1)))
    put(paths.payload("weather_forecast"), hourly())
    with pytest.raises(QualityError, match="fact_demand.date_key"):
        medallion.run(spark, paths, AS_OF, start="2024-03-02")  # the calendar begins too late
    assert not os.path.exists(paths.table("gold", "fact_demand"))
    medallion.run(spark, paths, AS_OF)
    assert gold.read_fact(spark, paths.table("gold", "fact_demand")).count() == 1


def test_unreadable_period_lands_and_does_not_move_the_mark(spark, tmp_path, rows):
    base = str(tmp_path)
    bad = demand_row(0, 1) | {"period": "zzz"}
    put(f"{base}/in", eia(demand_row(0, 100), bad))
    assert load(spark, base) == 2
    assert rows(landed(spark, base), "period") == [("2024-03-01T00",), ("zzz",)]
    assert watermarks.read_watermark(spark, f"{base}/marks", "eia_demand") == "2024-03-01T00"


def carbon_slot(start, end, actual):
    return {"from": f"2024-03-02T{start}Z", "to": f"2024-03-02T{end}Z",
            "intensity": {"actual": actual, "forecast": 90, "index": "low"}}


def test_an_estimate_is_replaced_by_the_measurement(spark, tmp_path, rows):
    base = str(tmp_path)

    def load_carbon(as_of):
        bronze.carbon(spark, f"{base}/in", f"{base}/bronze", f"{base}/marks", as_of)
        landed_rows = tables.read_table(spark, f"{base}/bronze", medallion.BRONZE_SCHEMAS["carbon"])
        return rows(silver.carbon(landed_rows, as_of), "intensity_gco2_kwh", "is_estimated")

    put(f"{base}/in", {"data": [carbon_slot("05:00", "05:30", 120), carbon_slot("05:30", "06:00", None)]})
    assert load_carbon("2024-03-02 05:45:00") == [(120.0, False), (90.0, True)]
    assert watermarks.read_watermark(spark, f"{base}/marks", "carbon_intensity") == "2024-03-02T05:30Z"
    put(f"{base}/in", {"data": [carbon_slot("05:30", "06:00", 140), carbon_slot("06:00", "06:30", 150)]})
    os.remove(f"{base}/in/page0.json")
    assert load_carbon("2024-03-02 06:45:00") == [(120.0, False), (140.0, False), (150.0, False)]


def test_full_refresh_forgets_rows_gone_from_bronze(spark, folder, rows):
    first = bronze_rows(spark, ("2024-03-01T00", "ERCO", "x", "1", 1))
    second = bronze_rows(spark, ("2024-03-01T01", "ERCO", "x", "2", 1))
    path = folder("silver")
    silver.merge(spark, "demand", first, path, AS_OF)
    silver.merge(spark, "demand", second, path, AS_OF)
    assert silver.read(spark, path).count() == 2
    silver.refresh("demand", second, path, AS_OF)
    assert rows(silver.read(spark, path), "demand_mwh") == [(2.0,)]


def test_catalog_table_and_view(spark):
    df = gold.dim_region(spark)
    tables.save_as_table(df, "regions_saved")
    assert spark.table("regions_saved").count() == 9
    tables.as_view(df, "regions_view")
    assert spark.sql("select count(*) from regions_view").first()[0] == 9
    spark.sql("drop table regions_saved")
