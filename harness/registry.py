"""Every query with its DuckDB counterpart.

Names say what a query answers. The widths of time ranges span the whole event
table here, because the given events are sparse; the library's defaults are the
operating values and are covered by the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import lenses
from harness.lenses import AS_OF, FIRST_DAY, WHOLE_SPAN, portable, table
from harness.oracle import CTES, RAW_PROMISES, TS, checks_sql, sql
from wattline.functions.measures import at_least_zero
from wattline.functions.time import newer_than, parse_hour
from wattline.operators import access, asof, contracts, history, quality, retention, storage
from wattline.operators.contracts import inspect, validate
from wattline.operators.dedup import latest_per_key
from wattline.operators.storage import cut_lineage
from wattline.operators.upsert import merge_table, read_merged, upsert
from wattline.plans import bronze, expectations, gold, insights, medallion, monitor, silver
from wattline.session import use_utc
from wattline.sources import events as event_source
from wattline.sources import deliveries, payloads, tables, watermarks
from wattline.streaming import alerts, ingest, keyed, overlay, rollup

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(use_utc(spark), sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


_events = lenses.grid_events
RECENT = f'"timestamp" > {TS} - interval 31 day'
SYNTHETIC = f"{RECENT} and source = 'synthetic'"
CARBON = f"{RECENT} and source = 'carbonintensity.org.uk'"
FIVE = 'time_bucket(interval 5 minute, "timestamp") as "timestamp"'
HALF_HOUR = 'time_bucket(interval 30 minute, "timestamp") as "timestamp"'

# ---- monitoring -----------------------------------------------------------------


@query("five_minute_rollup", sql("select * from rollup"))
def _(spark, sf):
    return monitor.five_minute_rollup(_events(spark, sf))


@query("total_events", sql("select count(*) as event_count from grid_events"))
def _(spark, sf):
    return monitor.total_events(_events(spark, sf))


@query(
    "latest_events",
    sql("""select "timestamp", region, source, demand_mw, carbon_intensity_gco2_kwh
           from grid_events order by "timestamp" desc, event_id desc limit 100"""),
)
def _(spark, sf):
    return monitor.latest_events(_events(spark, sf))


@query(
    "event_counts",
    sql(f"""select source, region, count(*) as event_count from grid_events
            where {RECENT} group by all"""),
)
def _(spark, sf):
    return monitor.event_counts(_events(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "freshness",
    sql(f"""select region, source, max("timestamp") as last_event,
                   cast(epoch({TS}) - floor(epoch(max("timestamp"))) as bigint)
                       as staleness_seconds,
                   count(*) as event_count
            from grid_events group by region, source"""),
)
def _(spark, sf):
    return monitor.freshness(_events(spark, sf), AS_OF)


@query(
    "live_demand",
    sql(f"""select region, {FIVE}, avg(demand_mw) as avg_demand_mw,
                   max(demand_mw) as max_demand_mw, min(demand_mw) as min_demand_mw
            from grid_events where {SYNTHETIC} group by all"""),
)
def _(spark, sf):
    return monitor.live_demand(_events(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "generation_balance",
    sql(f"""select *, avg_generation - avg_demand as balance_mw
            from (select {FIVE}, region, avg(demand_mw) as avg_demand,
                         avg(generation_mw) as avg_generation
                  from grid_events where {SYNTHETIC} group by all)"""),
)
def _(spark, sf):
    return monitor.generation_balance(_events(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "demand_hourly",
    sql(f"""select time_bucket(interval 1 hour, "timestamp") as "timestamp",
                   avg(demand_mw) as avg_demand_mw
            from grid_events where {SYNTHETIC} and region = 'ERCOT' group by all"""),
)
def _(spark, sf):
    return monitor.demand_hourly(_events(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "intensity_series",
    sql(f"""select "timestamp", carbon_intensity_gco2_kwh from grid_events where {CARBON}"""),
)
def _(spark, sf):
    return monitor.intensity_series(_events(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "intensity_demand_overlay",
    sql(f"""select c."timestamp", avg_ci, avg_demand
            from (select {HALF_HOUR}, avg(carbon_intensity_gco2_kwh) as avg_ci
                  from grid_events where {CARBON} group by all) c
            left join (select {HALF_HOUR}, avg(demand_mw) as avg_demand
                  from grid_events where {SYNTHETIC} and region = 'ERCOT' group by all) d
            on c."timestamp" = d."timestamp" """),
)
def _(spark, sf):
    return monitor.intensity_demand_overlay(_events(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "low_carbon_windows",
    sql(f"""select {HALF_HOUR}, avg(carbon_intensity_gco2_kwh) as avg_ci,
                   'low-carbon window' as label
            from grid_events where {CARBON} group by 1
            having avg(carbon_intensity_gco2_kwh) < 150"""),
)
def _(spark, sf):
    return monitor.low_carbon_windows(_events(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "alert_demand_spike",
    sql(f"""select max(demand_mw) as max_demand_mw, 'ERCOT demand spike' as alert
            from grid_events where {SYNTHETIC} and region = 'ERCOT'
            having max(demand_mw) > 50000"""),
)
def _(spark, sf):
    return monitor.alert_demand_spike(_events(spark, sf), AS_OF, WHOLE_SPAN, limit=50_000)


@query(
    "alert_high_intensity",
    sql(f"""select avg(carbon_intensity_gco2_kwh) as avg_ci,
                   'GB carbon intensity high' as alert
            from grid_events where {CARBON} having avg(carbon_intensity_gco2_kwh) > 120"""),
)
def _(spark, sf):
    return monitor.alert_high_intensity(_events(spark, sf), AS_OF, WHOLE_SPAN, limit=120)


@query(
    "alert_silence",
    sql(f"""select max("timestamp") as last_event, 'producer silence' as alert
            from grid_events having date_diff('second', max("timestamp"), {TS}) > 30"""),
)
def _(spark, sf):
    return monitor.alert_silence(_events(spark, sf), AS_OF, seconds=30)


def _rollup(spark, sf):
    return monitor.five_minute_rollup(_events(spark, sf))


@query("tile_recent_rollup", sql(f"select * from rollup where {RECENT}"))
def _(spark, sf):
    return monitor.tile_recent(_rollup(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "tile_max_demand",
    sql(f"""select "timestamp", max_demand_mw from rollup
            where {SYNTHETIC} and region = 'ERCOT'"""),
)
def _(spark, sf):
    return monitor.tile_max_demand(_rollup(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "tile_intensity_trend",
    sql(f"""select "timestamp", avg_carbon_intensity from rollup where {CARBON}"""),
)
def _(spark, sf):
    return monitor.tile_intensity_trend(_rollup(spark, sf), AS_OF, WHOLE_SPAN)


@query(
    "demand_outliers",
    sql(f"""select "timestamp", region, demand_mw, round(z, 6) as z_score
            from (select e.*, (demand_mw - m) / s as z from grid_events e
                  join (select region, avg(demand_mw) as m, stddev_samp(demand_mw) as s
                        from grid_events where {SYNTHETIC} group by region) using (region)
                  where {SYNTHETIC})
            where abs(z) > 2"""),
)
def _(spark, sf):
    found = monitor.zscore_outliers(
        _events(spark, sf), AS_OF, base=WHOLE_SPAN, recent=WHOLE_SPAN
    )
    return found.withColumn("z_score", F.round("z_score", 6))


ALERT_COLUMNS = 'rule, event_id, region, source, "timestamp", value, subject'
LOW_RULES = (
    alerts.Rule(
        alerts.DEMAND_SPIKE.name,
        alerts.DEMAND_SPIKE.column,
        35_000,
        alerts.DEMAND_SPIKE.subject,
        region="ERCOT",
        source=event_source.SYNTHETIC_SOURCE,
    ),
    alerts.HIGH_INTENSITY,
)


@query(
    "threshold_alerts",
    sql(f"select {ALERT_COLUMNS} from alerts", spike=60_000, high=250),
)
def _(spark, sf):
    return alerts.alert_rules(_events(spark, sf))


EDGE_ORACLE = sql(
    f"select {ALERT_COLUMNS} from alerts where previous <= threshold", spike=35_000, high=250
)


@query("rising_edge_alerts", EDGE_ORACLE)
def _(spark, sf):
    return alerts.alert_rules(_events(spark, sf), LOW_RULES, mode="edge")


@query(
    "retained_events",
    sql(f"""select * from grid_events where "timestamp" >= {TS} - interval 14 day"""),
)
def _(spark, sf):
    return retention.apply_retention(_events(spark, sf), "timestamp", AS_OF, "14 days")


MIDDLE = "2024-01-20 00:00:00"


def _stored_events(spark, sf, label: str) -> str:
    """Events as the raw stream leaves them: one folder a day."""
    path = f"{storage.work_folder(spark, label)}/events"
    events = _events(spark, sf).withColumn(retention.DAY, F.to_date("timestamp"))
    events.write.partitionBy(retention.DAY).parquet(path)
    return path


@query(
    "stored_event_counts",
    sql(f"""select source, region, count(*) as event_count from grid_events
            where "timestamp" > timestamp '{MIDDLE}' - interval 3 day group by all"""),
)
def _(spark, sf):
    """A trailing range that begins inside the data, over a table laid out by day."""
    stored = spark.read.parquet(_stored_events(spark, sf, "stored_counts"))
    return monitor.event_counts(stored, MIDDLE, "3 days")


@query(
    "stored_retention",
    sql(f"""select * from grid_events
            where cast("timestamp" as date) >= cast({TS} - interval 10 day as date)"""),
)
def _(spark, sf):
    """What is left after the expired days have been removed from storage."""
    path = _stored_events(spark, sf, "stored_retention")
    retention.drop_expired_days(spark, path, AS_OF, "10 days")
    return spark.read.parquet(path).drop(retention.DAY)


@query(
    "recent_rollup",
    sql(f"""select * from rollup where "timestamp" > timestamp '{MIDDLE}' - interval 2 day"""),
)
def _(spark, sf):
    return monitor.five_minute_rollup(
        _events(spark, sf).where(newer_than("timestamp", "2 days", MIDDLE))
    ).where(newer_than("timestamp", "2 days", MIDDLE))


# ---- sources ----------------------------------------------------------------------


@query(
    "eia_demand_payload",
    sql("""select period, respondent, respondent_name, type, type_name, value, value_units
           from bronze_demand"""),
)
def _(spark, sf):
    pages = payloads.parse_payload(lenses.demand_payloads(spark, sf), "value", "demand")
    return payloads.unwrap_eia(pages)


@query(
    "eia_generation_payload",
    sql("""select period, respondent, fuel_type, cast(null as varchar) as fuel_type_description,
                  cast(value as double) as value, value_units from bronze_generation"""),
)
def _(spark, sf):
    pages = payloads.parse_payload(lenses.generation_payloads(spark, sf), "value", "generation")
    return validate(payloads.unwrap_eia(pages), contracts.EIA_GENERATION)


@query(
    "carbon_payload",
    sql("""select "from", "to", intensity_index, intensity_actual, intensity_forecast
           from bronze_carbon"""),
)
def _(spark, sf):
    pages = payloads.parse_payload(lenses.carbon_payloads(spark, sf), "value", "carbon")
    return validate(payloads.unwrap_carbon(pages), contracts.CARBON)


@query(
    "weather_payload",
    sql("""with rows as (select *, case when weather_code % 2 = 0 then weather_code end as code
                         from bronze_weather)
           select time, temperature_2m, wind_speed_10m, precipitation, code as weather_code
           from rows
           union all
           select left(time, 11) || '12:00', 0.0::double, 0.0::double, 0.0::double, code
           from rows""").replace("\nwith rows as", ",\nrows as"),
)
def _(spark, sf):
    rows = lenses.weather_payloads(lenses.bronze_weather(spark, sf), with_gaps=True)
    pages = payloads.parse_payload(rows, "value", "weather")
    return validate(payloads.unwrap_weather(pages), contracts.WEATHER)


@query("event_json_round_trip", sql("select * from grid_events"))
def _(spark, sf):
    return event_source.parse_event_json(event_source.events_to_json(_events(spark, sf)))


@query(
    "event_json_lines",
    sql("""select '{"event_id":"' || event_id || '","region":"' || region || '","timestamp":"'
                  || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '+00:00","demand_mw":'
                  || demand_mw || ',"generation_mw":' || generation_mw
                  || ',"carbon_intensity_gco2_kwh":' || carbon_intensity_gco2_kwh
                  || ',"source":"' || source || '"}' as value
           from grid_events"""),
)
def _(spark, sf):
    return event_source.events_to_json(_events(spark, sf))


@query(
    "readings_as_events",
    sql("""select md5('carbonintensity.org.uk|' || "from" || '|' || "to") as event_id,
                  'GB' as region, strptime("from", '%Y-%m-%dT%H:%MZ') as "timestamp",
                  0.0::double as demand_mw, 0.0::double as generation_mw,
                  coalesce(nullif(intensity_actual, 0), nullif(intensity_forecast, 0), 0.0)
                      as carbon_intensity_gco2_kwh,
                  'carbonintensity.org.uk' as source
           from bronze_carbon"""),
)
def _(spark, sf):
    return event_source.readings_to_events(lenses.bronze_carbon(spark, sf))


@query(
    "newest_reading_event",
    sql("""select 'GB' as region, strptime("from", '%Y-%m-%dT%H:%MZ') as "timestamp",
                  coalesce(nullif(intensity_actual, 0), nullif(intensity_forecast, 0), 0.0)
                      as carbon_intensity_gco2_kwh
           from bronze_carbon order by "from" desc, "to" desc, _ingested_at desc limit 1"""),
)
def _(spark, sf):
    """What a poll of the newest slot reports, after repeats of a slot are settled."""
    readings = latest_per_key(
        lenses.bronze_carbon(spark, sf), ["from", "to"], tiebreak=["intensity_actual"]
    )
    return event_source.readings_to_events(event_source.newest_reading(readings)).select(
        "region", "timestamp", "carbon_intensity_gco2_kwh"
    )


@query(
    "clamped_net_demand",
    sql("""select event_id, greatest(0.0, demand_mw - generation_mw + 400) as net_mw
           from grid_events"""),
)
def _(spark, sf):
    net = F.col("demand_mw") - F.col("generation_mw") + 400
    return _events(spark, sf).select("event_id", at_least_zero(net).alias("net_mw"))


@query(
    "incremental_slice",
    sql("""select period, respondent, value from bronze_demand
           where try_strptime(period, '%Y-%m-%dT%H')
                 between timestamp '1998-06-01 00:00:00' and timestamp '2000-02-29 23:00:00'"""),
)
def _(spark, sf):
    rows = lenses.bronze_demand(spark, sf).select("period", "respondent", "value")
    return watermarks.incremental_slice(
        rows, parse_hour("period"), watermarks.EIA, "1998-06-01T00", "2000-03-01 00:00:00"
    )


@query(
    "high_watermarks",
    sql("""select 'demand' as feed, max(period) as watermark from bronze_demand_clean
           union all select 'generation', max(period) from bronze_generation
           union all select 'carbon', max("to") from bronze_carbon
           union all select 'weather', least(max(time), '2000-01-01T00:00') from bronze_weather"""),
)
def _(spark, sf):
    marks = [
        ("demand", lenses.bronze_demand(spark, sf, dirty=False), "period", None),
        ("generation", lenses.bronze_generation(spark, sf), "period", None),
        ("carbon", lenses.bronze_carbon(spark, sf), "to", None),
        ("weather", lenses.bronze_weather(spark, sf), "time", "2000-01-01T00:00"),
    ]
    rows = [
        df.agg(watermarks.high_watermark(column, limit).alias("watermark")).select(
            F.lit(feed).alias("feed"), "watermark"
        )
        for feed, df, column, limit in marks
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "weather_archive_first",
    sql("""select time, temperature_2m, wind_speed_10m, precipitation, weather_code
           from (select *, row_number() over (partition by time
                     order by load_group <> 'A', temperature_2m, wind_speed_10m, precipitation,
                              weather_code) as rn from bronze_weather)
           where rn = 1"""),
)
def _(spark, sf):
    rows = lenses.bronze_weather(spark, sf)
    archived = F.col("load_group") == "A"
    columns = contracts.WEATHER.columns
    return bronze.combine_weather(
        rows.filter(archived).select(*columns), rows.filter(~archived).select(*columns)
    )


# ---- contracts --------------------------------------------------------------------


@query(
    "contract_eia_demand",
    sql("""select period, nullif(respondent, 'XX') as respondent, respondent_name, type, type_name,
                  try_cast(value as double) as value, value_units,
                  nullif(concat_ws('; ', case when respondent = 'XX' then 'respondent: missing' end,
                      case when value = 'n/a' then 'value: not a valid double' end), '') as _reason
           from bronze_demand"""),
)
def _(spark, sf):
    rows = lenses.bronze_demand(spark, sf).withColumn(
        "respondent", F.nullif("respondent", F.lit("XX"))
    )
    return inspect(rows, contracts.EIA_DEMAND)


@query(
    "contract_eia_generation",
    sql("""select period, respondent, nullif(fuel_type, 'ZZZ') as fuel_type,
                  respondent as fuel_type_description, cast(value as double) as value,
                  'megawatthours' as value_units,
                  case when fuel_type = 'ZZZ' then 'fuel_type: missing' end as _reason
           from bronze_generation"""),
)
def _(spark, sf):
    rows = lenses.bronze_generation(spark, sf).select(
        "period",
        "respondent",
        F.nullif("fuel_type", F.lit("ZZZ")).alias("fueltype"),
        F.col("respondent").alias("fueltypeid"),
        "value",
    )
    return inspect(rows, contracts.EIA_GENERATION)


@query(
    "contract_carbon_rejects",
    sql("""select "from", "to", intensity_index, intensity_actual, intensity_forecast,
                  'intensity_forecast: missing' as _reason
           from bronze_carbon where intensity_forecast is null"""),
)
def _(spark, sf):
    return validate(lenses.bronze_carbon(spark, sf), contracts.CARBON_STRICT, mode="split")[1]


@query(
    "contract_weather",
    sql("""select time, case when weather_code <> 1 then temperature_2m end as temperature_2m,
                  wind_speed_10m, precipitation,
                  case when weather_code <> 7 then weather_code end as weather_code,
                  case when weather_code = 1 then 'temperature_2m: missing'
                       when weather_code = 7 then 'weather_code: not a valid int' end as _reason
           from bronze_weather"""),
)
def _(spark, sf):
    code = F.col("weather_code")
    rows = lenses.bronze_weather(spark, sf).select(
        "time",
        F.when(code != 1, F.col("temperature_2m")).alias("temperature_2m"),
        F.col("wind_speed_10m").cast("string").alias("wind_speed_10m"),
        "precipitation",
        F.when(code == 7, "3.5").otherwise(code.cast("string")).alias("weather_code"),
    )
    return inspect(rows, contracts.WEATHER)


@query(
    "contract_grid_event_valid",
    sql("""select event_id, region, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') as "timestamp",
                  demand_mw, generation_mw, carbon_intensity_gco2_kwh, 'synthetic' as source
           from grid_events where region <> 'GB'"""),
)
def _(spark, sf):
    """GB events carry NaN demand here and are rejected; the source is left to its default."""
    rows = _events(spark, sf).select(
        "event_id",
        "region",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(F.col("region") == "GB", F.lit("NaN").cast("double"))
        .otherwise(F.col("demand_mw"))
        .alias("demand_mw"),
        "generation_mw",
        "carbon_intensity_gco2_kwh",
    )
    return validate(rows, contracts.GRID_EVENT, mode="split")[0]


# ---- silver -----------------------------------------------------------------------


def _silver(name: str, bronze_rows: Query, **options) -> Query:
    return lambda spark, sf: silver.build(name, bronze_rows(spark, sf, **options), AS_OF)


_silver_demand = _silver("demand", lenses.bronze_demand)
_silver_generation = _silver("generation", lenses.bronze_generation)
_silver_carbon = _silver("carbon", lenses.bronze_carbon)
_silver_weather = _silver("weather", lenses.bronze_weather)

query("silver_demand", sql("select * from silver_demand"))(_silver_demand)
query("silver_generation", sql("select * from silver_generation"))(_silver_generation)
query("silver_carbon", sql("select * from silver_carbon"))(_silver_carbon)
query("silver_weather", sql("select * from silver_weather"))(_silver_weather)


def _first_load(name: str, condition: str) -> str:
    """The silver CTE ``name`` over the bronze rows that meet ``condition``."""
    source = {"silver_demand": "bronze_demand", "silver_weather": "bronze_weather"}[name]
    body = CTES[name].replace(f"from {source}", f"from (select * from {source} where {condition})")
    return body


def _two_loads(name: str, keys: str, first: str, second: str) -> str:
    joined = " and ".join(f"a.{k} is not distinct from b.{k}" for k in keys.split())
    return (
        f"select * from ({_first_load(name, second)}) union all "
        f"select * from ({_first_load(name, first)}) a where not exists "
        f"(select 1 from ({_first_load(name, second)}) b where {joined})"
    )


_DEMAND_TWO_LOADS = _two_loads(
    "silver_demand", "period_utc respondent", "load_group = 'F'", "load_group <> 'F'"
)
_IS_F = "load_group = 'F'"


@query("silver_upsert_two_loads", sql(_DEMAND_TWO_LOADS))
def _(spark, sf):
    rows = lenses.bronze_demand(spark, sf)
    first = silver.demand(rows.filter(_IS_F), AS_OF)
    second = silver.demand(rows.filter(f"not {_IS_F}"), AS_OF)
    return upsert(first, second, silver.DEMAND_KEYS)


@query(
    "silver_merge_two_loads",
    sql(_two_loads("silver_weather", "period_utc", "load_group = 'A'", "load_group <> 'A'")),
)
def _(spark, sf):
    """Through a stored table, the second load merged into the partitions it touches."""
    rows = lenses.bronze_weather(spark, sf)
    path = storage.work_folder(spark, "silver_weather")
    silver.merge(spark, "weather", rows.filter("load_group = 'A'"), path, AS_OF)
    silver.merge(spark, "weather", rows.filter("load_group <> 'A'"), path, AS_OF)
    return silver.read(spark, path)


@query(
    "merge_null_partition",
    """select o_orderkey, case when o_orderkey % 5 <> 0 then o_orderkey % 211 end as part,
              floor(o_totalprice) + case when o_custkey % 3 = 0 then 1 else 0 end as amount
       from orders""",
)
def _(spark, sf):
    """Two loads over many partitions, one of them the partition without a value."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 211).cast("int").alias("part"),
        F.floor("o_totalprice").cast("double").alias("amount"),
        (F.col("o_custkey") % 3 == 0).alias("again"),
    )
    path = storage.work_folder(spark, "merge_null")
    merge_table(spark, path, rows.drop("again"), ["o_orderkey"], "part")
    second = rows.where("again").withColumn("amount", F.col("amount") + 1).drop("again")
    merge_table(spark, path, second, ["o_orderkey"], "part")
    return read_merged(spark, path).withColumn("part", F.col("part").cast("bigint"))


@query(
    "bronze_unreadable_periods",
    sql("""select period, respondent, respondent_name, type, type_name, cast(value as double) as value,
                  value_units, period <> 'no period' as readable
           from bronze_demand where value <> 'n/a'"""),
)
def _(spark, sf):
    """A load with unreadable periods lands every record the contract accepts."""
    work = storage.work_folder(spark, "unreadable")
    rows = lenses.demand_payloads(spark, sf)
    payloads.write_pages(rows.where(~F.contains("value", F.lit("n/a"))), f"{work}/in")
    watermarks.write_watermark(spark, f"{work}/marks", "eia_demand", "1980-01-01T00", "1995-01-01 00:00:00")
    bronze.eia(spark, f"{work}/in", "demand", f"{work}/bronze", f"{work}/marks", AS_OF, page_per_line=True)
    landed = tables.read_table(spark, f"{work}/bronze", medallion.BRONZE_SCHEMAS["demand"])
    return landed.drop("_ingested_at", "load_date").withColumn("readable", parse_hour("period").isNotNull())


@query(
    "carbon_revisions",
    """with slots as (select distinct time_bucket(interval 30 minute, ts) as slot from events)
       select slot as period_from, slot + interval 30 minute as period_to,
              case when slot < timestamp '2024-01-15 12:00:00' then 100 else 200 end::double as intensity_gco2_kwh,
              false as is_estimated
       from slots""",
)
def _(spark, sf):
    """Slots first delivered as estimates are measured in the next load."""
    work = storage.work_folder(spark, "revisions")
    slots = table(spark, sf, "events").select(F.window("ts", "30 minutes").alias("w")).distinct()
    form, noon, end = "yyyy-MM-dd'T'HH:mm'Z'", "2024-01-15 12:00:00", "2024-03-01 00:00:00"
    start = F.col("w.start").cast("timestamp_ntz").cast("string")

    def deliver(name: str, before: str, measured) -> None:
        index, forecast = F.lit("low").alias("index"), F.lit(90.0).alias("forecast")
        one = F.struct(
            F.date_format("w.start", form).alias("from"),
            F.date_format("w.end", form).alias("to"),
            F.struct(measured.alias("actual"), forecast, index).alias("intensity"),
        )
        page = F.to_json(F.struct(F.array(one).alias("data"))).alias("value")
        slots.where(start < before).select(page).write.text(f"{work}/in/{name}")

    def load(name: str, as_of: str) -> None:
        bronze.carbon(spark, f"{work}/in/{name}", f"{work}/bronze", f"{work}/marks", as_of, page_per_line=True)

    watermarks.write_watermark(spark, f"{work}/marks", "carbon_intensity", "1995-01-01T00:00Z", "1995-01-01 00:00:00")
    # The last hours before noon are estimates, then everything is measured.
    deliver("a", noon, F.when(start < "2024-01-15 09:00:00", F.lit(100.0)))
    load("a", noon)
    deliver("b", end, F.when(start < noon, F.lit(100.0)).otherwise(F.lit(200.0)))
    load("b", end)
    landed = tables.read_table(spark, f"{work}/bronze", medallion.BRONZE_SCHEMAS["carbon"])
    return silver.carbon(landed, AS_OF).select("period_from", "period_to", "intensity_gco2_kwh", "is_estimated")


@query(
    "bronze_landing",
    sql("""select period, respondent, respondent_name, type, type_name, cast(value as double) as value,
                  value_units,
                  case when load_group = 'F' then timestamp '2024-01-30 06:00:00'
                       else timestamp '2024-01-31 06:00:00' end as _ingested_at,
                  case when load_group = 'F' then '2024-01-30' else '2024-01-31' end as load_date
           from bronze_demand_clean"""),
)
def _(spark, sf):
    rows = lenses.bronze_demand(spark, sf, dirty=False)
    path = storage.work_folder(spark, "bronze_demand")
    for condition, moment in (
        (_IS_F, "2024-01-30 06:00:00"),
        (f"not {_IS_F}", "2024-01-31 06:00:00"),
    ):
        load = validate(rows.filter(condition), contracts.EIA_DEMAND)
        tables.land_bronze(load, path, moment)
    return tables.read_table(spark, path, medallion.BRONZE_SCHEMAS["demand"])


# ---- gold -------------------------------------------------------------------------


def _stg_demand(spark, sf):
    return gold.stage_demand(_silver_demand(spark, sf))


def _stg_generation(spark, sf):
    return gold.stage_generation(_silver_generation(spark, sf))


def _stg_carbon(spark, sf):
    return gold.stage_carbon(_silver_carbon(spark, sf))


def _dates(spark):
    return gold.dim_date(spark, AS_OF, FIRST_DAY)


def _fact_demand(spark, sf):
    return gold.fact_demand(_stg_demand(spark, sf), _dates(spark), gold.dim_region(spark), AS_OF)


def _fact_generation(spark, sf):
    return gold.fact_generation(
        _stg_generation(spark, sf),
        _dates(spark),
        gold.dim_region(spark),
        gold.dim_fuel_type(spark),
        AS_OF,
    )


def _fact_carbon(spark, sf):
    return gold.fact_carbon_intensity(_stg_carbon(spark, sf), _dates(spark), AS_OF)


def _fact_weather(spark, sf):
    return gold.fact_weather(_silver_weather(spark, sf), _dates(spark), AS_OF)


def _textual_dates(cte: str) -> str:
    return sql(f"select * replace (cast(period_date as varchar) as period_date) from {cte}")


query("stg_demand", _textual_dates("stg_demand"))(_stg_demand)
query("stg_generation", _textual_dates("stg_generation"))(_stg_generation)
query("stg_carbon_intensity", _textual_dates("stg_carbon_intensity"))(_stg_carbon)
query("fact_demand", sql("select * from fact_demand"))(_fact_demand)
query("fact_generation", sql("select * from fact_generation"))(_fact_generation)
query("fact_carbon_intensity", _textual_dates("fact_carbon_intensity"))(_fact_carbon)
query("fact_weather", sql("select * from fact_weather"))(_fact_weather)


@query(
    "order_calendar",
    sql("select * replace (cast(date_day as varchar) as date_day) from dim_date").replace(
        CTES["spine"],
        "select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day))"
        " as date) as date_day from orders",
    ),
)
def _(spark, sf):
    """The date dimension over the span of the order dates."""
    bounds = table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.to_date(F.max("o_orderdate")).alias("last_day"),
    )
    return gold.calendar(gold.date_spine(bounds), AS_OF)


@query(
    "extended_regions",
    sql("""select * from dim_region
           union all
           select cast((select max(region_key) from dim_region)
                      + row_number() over (order by respondent) as integer),
                  respondent, 'Unknown', 'Unknown', 'UTC', 'Unknown'
           from (select distinct respondent from bronze_demand
                 where respondent not in (select respondent_code from dim_region))"""),
)
def _(spark, sf):
    return gold.extend_regions(
        gold.dim_region(spark), lenses.bronze_demand(spark, sf), "respondent"
    )


@query(
    "incremental_fact",
    sql(f"""select demand_key, date_key, region_key, period_utc, period_hour, respondent,
                   demand_mwh, demand_mw, _loaded_at
            from (select *, row_number() over (partition by demand_key
                               order by _loaded_at desc) as rn
                  from (select f.*, timestamp '2024-01-30 00:00:00' as _loaded_at
                        from loaded f union all
                        select f.*, {TS} as _loaded_at from fresh f))
            where rn = 1"""),
)
def _(spark, sf):
    """A fact table of one load, brought up to date with a second one."""
    rows = lenses.bronze_demand(spark, sf)
    dates, regions = _dates(spark), gold.dim_region(spark)
    earlier = "2024-01-30 00:00:00"
    first = gold.stage_demand(silver.demand(rows.filter(_IS_F), earlier))
    second = gold.stage_demand(silver.demand(rows.filter(f"not {_IS_F}"), AS_OF))
    fact = gold.fact_demand(first, dates, regions, earlier)
    staged = upsert(first, second, ["demand_key"])
    new = gold.not_yet_loaded(staged, fact)
    return gold.incremental_fact(
        fact, gold.fact_demand(new, dates, regions, AS_OF), "demand_key"
    )


def _fact_of(condition: str) -> str:
    body = CTES["fact_demand"].replace(f", {TS} as _loaded_at", "")
    staged = CTES["stg_demand"].replace(
        "from silver_demand", f"from ({_first_load('silver_demand', condition)})"
    )
    return body.replace("from stg_demand s", f"from ({staged}) s")


ORACLE["incremental_fact"] = sql(
    ORACLE["incremental_fact"]
    .replace("from loaded f", f"from ({_fact_of(_IS_F)}) f")
    .replace("from fresh f", f"from ({_fact_of(f'not {_IS_F}')}) f")
)

# ---- checks -----------------------------------------------------------------------


def _gold_tables(spark, sf):
    """Silver and facts are stored once; 26 checks then scan them instead of
    repeating the cleansing."""
    work = storage.work_folder(spark, "gold")

    def store(name, df):
        return tables.save_to_path(df, f"{work}/{name}")

    stored = {
        "stg_demand": gold.stage_demand(store("silver_demand", _silver_demand(spark, sf))),
        "stg_generation": gold.stage_generation(
            store("silver_generation", _silver_generation(spark, sf))
        ),
        "stg_carbon_intensity": gold.stage_carbon(
            store("silver_carbon", _silver_carbon(spark, sf))
        ),
        "dim_date": _dates(spark),
        "dim_region": gold.dim_region(spark),
        "dim_fuel_type": gold.dim_fuel_type(spark),
    }
    dates, regions = stored["dim_date"], stored["dim_region"]
    facts = {
        "fact_demand": gold.fact_demand(stored["stg_demand"], dates, regions, AS_OF),
        "fact_generation": gold.fact_generation(
            stored["stg_generation"], dates, regions, stored["dim_fuel_type"], AS_OF
        ),
        "fact_carbon_intensity": gold.fact_carbon_intensity(
            stored["stg_carbon_intensity"], dates, AS_OF
        ),
    }
    return stored | {name: store(name, df) for name, df in facts.items()}


@query("quality_report", checks_sql())
def _(spark, sf):
    return quality.run_checks(_gold_tables(spark, sf), expectations.CHECKS)


RAW_CHECKS = {
    "bronze_demand": quality.TableChecks(
        not_null=("period", "value"),
        unique=("period", "_ingested_at"),
        accepted={"respondent": ("ERCO", "MISO", "PJM"), "value_units": ("megawatthours",)},
        relationships=(quality.Relationship("respondent", "dim_region", "respondent_code"),),
    ),
    "bronze_carbon": quality.TableChecks(
        not_null=("intensity_actual", "intensity_forecast"), unique=("_ingested_at",)
    ),
}


@query("raw_quality_findings", checks_sql(RAW_PROMISES))
def _(spark, sf):
    raw = {
        "bronze_demand": lenses.bronze_demand(spark, sf),
        "bronze_carbon": lenses.bronze_carbon(spark, sf),
        "dim_region": gold.dim_region(spark),
    }
    return quality.run_checks(raw, RAW_CHECKS)


_FRESHNESS_SOURCES = {
    "eia_demand_raw": ("bronze_demand", lenses.bronze_demand),
    "eia_generation_raw": ("bronze_generation", lenses.bronze_generation),
    "carbon_intensity_raw": ("bronze_carbon", lenses.bronze_carbon),
    "weather_raw": ("bronze_weather", lenses.bronze_weather),
}


@query(
    "source_freshness",
    sql(
        " union all ".join(
            f"""select '{name}' as "table", 'freshness' as "check", '_ingested_at' as "column",
                       cast(case when newest >= {TS} - interval '{warn}' then 0 else 1 end
                            as bigint) as failing_rows,
                       case when newest < {TS} - interval '{error}' then 'error'
                            when newest < {TS} - interval '{warn}' then 'warn'
                            else 'pass' end as status
                from (select max(_ingested_at) as newest from {_FRESHNESS_SOURCES[name][0]})"""
            for name, (warn, error) in expectations.FRESHNESS.items()
        )
    ),
)
def _(spark, sf):
    checks = [
        quality.check_freshness(_FRESHNESS_SOURCES[name][1](spark, sf), name, AS_OF, warn, error)
        for name, (warn, error) in expectations.FRESHNESS.items()
    ]
    return reduce(DataFrame.unionByName, checks)


@query(
    "duplicate_line_keys",
    """select l_orderkey, l_linenumber, count(*) as row_count from lineitem
       group by all having count(*) > 1""",
)
def _(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "missing_half_hours",
    sql("""select period from (select unnest(generate_series(timestamp '2024-01-01 00:00:00',
                  timestamp '2024-01-30 23:30:00', interval 30 minute)) as period)
           where period not in (select period_from from silver_carbon)"""),
)
def _(spark, sf):
    return quality.missing_periods(
        _silver_carbon(spark, sf),
        "period_from",
        "2024-01-01 00:00:00",
        "2024-01-30 23:30:00",
        "30 minutes",
    )


@query(
    "orphan_rate",
    sql("""select count(*) as row_count, count(*) filter (region_key is null) as orphan_rows,
                  round(count(*) filter (region_key is null) / count(*), 6) as orphan_rate
           from fact_demand"""),
)
def _(spark, sf):
    rate = quality.orphan_rate(_fact_demand(spark, sf), "region_key")
    return rate.withColumn("orphan_rate", F.round("orphan_rate", 6))


@query(
    "entitled_demand",
    sql("""select * from fact_demand where respondent in
           (select case s_suppkey % 4 when 0 then 'ERCO' when 1 then 'MISO' when 2 then 'PJM'
                   else 'XX' end from supplier where s_suppkey % 4 in (0, 2))"""),
)
def _(spark, sf):
    code = F.pmod("s_suppkey", F.lit(4))
    grants = table(spark, sf, "supplier").select(
        F.when(code % 2 == 0, "east desk").otherwise("west desk").alias("reader"),
        F.get(F.array(*[F.lit(r) for r in lenses.RESPONDENTS]), code.cast("int")).alias("member"),
    )
    return access.entitled_rows(_fact_demand(spark, sf), grants, "east desk", "respondent")


@query(
    "customer_history",
    f"""select c_custkey, c_mktsegment, c_nationkey, timestamp '2020-01-01 00:00:00' as valid_from,
               case when c_acctbal < 0 and c_mktsegment <> 'MACHINERY' then {TS} end as valid_to,
               not (c_acctbal < 0 and c_mktsegment <> 'MACHINERY') as is_current
        from customer
        union all
        select c_custkey, 'MACHINERY', c_nationkey, {TS}, null, true
        from customer where c_acctbal < 0 and c_mktsegment <> 'MACHINERY'
        union all
        select -c_custkey - 1, c_mktsegment, c_nationkey, {TS}, null, true
        from customer where c_nationkey = 0""",
)
def _(spark, sf):
    """Customers in debt move to another segment; new ones join."""
    members = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"
    )
    dim = history.open_history(members.drop("c_acctbal"), "2020-01-01 00:00:00")
    moved = members.withColumn(
        "c_mktsegment",
        F.when(F.col("c_acctbal") < 0, "MACHINERY").otherwise(F.col("c_mktsegment")),
    ).drop("c_acctbal")
    joined = (
        members.filter("c_nationkey = 0")
        .withColumn("c_custkey", -F.col("c_custkey") - 1)
        .drop("c_acctbal")
    )
    return history.apply_changes(
        dim, moved.unionByName(joined), ["c_custkey"], ["c_mktsegment", "c_nationkey"], AS_OF
    )


# ---- insights ---------------------------------------------------------------------


@query(
    "fuel_share",
    sql("""select period_utc, fuel_category, sum(generation_mwh) as generation_mwh,
                  round(sum(generation_mwh)
                        / sum(sum(generation_mwh)) over (partition by period_utc), 6) as share
           from generation_by_category group by period_utc, fuel_category"""),
)
def _(spark, sf):
    share = insights.fuel_share(_fact_generation(spark, sf), gold.dim_fuel_type(spark))
    return share.withColumn("share", F.round("share", 6))


@query(
    "peak_load_fuels",
    sql("""select cast(period_date as varchar) as period_date, p.respondent, p.period_utc,
                  demand_mwh, fuel_type, generation_mwh,
                  cast(row_number() over (partition by p.period_utc, p.respondent
                       order by generation_mwh desc, fuel_type) as integer) as fuel_rank
           from (select *, cast(period_utc as date) as period_date,
                        row_number() over (partition by cast(period_utc as date), respondent
                            order by demand_mwh desc, period_utc) as rn from fact_demand) p
           join (select period_utc, respondent, fuel_type, sum(generation_mwh) as generation_mwh
                 from fact_generation group by all) g
             on p.period_utc = g.period_utc and p.respondent = g.respondent
           where rn = 1"""),
)
def _(spark, sf):
    return insights.peak_load_fuels(_fact_demand(spark, sf), _fact_generation(spark, sf))


def _category_average(category: str, name: str) -> str:
    return f"avg(generation_mwh) filter (fuel_category = '{category}') as {name}"


@query(
    "daily_profile",
    sql(f"""select coalesce(d.period_hour, g.period_hour) as period_hour, avg_demand_mwh,
                   g.* exclude (period_hour)
            from (select period_hour, avg(demand_mwh) as avg_demand_mwh from fact_demand group by 1) d
            full join (select period_hour,
                       {_category_average('Low-Carbon', 'avg_low_carbon_mwh')},
                       {_category_average('Other', 'avg_other_mwh')},
                       {_category_average('Renewable', 'avg_renewable_mwh')},
                       {_category_average('Thermal', 'avg_thermal_mwh')},
                       {_category_average('Unknown', 'avg_unknown_mwh')}
                  from generation_by_category group by 1) g on d.period_hour = g.period_hour"""),
)
def _(spark, sf):
    return insights.daily_profile(
        _fact_demand(spark, sf), _fact_generation(spark, sf), gold.dim_fuel_type(spark)
    )


@query(
    "demand_by_temperature",
    sql("""select cast(floor(temperature_c / 5) * 5 as integer) as temperature_bin,
                  avg(demand_mwh) as avg_demand_mwh, count(*) as hours
           from demand_weather group by 1"""),
)
def _(spark, sf):
    return insights.demand_by_temperature(_fact_demand(spark, sf), _fact_weather(spark, sf))


@query(
    "demand_weather_correlation",
    sql("""select round(corr(demand_mwh, temperature_c), 6) as corr_temperature_c,
                  round(corr(demand_mwh, wind_speed), 6) as corr_wind_speed,
                  round(corr(demand_mwh, precipitation_mm), 6) as corr_precipitation_mm,
                  count(*) as hours
           from demand_weather"""),
)
def _(spark, sf):
    result = insights.demand_weather_correlation(
        _fact_demand(spark, sf), _fact_weather(spark, sf)
    )
    return result.select(
        *[F.round(c, 6).alias(c) for c in result.columns if c != "hours"], "hours"
    )


@query(
    "low_carbon_runs",
    sql("""select min(period_from) as window_start, max(period_to) as window_end,
                  count(*) as slots, avg(intensity_gco2_kwh) as avg_intensity,
                  min(intensity_gco2_kwh) as min_intensity
           from (select *, sum(case when period_from is distinct from previous then 1 else 0 end)
                             over (order by period_from) as run
                 from (select *, lag(period_to) over (order by period_from) as previous
                       from fact_carbon_intensity where is_low_carbon_window))
           group by run"""),
)
def _(spark, sf):
    return insights.low_carbon_runs(_fact_carbon(spark, sf))


@query(
    "intensity_forecast_error",
    sql("""select cast(hour(ts) as integer) as period_hour, avg(e) as bias,
                  avg(abs(e)) as mean_abs_error, max(abs(e)) as max_abs_error, count(*) as slots
           from (select strptime("from", '%Y-%m-%dT%H:%MZ') as ts,
                        intensity_actual - intensity_forecast as e,
                        row_number() over (partition by "from", "to"
                            order by _ingested_at desc) as rn
                 from bronze_carbon)
           where rn = 1 and e is not null group by 1"""),
)
def _(spark, sf):
    return insights.forecast_error(silver.latest_readings(lenses.bronze_carbon(spark, sf)))


CUT = "2000-06-30 00:00:00"


@query(
    "demand_forecast",
    sql(f"""select respondent, period_utc, demand_mwh,
                   round(level + coalesce(warm_base + warm_slope * t, 0), 3) as forecast_mwh
            from (select f.*, coalesce(base + slope * lag, mean, overall) as level
                  from (select a.respondent, a.period_utc, a.demand_mwh, l.demand_mwh as lag, w.temperature_c as t
                        from fact_demand a
                        left join fact_demand l on l.respondent = a.respondent
                             and l.period_utc = a.period_utc - interval 24 hour
                        left join fact_weather w on w.period_utc = a.period_utc) f
                  left join trend using (respondent)
                  cross join (select avg(demand_mwh) as overall from fact_demand
                              where period_utc <= timestamp '{CUT}'))
            left join warmth using (respondent)
            where period_utc > timestamp '{CUT}'""").replace("\nselect respondent, period_utc, demand_mwh,\n", f""",
trend as (select a.respondent, regr_slope(a.demand_mwh, l.demand_mwh) as slope,
                 regr_intercept(a.demand_mwh, l.demand_mwh) as base, avg(a.demand_mwh) as mean
          from fact_demand a left join fact_demand l on l.respondent = a.respondent
               and l.period_utc = a.period_utc - interval 24 hour
          where a.period_utc <= timestamp '{CUT}' group by 1),
warmth as (select respondent, regr_slope(left_over, t) as warm_slope, regr_intercept(left_over, t) as warm_base
           from (select a.respondent, w.temperature_c as t,
                        a.demand_mwh - coalesce(base + slope * l.demand_mwh, mean) as left_over
                 from fact_demand a join trend using (respondent)
                 left join fact_demand l on l.respondent = a.respondent
                      and l.period_utc = a.period_utc - interval 24 hour
                 left join fact_weather w on w.period_utc = a.period_utc
                 where a.period_utc <= timestamp '{CUT}')
           group by 1)
select respondent, period_utc, demand_mwh,
""", 1),
)
def _(spark, sf):
    return insights.forecast_demand(
        cut_lineage(_fact_demand(spark, sf)), CUT, _fact_weather(spark, sf)
    )


# Several steps of this SQL share a table; each is to be computed once.
for _shared in ("fact_demand", "fact_weather", "trend", "warmth"):
    ORACLE["demand_forecast"] = ORACLE["demand_forecast"].replace(
        f"{_shared} as (", f"{_shared} as materialized (", 1
    )


# The regression of the next two queries, by the same elimination over rows gathered afresh for each model.
REGRESSORS = ("x0", "x1", "x2", "x3")


def _regression_sql(answer: str, training: str) -> str:
    """``answer`` over ``f`` (hours with their regressors and stretch) and ``model``; ``training`` joins them."""
    size = len(REGRESSORS) + 1
    names = [*REGRESSORS, "y"]
    cells = [(i, j) for i in range(size - 1) for j in range(size)]
    keep = "respondent, stretch, n, " + ", ".join(f"m{i}" for i in range(size))
    lags = [24, 48, 168]
    text = "f as materialized (select a.respondent, a.period_utc, a.demand_mwh as y, "
    text += ", ".join(f"l{h}.demand_mwh as x{k}" for k, h in enumerate(lags))
    text += f""", w.temperature_c as x3,
                 greatest(ceil(epoch(a.period_utc - timestamp '{CUT}') / 3600 / 672), 0)::bigint as stretch,
                 (epoch(a.period_utc - timestamp '{CUT}') / 3600)::bigint as since
          from fact_demand a """
    for h in lags:
        text += f"""left join fact_demand l{h} on l{h}.respondent = a.respondent
                    and l{h}.period_utc = a.period_utc - interval {h} hour """
    text += "left join fact_weather w on w.period_utc = a.period_utc),\n"
    text += "whole as materialized (select * from f where x0 + x1 + x2 + x3 + y is not null),\n"
    text += "t0 as materialized (select respondent, q.stretch, count(y) as n, "
    text += ", ".join(f"avg({v}) as m{i}" for i, v in enumerate(names))
    text += "".join(f", covar_pop({names[i]}, {names[j]}) as a{i}_{j}" for i, j in cells)
    text += "".join(f", covar_pop({names[i]}, {names[i]}) as w{i}" for i in range(size - 1))
    text += f" from (select distinct respondent, stretch from f) q left join whole b using (respondent) where {training} group by 1, 2),\n"
    for k in range(size - 1):
        usable = f"a{k}_{k} > 1e-9 * w{k} and w{k} > 1e-24 * m{k} * m{k}"
        row = [f"case when {usable} then a{k}_{j} / a{k}_{k} end as p{j}" for j in range(k + 1, size)]
        text += f"s{k} as (select *, {', '.join(row)} from t{k}),\n"
        next_cells = [
            f"coalesce({f'p{j}' if i == k else f'a{i}_{j} - a{i}_{k} * p{j}'}, a{i}_{j}) as a{i}_{j}"
            if j > k else f"a{i}_{j}"
            for i, j in cells
        ]
        used = ", ".join([f"u{i}" for i in range(k)] + [f"{usable} as u{k}"])
        spreads = ", ".join(f"w{i}" for i in range(size - 1))
        text += f"t{k + 1} as materialized (select {keep}, {spreads}, {', '.join(next_cells)}, {used} from s{k}),\n"
    slopes = ", ".join(
        f"case when n >= 30 then case when u{i} then a{i}_{size - 1} else 0 end end as b{i}" for i in range(size - 1)
    )
    text += f"model as materialized (select {keep}, {slopes} from t{size - 1}),\n"
    effects = " + ".join(f"b{i} * (x{i} - m{i})" for i in range(size - 1))
    text += f"""guess as (select f.*, b0 is not null as modelled, coalesce(m4 + {effects}, m4) as forecast
                from f left join model using (respondent, stretch))\n"""
    out = sql(text + answer).replace(f"\n{text}", f",\n{text}", 1)
    for shared in ("fact_demand", "fact_weather"):
        out = out.replace(f"{shared} as (", f"{shared} as materialized (", 1)
    return out


@query(
    "demand_regression",
    _regression_sql(
        f"""select respondent, period_utc, y as demand_mwh, round(forecast, 3) as forecast_mwh
            from guess where period_utc > timestamp '{CUT}'""",
        "b.stretch = 0",
    ),
)
def _(spark, sf):
    """All lags and the temperature in one regression per respondent."""
    return insights.regress_demand(cut_lineage(_fact_demand(spark, sf)), CUT, _fact_weather(spark, sf))


@query(
    "demand_backtest",
    _regression_sql(
        """select respondent, (since - (stretch - 1) * 672)::integer as hours_ahead, count(forecast) as hours,
                  count(*) filter (modelled) as modelled, round(avg(forecast - y), 3) as bias,
                  round(avg(abs(forecast - y)), 3) as mean_abs_error,
                  round(sqrt(avg((forecast - y) ** 2)), 3) as rms_error,
                  round(avg(abs(x0 - y)), 3) as naive_abs_error
           from guess where stretch > 0 and since - (stretch - 1) * 672 <= 24 group by 1, 2""",
        "b.stretch < q.stretch",
    ),
)
def _(spark, sf):
    """An origin every four weeks."""
    demand, weather = cut_lineage(_fact_demand(spark, sf)), _fact_weather(spark, sf)
    return insights.backtest_demand(demand, CUT, weather, step_hours=672)


# ---- streams ----------------------------------------------------------------------


def _drain(streaming_query) -> None:
    streaming_query.awaitTermination()


def _event_files(spark, sf, folder: str, files: int = 4) -> None:
    """Events as JSON files whose times interleave, so most files come in late."""
    events = _events(spark, sf).repartition(files, F.xxhash64("event_id"))
    event_source.write_events_json(events, folder)


@query("stream_rollup", sql("select * from rollup"))
def _(spark, sf):
    """One file per micro-batch, folded together, equals the batch rollup."""
    work = storage.work_folder(spark, "stream_rollup")
    _event_files(spark, sf, f"{work}/in")
    events = event_source.read_events_stream(spark, f"{work}/in", max_files_per_trigger=1)
    _drain(rollup.start_rollup(events, f"{work}/store", f"{work}/ck", compact_every=2, availableNow=True))
    return rollup.read_rollup(spark, f"{work}/store")


@query(
    "stream_watermarked_rollup",
    sql("""select region, source, time_bucket(interval 5 minute, "timestamp") as "timestamp",
                  avg(demand_mw) as avg_demand_mw, max(demand_mw) as max_demand_mw,
                  avg(carbon_intensity_gco2_kwh) as avg_carbon_intensity,
                  max(carbon_intensity_gco2_kwh) as max_carbon_intensity, count(*) as event_count
           from grid_events, (select max("timestamp") - interval 1 hour as mark from grid_events
                              where day("timestamp") <= 20 and cast(event_id as bigint) % 10 <> 0)
           where day("timestamp") > 20 or cast(event_id as bigint) % 10 <> 0
              or time_bucket(interval 5 minute, "timestamp") + interval 5 minute > mark
           group by all"""),
)
def _(spark, sf):
    """The built-in stateful form; of the second instalment only what is within the allowance counts."""
    work = storage.work_folder(spark, "stream_watermarked")
    day, held = F.dayofmonth("timestamp"), F.col("event_id").cast("bigint") % 10 == 0
    for instalment in ((day <= 20) & ~held, (day <= 20) & held, day > 20):
        event_source.write_events_json(_events(spark, sf).filter(instalment), f"{work}/in")
        events = event_source.read_events_stream(spark, f"{work}/in")
        _drain(
            rollup.start_watermarked_rollup(events, f"{work}/store", f"{work}/ck", availableNow=True)
        )
    return rollup.read_watermarked_rollup(spark, f"{work}/store")


@query("stream_raw_events", sql("select * from grid_events"))
def _(spark, sf):
    work = storage.work_folder(spark, "stream_raw")
    _event_files(spark, sf, f"{work}/in")
    events = event_source.read_events_stream(spark, f"{work}/in", max_files_per_trigger=2)
    _drain(ingest.start_raw_sink(events, f"{work}/table", f"{work}/ck", availableNow=True))
    return tables.read_table(spark, f"{work}/table").drop("event_date")


@query("stream_edge_alerts", EDGE_ORACLE)
def _(spark, sf):
    """Events arrive in three instalments; the stream restarts for each."""
    work = storage.work_folder(spark, "stream_edge")
    day = F.dayofmonth("timestamp")
    for instalment in (day <= 10, (day > 10) & (day <= 20), day > 20):
        event_source.write_events_json(_events(spark, sf).filter(instalment), f"{work}/in")
        events = event_source.read_events_stream(spark, f"{work}/in")
        _drain(
            alerts.start_edge_alerts(
                events,
                f"{work}/alerts",
                f"{work}/state",
                f"{work}/ck",
                LOW_RULES,
                availableNow=True,
            )
        )
    return alerts.read_alerts(spark, f"{work}/alerts")


@query(
    "stream_overlay",
    sql("""select bin as "timestamp", avg_ci, avg_demand
           from (select time_bucket(interval 30 minute, "timestamp") as bin,
                        avg(carbon_intensity_gco2_kwh) filter (source <> 'synthetic') as avg_ci,
                        avg(demand_mw) filter (source = 'synthetic') as avg_demand
                 from (select * from grid_events where source <> 'synthetic' or region = 'ERCOT'),
                      (select max("timestamp") - interval 1 hour as first_mark from grid_events
                       where day("timestamp") <= 20 and cast(event_id as bigint) % 10 <> 0)
                 where day("timestamp") > 20 or cast(event_id as bigint) % 10 <> 0
                    or time_bucket(interval 30 minute, "timestamp") + interval 30 minute > first_mark
                 group by 1),
                (select max("timestamp") - interval 1 hour as mark from grid_events)
           where avg_ci is not null and bin + interval 30 minute <= mark"""),
)
def _(spark, sf):
    """Both sides by watermark; a tenth of the first days comes late and the last bins are still open."""
    work = storage.work_folder(spark, "stream_overlay")
    day, held = F.dayofmonth("timestamp"), F.col("event_id").cast("bigint") % 10 == 0
    for instalment in ((day <= 20) & ~held, (day <= 20) & held, day > 20):
        event_source.write_events_json(_events(spark, sf).filter(instalment), f"{work}/in")
        events = event_source.read_events_stream(spark, f"{work}/in")
        _drain(overlay.start_overlay(events, f"{work}/store", f"{work}/ck", lateness="1 hour", availableNow=True))
    return overlay.read_overlay(spark, f"{work}/store")


QUIET = "1 hour"


@query(
    "stream_keyed_alerts",
    sql(
        f"""select {ALERT_COLUMNS} from alerts where previous <= threshold
            union all
            select 'Producer Silence', event_id, region, source, "timestamp" + interval 1 hour, null,
                   'ALERT: no events from ' || region || ' (' || source || ') for 3600 s'
            from (select *, lead("timestamp") over (partition by region, source order by "timestamp", event_id) as next
                  from grid_events where (region = 'ERCOT' and source = 'synthetic') or source <> 'synthetic')
            where next is null or next > "timestamp" + interval 1 hour""",
        spike=35_000,
        high=250,
    ),
)
def _(spark, sf):
    """Events come up to two days late, in shuffled order; a last one of another series moves the clock."""
    work = storage.work_folder(spark, "stream_keyed")
    arrival = F.dayofmonth("timestamp") + F.pmod(F.xxhash64("event_id"), F.lit(3))
    clock = "clock"
    marker = spark.range(1).select(
        F.lit(clock).alias("event_id"), F.lit(clock).alias("region"),
        F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("timestamp"),
        F.lit(0.0).alias("demand_mw"), F.lit(0.0).alias("generation_mw"),
        F.lit(0.0).alias("carbon_intensity_gco2_kwh"), F.lit(clock).alias("source"),
    )
    grid = _events(spark, sf)
    parts = [grid.filter(c) for c in (arrival <= 10, (arrival > 10) & (arrival <= 20), arrival > 20)]
    for part in (*parts, marker):
        event_source.write_events_json(part, f"{work}/in")
        events = event_source.read_events_stream(spark, f"{work}/in")
        _drain(
            keyed.start_keyed_alerts(
                events, f"{work}/store", f"{work}/ck", LOW_RULES, QUIET, "3 days", availableNow=True
            )
        )
    return keyed.read_keyed_alerts(spark, f"{work}/store")


@query(
    "stream_fan_out",
    sql(
        f"""select 'events' as sink, count(*) as row_count, sum(demand_mw) as total
            from grid_events
            union all select 'rollup', count(*), sum(event_count) from rollup
            union all select 'alerts', count(*), sum(value) from alerts""",
        spike=60_000,
        high=250,
    ),
)
def _(spark, sf):
    work = storage.work_folder(spark, "stream_fan_out")
    _event_files(spark, sf, f"{work}/in", files=2)
    events = event_source.read_events_stream(spark, f"{work}/in", max_files_per_trigger=1)
    _drain(ingest.start_fan_out(events, f"{work}/store", f"{work}/ck", availableNow=True))
    sinks = (
        ("events", ingest.read_fan_out_events(spark, f"{work}/store"), "demand_mw"),
        ("rollup", rollup.read_rollup(spark, f"{work}/store/rollup"), "event_count"),
        ("alerts", alerts.read_alerts(spark, f"{work}/store/alerts"), "value"),
    )
    rows = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(column).cast("double").alias("total")
        ).select(F.lit(name).alias("sink"), "row_count", "total")
        for name, df, column in sinks
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "stream_rejected_events",
    sql("""select case cast(event_id as bigint) % 6 when 0 then 'not an event'
                       when 1 then 'timestamp: not a valid time'
                       when 2 then 'demand_mw: not a valid double'
                       when 3 then 'region: missing' else 'accepted' end as verdict,
                  count(*) as lines, sum(case when cast(event_id as bigint) % 6 > 3 then demand_mw end) as total_mw
           from grid_events group by 1"""),
)
def _(spark, sf):
    """Of six lines four are broken in different ways; good ones may quote a number."""
    work = storage.work_folder(spark, "stream_rejects")
    kind = F.pmod(F.get_json_object("value", "$.event_id").cast("bigint"), F.lit(6))
    text = F.col("value")
    broken = (
        F.when(kind == 0, F.left(text, F.lit(20)))
        .when(kind == 1, F.regexp_replace(text, r'"timestamp":"[^"]*"', '"timestamp":"soon"'))
        .when(kind == 2, F.regexp_replace(text, r'"demand_mw":[0-9.E]+', '"demand_mw":NaN'))
        .when(kind == 3, F.regexp_replace(text, r'"region":"[^"]*",', ""))
        .when(kind == 4, F.regexp_replace(text, r'"demand_mw":([0-9.E]+)', '"demand_mw":"$1"'))
        .otherwise(text)
    )
    event_source.events_to_json(_events(spark, sf)).select(broken.alias("value")).write.text(f"{work}/in")
    checked = event_source.read_checked_stream(spark, f"{work}/in")
    _drain(ingest.start_fan_out(checked, f"{work}/store", f"{work}/ck", availableNow=True))
    bad = ingest.read_rejects(spark, f"{work}/store").select(
        F.col("_reason").alias("verdict"), F.lit(None).cast("double").alias("mw")
    )
    good = ingest.read_fan_out_events(spark, f"{work}/store").select(
        F.lit("accepted").alias("verdict"), F.col("demand_mw").alias("mw")
    )
    return bad.unionByName(good).groupBy("verdict").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("mw").alias("total_mw")
    )


# ---- the whole batch path -----------------------------------------------------------


@query(
    "medallion_counts",
    sql("""select 'fact_demand' as "table", count(*) as row_count from fact_demand
           union all select 'fact_generation', count(*) from fact_generation
           union all select 'fact_carbon_intensity', count(*) from fact_carbon_intensity
           union all select 'fact_weather', count(distinct t) from
               (select time as t from bronze_weather
                union all select left(time, 11) || '12:00' from bronze_weather)""").replace(
        "from bronze_demand)\n              where period_utc",
        "from bronze_demand_clean)\n              where period_utc",
    ),
)
def _(spark, sf):
    """Payload files through bronze, silver and gold; both loads absorbed once."""
    work = storage.work_folder(spark, "medallion")
    paths = medallion.Paths(f"{work}/payloads", f"{work}/lake", page_per_line=True)
    weather = lenses.bronze_weather(spark, sf)
    archived = F.col("load_group") == "A"
    pages = {
        "demand": lenses.demand_payloads(spark, sf, dirty=False),
        "generation": lenses.generation_payloads(spark, sf),
        "carbon": lenses.carbon_payloads(spark, sf),
        "weather_archive": lenses.weather_payloads(weather.filter(archived)),
        "weather_forecast": lenses.weather_payloads(weather.filter(~archived)),
    }
    for name, df in pages.items():
        payloads.write_pages(df, paths.payload(name))
    begin = {
        "eia_demand": "1995-01-01T00",
        "eia_generation": "1995-01-01T00",
        "carbon_intensity": "1995-01-01T00:00Z",
        "weather": "1995-01-01T00:00",
    }
    for feed, mark in begin.items():
        watermarks.write_watermark(spark, paths.watermarks, feed, mark, "1995-01-01 00:00:00")
    medallion.run(spark, paths, AS_OF, FIRST_DAY, gate=False)
    built = {
        name: gold.read_fact(spark, paths.table("gold", name)) for name in gold.FACT_KEYS
    }
    facts = ("fact_demand", "fact_generation", "fact_carbon_intensity", "fact_weather")
    counts = [
        built[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table"), "row_count"
        )
        for name in facts
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "medallion_two_runs",
    sql(
        """select demand_key, date_key, region_key, period_utc, period_hour, respondent, demand_mwh, demand_mw
           from fact_demand"""
    )
    .replace("order by _ingested_at desc) as rn", "order by respondent_name desc, demand_mwh desc) as rn")
    .replace("from bronze_demand)\n              where period_utc", "from bronze_demand_clean)\n              where period_utc"),
)
def _(spark, sf):
    """Two runs over a growing payload folder; the second takes only what is new."""
    work = storage.work_folder(spark, "medallion_two")
    paths = medallion.Paths(f"{work}/payloads", f"{work}/lake", page_per_line=True)
    pages = lenses.demand_payloads(spark, sf, dirty=False)
    weather = lenses.weather_payloads(lenses.bronze_weather(spark, sf))
    late = F.get_json_object("value", "$.response.data[0].period") >= "1997-01-01"
    for name, df in (
        ("generation", lenses.generation_payloads(spark, sf)),
        ("carbon", lenses.carbon_payloads(spark, sf)),
        ("weather_archive", weather),
        ("weather_forecast", weather),
    ):
        payloads.write_pages(df, paths.payload(name))
    watermarks.write_watermark(spark, paths.watermarks, "eia_demand", "1980-01-01T00", "1990-01-01 00:00:00")
    payloads.write_pages(pages.where(~late), paths.payload("demand"))
    medallion.run(spark, paths, "2024-01-30 00:00:00", FIRST_DAY, gate=False)
    payloads.write_pages(pages.where(late), paths.payload("demand"), mode="append")
    medallion.run(spark, paths, AS_OF, FIRST_DAY, gate=False)
    return gold.read_fact(spark, paths.table("gold", "fact_demand")).drop("_loaded_at")


@query("medallion_reruns", ORACLE["medallion_two_runs"])
def _(spark, sf):
    """Loads at equal, earlier and later moments; each reaches the fact by its number."""
    work = storage.work_folder(spark, "medallion_reruns")
    paths = medallion.Paths(f"{work}/payloads", f"{work}/lake")
    rows = validate(lenses.bronze_demand(spark, sf, dirty=False), contracts.EIA_DEMAND)
    same = "2024-01-30 00:00:00"
    bounds = ("0000", "1994", "1995", "1997", "9999")
    for low, high, as_of in zip(bounds, bounds[1:], (same, same, "2023-06-01 00:00:00", AS_OF)):
        part = rows.where((F.col("period") >= low) & (F.col("period") < high))
        tables.land_bronze(part, paths.table("bronze", "demand"), as_of)
        medallion.cleanse(spark, paths, as_of, only_new=True)
        medallion.model(spark, paths, as_of, FIRST_DAY, gate=False)
    medallion.cleanse(spark, paths, same, only_new=True)  # nothing is left to take
    medallion.model(spark, paths, same, FIRST_DAY, gate=False)
    return gold.read_fact(spark, paths.table("gold", "fact_demand")).drop("_loaded_at")


@query(
    "delivered_files",
    """select cast(c_group as bigint) as delivery, 'valid' as verdict, count(*) as row_count,
              sum(value) as total, min(period) as first_period, max(period) as last_period
       from (select floor(o_totalprice) as value,
                    strftime(o_orderdate, '%Y-%m-%d') || 'T0' || (o_orderkey % 2) as period,
                    case when o_orderdate < date '1995-01-01' then 0
                         when o_orderdate < date '1997-01-01' then 1 else 2 end as c_group
             from orders where o_orderstatus <> 'P' and o_custkey % 97 <> 0)
       group by all
       union all
       select case when o_orderdate < date '1995-01-01' then 0
                   when o_orderdate < date '1997-01-01' then 1 else 2 end,
              'value: not a valid double', count(*), null, null, null
       from orders where o_orderstatus = 'P' and o_custkey % 97 <> 0 group by all""",
)
def _(spark, sf):
    """Files come in three instalments; each run lands its own, and a run without any lands nothing."""
    work = storage.work_folder(spark, "delivered")
    period = F.get_json_object("value", "$.response.data[0].period")
    pages = lenses.demand_payloads(spark, sf).where(period != "no period")
    year = F.left(period, F.lit(4))
    for instalment in (year < "1995", (year >= "1995") & (year < "1997"), year >= "1997", None):
        if instalment is not None:
            payloads.write_pages(pages.where(instalment), f"{work}/in", mode="append")
        bronze.deliver(
            spark,
            f"{work}/in",
            "demand",
            f"{work}/bronze",
            f"{work}/ledger",
            AS_OF,
            page_per_line=True,
            rejects_path=f"{work}/rejects",
        )
    schema = medallion.BRONZE_SCHEMAS["demand"]
    good = deliveries.read(spark, f"{work}/bronze", schema).withColumn("verdict", F.lit("valid"))
    bad = deliveries.read_rejects(spark, f"{work}/rejects", schema)
    bad = bad.withColumn("verdict", F.col("_reason")).withColumn("period", F.lit(None).cast("string"))
    columns = ["delivery", "verdict", "value", "period"]
    return good.select(columns).unionByName(bad.select(columns)).groupBy(
        F.col("delivery").cast("bigint").alias("delivery"), "verdict"
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("value").alias("total"),
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
    )


@query("medallion_by_file", ORACLE["medallion_two_runs"])
def _(spark, sf):
    """Three runs over a growing folder, each payload file parsed once."""
    work = storage.work_folder(spark, "medallion_file")
    paths = medallion.Paths(f"{work}/payloads", f"{work}/lake", page_per_line=True, by_file=True)
    pages = lenses.demand_payloads(spark, sf, dirty=False)
    weather = lenses.weather_payloads(lenses.bronze_weather(spark, sf))
    late = F.get_json_object("value", "$.response.data[0].period") >= "1997-01-01"
    for name, df in (
        ("generation", lenses.generation_payloads(spark, sf)),
        ("carbon", lenses.carbon_payloads(spark, sf)),
        ("weather_archive", weather),
        ("weather_forecast", weather),
        ("demand", pages.where(~late)),
    ):
        payloads.write_pages(df, paths.payload(name))
    medallion.run(spark, paths, "2024-01-30 00:00:00", FIRST_DAY, gate=False)
    medallion.run(spark, paths, "2024-01-30 00:00:00", FIRST_DAY, gate=False)
    payloads.write_pages(pages.where(late), paths.payload("demand"), mode="append")
    medallion.run(spark, paths, AS_OF, FIRST_DAY, gate=False)
    return gold.read_fact(spark, paths.table("gold", "fact_demand")).drop("_loaded_at")


# ---- facts against versions of their members ----------------------------------------


@query(
    "orders_member_version",
    """with versions as (
           select c_custkey, c_mktsegment as segment, timestamp '1992-01-01' as valid_from,
                  case when c_acctbal < 0 and c_mktsegment <> 'MACHINERY' then timestamp '1995-03-01' end as valid_to
           from customer where c_nationkey > 0
           union all
           select c_custkey, 'MACHINERY', timestamp '1995-03-01', null
           from customer where c_nationkey > 0 and c_acctbal < 0 and c_mktsegment <> 'MACHINERY'
           union all
           select c_custkey, c_mktsegment, timestamp '1995-03-01', null from customer where c_nationkey = 0)
       select o_orderkey, o_custkey, segment, valid_from as version_from
       from orders left join versions
            on o_custkey = c_custkey and o_orderdate >= valid_from and (valid_to is null or o_orderdate < valid_to)""",
)
def _(spark, sf):
    """Each order with its customer's segment on the day of the order; some customers join late."""
    members = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), "c_nationkey", "c_acctbal"
    )
    segment = F.when(F.col("c_acctbal") < 0, "MACHINERY").otherwise(F.col("segment"))
    later = members.where("c_nationkey > 0").withColumn("segment", segment).unionByName(
        members.where("c_nationkey = 0")
    )
    first = history.open_history(members.where("c_nationkey > 0").select("o_custkey", "segment"), "1992-01-01")
    versions = history.apply_changes(first, later, ["o_custkey"], ["segment"], "1995-03-01")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    found = asof.as_of_join(orders, versions, ["o_custkey"], "o_orderdate", ["segment"])
    return found.select("o_orderkey", "o_custkey", "segment", F.col("valid_from").alias("version_from"))


@query(
    "demand_member_version",
    sql(
        """select demand_key, respondent, period_utc, demand_mwh,
                  case when respondent = 'ERCO' and period_utc < timestamp '1994-06-01' then 'south'
                       when respondent = 'ERCO' and period_utc < timestamp '1996-03-01' then 'gulf'
                       when respondent = 'ERCO' then 'south'
                       when respondent = 'MISO' then 'north'
                       when respondent = 'PJM' and period_utc < timestamp '1996-03-01' then 'east'
                       when respondent = 'PJM' then 'atlantic'
                       when respondent = 'XX' and period_utc >= timestamp '1996-03-01' then 'other' end as desk
           from fact_demand"""
    ),
)
def _(spark, sf):
    """Four respondents hold all rows; one changes its desk twice, one is known late."""
    states = (
        ("1990-01-01", {"ERCO": "south", "MISO": "north", "PJM": "east"}),
        ("1994-06-01", {"ERCO": "gulf"}),
        ("1996-03-01", {"ERCO": "south", "PJM": "atlantic", "XX": "other"}),
    )
    versions = None
    for since, members in states:
        rows = spark.createDataFrame(list(members.items()), "respondent string, desk string")
        if versions is None:
            versions = history.open_history(rows, since)
        else:
            versions = history.apply_changes(versions, rows, ["respondent"], ["desk"], since)
    found = asof.as_of_join(_fact_demand(spark, sf), versions, ["respondent"], "period_utc", ["desk"])
    return found.select("demand_key", "respondent", "period_utc", "demand_mwh", "desk")


@query("stored_outliers", ORACLE["demand_outliers"])
def _(spark, sf):
    """The base comes from the moments in the rollup store alone, merged twice on the way."""
    work = storage.work_folder(spark, "stored_outliers")
    events = _events(spark, sf)
    late = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for number in range(3):
        rollup.keep_rollup(events.where(late == number), number, work, compact_every=2)
    found = rollup.outliers(spark, work, events, AS_OF, base=WHOLE_SPAN, recent=WHOLE_SPAN)
    return found.withColumn("z_score", F.round("z_score", 6))
