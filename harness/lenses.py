"""Views of the given tables in the shapes the engine works on.

Measures are whole numbers or quarters, so that sums are exact in any order and
results can be compared without tolerance. Every row of a table is used; the
modulo expressions only assign labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The moment the queries are asked: just after the newest event.
AS_OF = "2024-01-31 00:00:00"
WHOLE_SPAN = "31 days"
FIRST_DAY = "1995-01-01"

# Labels assigned by remainder. The last respondent and the last fuel code have
# no dimension member on purpose.
RESPONDENTS = ("ERCO", "MISO", "PJM", "XX")
FUEL_CODES = ("COL", "NG", "OIL", "NUC", "WAT", "WND", "SUN", "GEO", "BIO", "OTH", "UNK", "ZZZ")

DAY = "yyyy-MM-dd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _label(names: tuple[str, ...], number: str) -> Column:
    at = F.pmod(F.col(number), F.lit(len(names))).cast("int")
    return F.get(F.array(*[F.lit(n) for n in names]), at)


def _whole(c: Column) -> Column:
    return F.floor(c).cast("double")


def _loaded(seconds: str) -> Column:
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return base + F.make_dt_interval(secs=F.col(seconds).cast("decimal(18,6)"))


def grid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_view = F.col("event_type") == "view"
    third = F.pmod("user_id", F.lit(3))
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(is_view, "GB")
        .when(third == 0, "ERCOT")
        .when(third == 1, "CAISO")
        .otherwise("MISO")
        .alias("region"),
        F.col("ts").alias("timestamp"),
        F.when(is_view, 0.0).otherwise(30000.0 + _whole(value * 100)).alias("demand_mw"),
        F.when(is_view, 0.0).otherwise(30500.0 + _whole(value * 98)).alias("generation_mw"),
        (60.0 + _whole(value * 8) / 4).alias("carbon_intensity_gco2_kwh"),
        F.when(is_view, "carbonintensity.org.uk").otherwise("synthetic").alias("source"),
    )


def bronze_demand(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """With ``dirty`` some periods and values are unreadable."""
    orders = table(spark, sf_dir, "orders")
    hour = F.pmod("o_orderkey", F.lit(2)).cast("string")
    period = F.concat(F.date_format("o_orderdate", DAY), F.lit("T0"), hour)
    value = F.floor("o_totalprice").cast("string")
    if dirty:
        period = F.when(F.col("o_custkey") % 97 == 0, "no period").otherwise(period)
        value = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(value)
    return orders.select(
        period.alias("period"),
        _label(RESPONDENTS, "o_custkey").alias("respondent"),
        F.col("o_orderpriority").alias("respondent_name"),
        F.lit("D").alias("type"),
        F.lit("Demand").alias("type_name"),
        value.alias("value"),
        F.lit("megawatthours").alias("value_units"),
        _loaded("o_orderkey").alias("_ingested_at"),
        F.col("o_orderstatus").alias("load_group"),
    )


def bronze_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    hour = F.pmod("l_linenumber", F.lit(2)).cast("string")
    return lineitem.select(
        F.concat(F.date_format("l_shipdate", DAY), F.lit("T0"), hour).alias("period"),
        _label(RESPONDENTS, "l_suppkey").alias("respondent"),
        _label(FUEL_CODES, "l_partkey").alias("fuel_type"),
        F.lit(None).cast("string").alias("fuel_type_description"),
        (F.col("l_quantity") * 100).cast("bigint").cast("string").alias("value"),
        F.lit("megawatthours").alias("value_units"),
        _loaded("l_orderkey").alias("_ingested_at"),
    )


def bronze_carbon(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    slot = F.window("ts", "30 minutes")
    level = _whole(F.col("value") * 4)
    form = "yyyy-MM-dd'T'HH:mm'Z'"
    fifth, fiftieth = F.col("event_id") % 5 == 0, F.col("event_id") % 50 == 0
    return events.select(
        F.date_format(slot["start"], form).alias("from"),
        F.date_format(slot["end"], form).alias("to"),
        F.when(level < 100, "low").when(level < 300, "moderate").otherwise("high").alias(
            "intensity_index"
        ),
        F.when(~fifth, level).alias("intensity_actual"),
        F.when(~fiftieth, level + 5).alias("intensity_forecast"),
        F.col("ts").alias("_ingested_at"),
    )


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    hour = F.pmod("l_linenumber", F.lit(2)).cast("string")
    return lineitem.select(
        F.concat(F.date_format("l_shipdate", DAY), F.lit("T0"), hour, F.lit(":00")).alias("time"),
        (F.col("l_quantity") - 10).alias("temperature_2m"),
        _whole(F.col("l_discount") * 100).alias("wind_speed_10m"),
        _whole(F.col("l_tax") * 100).alias("precipitation"),
        F.col("l_linenumber").alias("weather_code"),
        _loaded("l_orderkey").alias("_ingested_at"),
        F.col("l_returnflag").alias("load_group"),
    )


# ---- payload texts, one page per row ------------------------------------------


def _page(df: DataFrame, body: Column) -> DataFrame:
    return df.select(F.to_json(body).alias("value"))


def demand_payloads(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    rows = bronze_demand(spark, sf_dir, dirty)
    record = F.struct(
        "period",
        "respondent",
        F.col("respondent_name").alias("respondent-name"),
        "type",
        F.col("type_name").alias("type_name"),
        "value",
        F.col("value_units").alias("value-units"),
    )
    response = F.struct(F.lit(1).alias("total"), F.array(record).alias("data"))
    return _page(rows, F.struct(response.alias("response")))


def generation_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze_generation(spark, sf_dir)
    record = F.struct(
        "period",
        "respondent",
        F.col("fuel_type").alias("fueltype"),
        F.col("value").cast("bigint").alias("value"),
        F.col("value_units").alias("value-units"),
    )
    response = F.struct(F.lit(1).alias("total"), F.array(record).alias("data"))
    return _page(rows, F.struct(response.alias("response")))


def carbon_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze_carbon(spark, sf_dir)
    intensity = F.struct(
        F.col("intensity_actual").alias("actual"),
        F.col("intensity_forecast").alias("forecast"),
        F.col("intensity_index").alias("index"),
    )
    slot = F.struct("from", "to", intensity.alias("intensity"))
    return _page(rows, F.struct(F.array(slot).alias("data")))


def weather_payloads(rows: DataFrame, with_gaps: bool = False) -> DataFrame:
    """Two hours per page; with gaps the second hour lacks its measures and
    half of the pages carry no weather code at all."""

    def pair(name: str) -> Column:
        second = F.lit(None).cast("double") if with_gaps else F.col(name)
        return F.array(F.col(name), second).alias(name)

    times = F.array("time", F.concat(F.left("time", F.lit(11)), F.lit("12:00"))).alias("time")
    codes = F.array("weather_code", "weather_code")
    if with_gaps:
        codes = F.when(F.col("weather_code") % 2 == 0, codes)
    hourly = F.struct(
        times,
        pair("temperature_2m"),
        pair("wind_speed_10m"),
        pair("precipitation"),
        codes.alias("weather_code"),
    )
    return _page(rows, F.struct(hourly.alias("hourly")))


# ---- comparison ----------------------------------------------------------------


def portable(df: DataFrame) -> DataFrame:
    """Zone-free times and textual dates, as the other engine reports them."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind == "date":
            c = c.cast("string")
        columns.append(c.alias(name))
    return df.select(*columns)
