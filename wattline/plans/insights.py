"""Questions asked of the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.time import Moment, instant, seconds_between
from wattline.operators.ordered import with_previous, with_running_total
from wattline.operators.regression import before, moments, predicted, solve

# The categories of the fuel dimension.
FUEL_CATEGORIES = ("Low-Carbon", "Other", "Renewable", "Thermal", "Unknown")


def _with_category(generation: DataFrame, fuels: DataFrame) -> DataFrame:
    """Rows without a fuel member count as Unknown."""
    categories = fuels.select("fuel_type_key", "fuel_category")
    return generation.join(categories, "fuel_type_key", "left").withColumn(
        "fuel_category", F.coalesce("fuel_category", F.lit("Unknown"))
    )


def fuel_share(generation: DataFrame, fuels: DataFrame) -> DataFrame:
    """Share of each fuel category in each hour's generation.

    The window sees one pre-aggregated row per category and hour.
    """
    hourly = (
        _with_category(generation, fuels)
        .groupBy("period_utc", "fuel_category")
        .agg(F.sum("generation_mwh").alias("generation_mwh"))
    )
    total = F.sum("generation_mwh").over(Window.partitionBy("period_utc"))
    return hourly.withColumn("share", F.try_divide(F.col("generation_mwh"), total))


def peak_hours(demand: DataFrame) -> DataFrame:
    """Hour of greatest demand per day and respondent; the earliest among equals."""
    best = F.max_by(
        F.struct("period_utc", "demand_mwh"),
        F.struct("demand_mwh", (-F.unix_timestamp("period_utc")).alias("earliest")),
    )
    return (
        demand.groupBy(F.to_date("period_utc").alias("period_date"), "respondent")
        .agg(best.alias("peak"))
        .select("period_date", "respondent", "peak.period_utc", "peak.demand_mwh")
    )


def peak_load_fuels(demand: DataFrame, generation: DataFrame) -> DataFrame:
    """Fuels ranked by output in each respondent's daily peak hour."""
    peaks = peak_hours(demand).select("period_date", "respondent", "period_utc", "demand_mwh")
    mix = generation.groupBy("period_utc", "respondent", "fuel_type").agg(
        F.sum("generation_mwh").alias("generation_mwh")
    )
    by_output = Window.partitionBy("period_utc", "respondent").orderBy(
        F.desc("generation_mwh"), "fuel_type"
    )
    return peaks.join(mix, ["period_utc", "respondent"]).withColumn(
        "fuel_rank", F.row_number().over(by_output)
    )


def daily_profile(demand: DataFrame, generation: DataFrame, fuels: DataFrame) -> DataFrame:
    """Average demand and generation per fuel category, by hour of day.

    Averages are over reported rows; both sides have at most 24 rows when joined.
    """
    load = demand.groupBy("period_hour").agg(F.avg("demand_mwh").alias("avg_demand_mwh"))
    mix = (
        _with_category(generation, fuels)
        .groupBy("period_hour")
        .pivot("fuel_category", list(FUEL_CATEGORIES))
        .agg(F.avg("generation_mwh"))
    )
    renamed = mix.select(
        "period_hour",
        *[
            F.col(f"`{c}`").alias("avg_" + c.lower().replace("-", "_") + "_mwh")
            for c in FUEL_CATEGORIES
        ],
    )
    return load.join(renamed, "period_hour", "full")


def _hourly_load(demand: DataFrame) -> DataFrame:
    return demand.groupBy("period_utc").agg(F.sum("demand_mwh").alias("demand_mwh"))


def demand_weather(demand: DataFrame, weather: DataFrame) -> DataFrame:
    """Total hourly demand beside the weather of the same hour."""
    return _hourly_load(demand).join(
        weather.select("period_utc", "temperature_c", "wind_speed", "precipitation_mm"),
        "period_utc",
    )


def demand_by_temperature(
    demand: DataFrame, weather: DataFrame, bin_degrees: int = 5
) -> DataFrame:
    temperature_bin = (F.floor(F.col("temperature_c") / bin_degrees) * bin_degrees).cast("int")
    return (
        demand_weather(demand, weather)
        .filter(F.col("temperature_c").isNotNull())
        .groupBy(temperature_bin.alias("temperature_bin"))
        .agg(F.avg("demand_mwh").alias("avg_demand_mwh"), F.count(F.lit(1)).alias("hours"))
    )


def demand_weather_correlation(demand: DataFrame, weather: DataFrame) -> DataFrame:
    return demand_weather(demand, weather).agg(
        *[
            F.corr("demand_mwh", c).alias(f"corr_{c}")
            for c in ("temperature_c", "wind_speed", "precipitation_mm")
        ],
        F.count(F.lit(1)).alias("hours"),
    )


def low_carbon_runs(carbon: DataFrame) -> DataFrame:
    """Unbroken stretches of low-carbon slots, for shifting load into.

    A run breaks at a slot that is not low-carbon and at a missing slot. Slots
    are numbered without ever sorting the whole series in one task.
    """
    slots = carbon.filter("is_low_carbon_window").select(
        "period_from", "period_to", "intensity_gco2_kwh"
    )
    order = ["period_from", "period_to"]
    linked = with_previous(slots, [], order, "period_to", "_previous_to")
    starts = (~F.col("period_from").eqNullSafe(F.col("_previous_to"))).cast("int")
    runs = with_running_total(linked, [], order, starts, "_run")
    return (
        runs.groupBy("_run")
        .agg(
            F.min("period_from").alias("window_start"),
            F.max("period_to").alias("window_end"),
            F.count(F.lit(1)).alias("slots"),
            F.avg("intensity_gco2_kwh").alias("avg_intensity"),
            F.min("intensity_gco2_kwh").alias("min_intensity"),
        )
        .drop("_run")
    )


def forecast_error(bronze_carbon: DataFrame) -> DataFrame:
    """Measured minus forecast intensity by hour of day: bias and mean absolute error.

    Takes the deduplicated readings with both values present.
    """
    error = F.col("intensity_actual") - F.col("intensity_forecast")
    return (
        bronze_carbon.filter(error.isNotNull())
        .groupBy(F.hour("period_from").alias("period_hour"))
        .agg(
            F.avg(error).alias("bias"),
            F.avg(F.abs(error)).alias("mean_abs_error"),
            F.max(F.abs(error)).alias("max_abs_error"),
            F.count(F.lit(1)).alias("slots"),
        )
    )


# ---- short-horizon forecast --------------------------------------------------

LAG_HOURS = (24, 48, 168)


def forecast_features(
    demand: DataFrame, weather: DataFrame | None = None, lags: tuple[int, ...] = LAG_HOURS
) -> DataFrame:
    """Demand of a respondent-hour beside its own past and the hour's weather.

    Every row is sent to its own hour and to the hours it is a lag of, so one
    grouping gathers all lags; gaps never shift a lag, and an hour without one
    keeps a NULL there. A series of any length spreads over all tasks.
    """
    shifts = F.explode(F.array(*[F.lit(h) for h in (0, *lags)])).alias("shift")
    sent = demand.select("respondent", "period_utc", "demand_mwh", shifts).select(
        "respondent",
        (F.col("period_utc") + F.make_dt_interval(hours=F.col("shift"))).alias("period_utc"),
        "demand_mwh",
        "shift",
    )

    def at(hours: int, name: str) -> Column:
        return F.max(F.when(F.col("shift") == hours, F.col("demand_mwh"))).alias(name)

    features = (
        sent.groupBy("respondent", "period_utc")
        .agg(
            F.bool_or(F.col("shift") == 0).alias("_own"),
            at(0, "demand_mwh"),
            *[at(h, f"lag_{h}h") for h in lags],
        )
        .where("_own")
        .drop("_own")
    )
    if weather is not None:
        features = features.join(weather.select("period_utc", "temperature_c"), "period_utc", "left")
    return features


def forecast_demand(
    demand: DataFrame,
    train_until: Moment,
    weather: DataFrame | None = None,
    lag: int = 24,
) -> DataFrame:
    """Forecast of every respondent-hour after ``train_until`` from the hours before.

    Per respondent the hour is regressed on the same hour ``lag`` hours earlier
    and, with ``weather``, what that leaves on the temperature. Without a lag the
    respondent's mean stands in, without history the mean of all.
    """
    past = F.col("period_utc") <= instant(train_until)
    rows = forecast_features(demand, weather, (lag,)).withColumnRenamed(f"lag_{lag}h", "_lag")
    trend = rows.where(past).groupBy("respondent").agg(
        F.regr_slope("demand_mwh", "_lag").alias("_slope"),
        F.regr_intercept("demand_mwh", "_lag").alias("_base"),
        F.avg("demand_mwh").alias("_mean"),
    )
    overall = rows.where(past).agg(F.avg("demand_mwh")).first()[0]
    level = F.coalesce(
        F.col("_base") + F.col("_slope") * F.col("_lag"), F.col("_mean"), F.lit(overall).cast("double")
    )
    levelled = rows.join(trend, "respondent", "left").withColumn("_level", level)
    forecast = F.col("_level")
    if weather is not None:
        left_over = F.col("demand_mwh") - F.col("_level")
        warmth = levelled.where(past).groupBy("respondent").agg(
            F.regr_slope(left_over, F.col("temperature_c")).alias("_warm_slope"),
            F.regr_intercept(left_over, F.col("temperature_c")).alias("_warm_base"),
        )
        levelled = levelled.join(warmth, "respondent", "left")
        effect = F.col("_warm_base") + F.col("_warm_slope") * F.col("temperature_c")
        forecast = forecast + F.coalesce(effect, F.lit(0.0))
    return levelled.where(~past).select(
        "respondent", "period_utc", "demand_mwh", F.round(forecast, 3).alias("forecast_mwh")
    )


# ---- several regressors, and how well they would have done ---------------------


def _regressors(weather: DataFrame | None, lags: tuple[int, ...]) -> list[str]:
    return [f"lag_{h}h" for h in lags] + (["temperature_c"] if weather is not None else [])


def regress_demand(
    demand: DataFrame,
    train_until: Moment,
    weather: DataFrame | None = None,
    lags: tuple[int, ...] = LAG_HOURS,
) -> DataFrame:
    """Forecast of every respondent-hour after ``train_until`` from all lags and the temperature at once.

    A respondent's mean stands in where a regressor is missing or its history has too few
    complete hours; a respondent without one has no forecast.
    """
    names = _regressors(weather, lags)
    rows = forecast_features(demand, weather, lags)
    past = F.col("period_utc") <= instant(train_until)
    size = len(names) + 1
    models = solve(moments(rows.where(past), ["respondent"], [*names, "demand_mwh"]), ["respondent"], size)
    return rows.where(~past).join(models, "respondent", "left").select(
        "respondent", "period_utc", "demand_mwh", F.round(predicted(names), 3).alias("forecast_mwh")
    )


def backtest_demand(
    demand: DataFrame,
    first_origin: Moment,
    weather: DataFrame | None = None,
    lags: tuple[int, ...] = LAG_HOURS,
    step_hours: int = 168,
) -> DataFrame:
    """Errors of the forecast by respondent and hours ahead, over rolling origins.

    Every ``step_hours`` from ``first_origin`` on a model is trained on all hours up to that origin
    and judged on the hours up to the next, as far ahead as the shortest lag reaches, because
    nothing later than the origin is known. Stretches between origins are summed once and merged, so
    the number of origins does not multiply the work. ``naive_abs_error`` is that of repeating the
    shortest lag.
    """
    names, size = _regressors(weather, lags), len(lags) + (weather is not None) + 1
    since = seconds_between(F.col("period_utc"), instant(first_origin)) / 3600
    stretch = F.greatest(F.ceil(since / step_hours), F.lit(0)).alias("_stretch")
    rows = forecast_features(demand, weather, lags).select("*", since.alias("_since"), stretch)
    groups = moments(rows, ["respondent", "_stretch"], [*names, "demand_mwh"])
    models = solve(before(groups, ["respondent"], "_stretch", size), ["respondent", "_stretch"], size)
    ahead = F.col("_since") - (F.col("_stretch") - 1) * step_hours
    judged = (
        rows.where("_stretch > 0")
        .withColumn("hours_ahead", F.ceil(ahead).cast("int"))
        .where(F.col("hours_ahead") <= min(lags))
        .join(models, ["respondent", "_stretch"])
    )
    error = predicted(names) - F.col("demand_mwh")
    naive = F.col(f"lag_{min(lags)}h") - F.col("demand_mwh")
    return judged.groupBy("respondent", "hours_ahead").agg(
        F.count(error).alias("hours"),
        F.count("_base").alias("modelled"),
        F.round(F.avg(error), 3).alias("bias"),
        F.round(F.avg(F.abs(error)), 3).alias("mean_abs_error"),
        F.round(F.sqrt(F.avg(error * error)), 3).alias("rms_error"),
        F.round(F.avg(F.abs(naive)), 3).alias("naive_abs_error"),
    )
