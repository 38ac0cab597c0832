"""The whole batch path: payloads to bronze, silver, gold and checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.functions.time import Moment
from wattline.operators import storage, versions
from wattline.operators.quality import require_passing, run_checks
from wattline.plans import bronze, expectations, gold, silver
from wattline.sources import deliveries
from wattline.sources.tables import loads_since, read_table

BRONZE_SCHEMAS = {
    "demand": schemas.BRONZE_DEMAND,
    "generation": schemas.BRONZE_GENERATION,
    "carbon": schemas.BRONZE_CARBON,
    "weather": schemas.BRONZE_WEATHER,
}


@dataclass(frozen=True)
class Paths:
    """Payload folders live under ``payloads``; everything built under ``lake``.

    With ``by_file`` bronze takes each payload file once instead of a range of times; a
    lake keeps the form it began with.
    """

    payloads: str
    lake: str
    page_per_line: bool = False
    by_file: bool = False

    def payload(self, name: str) -> str:
        return f"{self.payloads}/{name}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.lake}/{layer}/{name}"

    @property
    def watermarks(self) -> str:
        return f"{self.lake}/state/watermarks"

    def ledger(self, name: str) -> str:
        return f"{self.lake}/state/ledger/{name}"


def _ingest_files(spark: SparkSession, paths: Paths, as_of: Moment) -> dict[str, int]:
    lines = paths.page_per_line
    landed = {
        feed: bronze.deliver(
            spark,
            paths.payload(feed),
            feed,
            paths.table("bronze", feed),
            paths.ledger(feed),
            as_of,
            page_per_line=lines,
        )
        for feed in ("demand", "generation", "carbon")
    }
    landed["weather"] = bronze.deliver_weather(
        spark,
        paths.payload("weather_archive"),
        paths.payload("weather_forecast"),
        paths.table("bronze", "weather"),
        paths.ledger("weather"),
        as_of,
        page_per_line=lines,
    )
    return landed


def ingest(spark: SparkSession, paths: Paths, as_of: Moment) -> dict[str, int]:
    """Land every feed; returns the rows landed per feed."""
    if paths.by_file:
        return _ingest_files(spark, paths, as_of)
    marks, lines = paths.watermarks, paths.page_per_line
    landed = {
        feed: bronze.eia(
            spark,
            paths.payload(feed),
            feed,
            paths.table("bronze", feed),
            marks,
            as_of,
            page_per_line=lines,
        )
        for feed in ("demand", "generation")
    }
    landed["carbon"] = bronze.carbon(
        spark,
        paths.payload("carbon"),
        paths.table("bronze", "carbon"),
        marks,
        as_of,
        page_per_line=lines,
    )
    landed["weather"] = bronze.weather(
        spark,
        paths.payload("weather_archive"),
        paths.payload("weather_forecast"),
        paths.table("bronze", "weather"),
        marks,
        as_of,
        page_per_line=lines,
    )
    return landed


def read_bronze(spark: SparkSession, paths: Paths, name: str) -> DataFrame:
    if paths.by_file:
        rows = deliveries.read(spark, paths.table("bronze", name), BRONZE_SCHEMAS[name])
        return rows.drop(deliveries.DELIVERY)
    return read_table(spark, paths.table("bronze", name), BRONZE_SCHEMAS[name])


def _empty_silver(spark: SparkSession, name: str, as_of: Moment) -> DataFrame:
    return silver.build(name, spark.createDataFrame([], BRONZE_SCHEMAS[name]), as_of)


def read_silver(spark: SparkSession, paths: Paths, name: str, as_of: Moment) -> DataFrame:
    """A stored silver table; one that no row has reached yet is empty."""
    path = paths.table("silver", name)
    if versions.numbers(spark, path):
        return silver.read(spark, path)
    return _empty_silver(spark, name, as_of)


def _cleanse_deliveries(spark: SparkSession, paths: Paths, as_of: Moment) -> None:
    """Upsert the deliveries that silver's last commit had not taken in."""
    for name in silver.TABLES:
        bronze_path, path = paths.table("bronze", name), paths.table("silver", name)
        upto = deliveries.newest(spark, bronze_path)
        seen = versions.pointer(spark, path).consumed.get(deliveries.DELIVERY, -1)
        if upto > seen:
            rows = deliveries.read(spark, bronze_path, BRONZE_SCHEMAS[name], after=seen)
            rows = rows.drop(deliveries.DELIVERY)
            silver.merge(spark, name, rows, path, as_of, consumed={deliveries.DELIVERY: upto})


def cleanse(
    spark: SparkSession,
    paths: Paths,
    as_of: Moment,
    since_load: str | None = None,
    only_new: bool = False,
) -> None:
    """Upsert bronze loads, all or only recent ones, into silver.

    With ``only_new`` a load date is read again only if files were added to it since
    silver last took it in. Silver's own commit records how many it has seen, so a run
    that dies, is repeated or goes back to an earlier date leaves nothing out.
    """
    if paths.by_file and only_new:
        return _cleanse_deliveries(spark, paths, as_of)
    for name in silver.TABLES:
        bronze_path, path = paths.table("bronze", name), paths.table("silver", name)
        there = storage.files_by_folder(spark, bronze_path, "load_date=*")
        if not there:
            continue
        rows = loads_since(read_bronze(spark, paths, name), since_load)
        if only_new:
            seen = versions.pointer(spark, path).consumed
            days = [d.split("=", 1)[1] for d, files in there.items() if seen.get(d) != files]
            if not days:
                continue
            rows = rows.where(F.col("load_date").isin([date.fromisoformat(d) for d in days]))
        silver.merge(spark, name, rows, path, as_of, consumed=None if since_load else there)


def _check_some(tables: dict[str, DataFrame], names: Iterable[str]) -> DataFrame:
    return run_checks(tables, {n: expectations.CHECKS[n] for n in names})


def model(
    spark: SparkSession,
    paths: Paths,
    as_of: Moment,
    start: str = gold.DEFAULT_START,
    gate: bool = True,
) -> dict[str, DataFrame]:
    """Bring the star schema up to date; staging stays a projection, the rest is stored.

    Dimensions are rebuilt. A fact takes the silver loads it does not hold yet, by their
    numbers and not by any time, and rewrites the months they changed; how far it got is
    part of the commit that stores it. With ``gate`` the staging and dimension tables
    must pass their checks before any fact is built, and the new rows of a fact before
    they are stored.
    """
    stored = {name: read_silver(spark, paths, name, as_of) for name in silver.TABLES}
    tables = {
        "stg_demand": gold.stage_demand(stored["demand"]),
        "stg_generation": gold.stage_generation(stored["generation"]),
        "stg_carbon_intensity": gold.stage_carbon(stored["carbon"]),
    }

    def store(name: str, df: DataFrame) -> DataFrame:
        tables[name] = versions.replace(spark, paths.table("gold", name), df)
        return tables[name]

    dates = store("dim_date", gold.dim_date(spark, as_of, start))
    regions = store("dim_region", gold.dim_region(spark))
    fuels = store("dim_fuel_type", gold.dim_fuel_type(spark))
    if gate:
        require_passing(_check_some(tables, list(tables)))

    def merge(name: str, source: str, build: Callable[[DataFrame], DataFrame]) -> None:
        path = paths.table("gold", name)
        after = gold.loaded_upto(spark, path)
        changed, upto = silver.read_loads(spark, paths.table("silver", source), after)
        if changed is None:
            changed = _empty_silver(spark, source, as_of)
        fresh = storage.cut_lineage(build(changed))
        if gate and name in expectations.CHECKS:
            require_passing(_check_some({**tables, name: fresh}, [name]))
        gold.merge_fact(spark, name, fresh, path, upto)
        tables[name] = gold.read_fact(spark, path)

    merge(
        "fact_demand",
        "demand",
        lambda rows: gold.fact_demand(gold.stage_demand(rows), dates, regions, as_of),
    )
    merge(
        "fact_generation",
        "generation",
        lambda rows: gold.fact_generation(gold.stage_generation(rows), dates, regions, fuels, as_of),
    )
    merge(
        "fact_carbon_intensity",
        "carbon",
        lambda rows: gold.fact_carbon_intensity(gold.stage_carbon(rows), dates, as_of),
    )
    merge("fact_weather", "weather", lambda rows: gold.fact_weather(rows, dates, as_of))
    return tables


def vacuum(spark: SparkSession, paths: Paths) -> None:
    """Remove what only commits before the last two of each table needed."""
    for layer in ("silver", "gold"):
        for name in storage.children(spark, f"{paths.lake}/{layer}"):
            versions.vacuum(spark, paths.table(layer, name))


def run(
    spark: SparkSession,
    paths: Paths,
    as_of: Moment,
    start: str = gold.DEFAULT_START,
    gate: bool = True,
) -> DataFrame:
    """Every step in order, each taking only what is new; returns the results of all checks.

    Silver takes the bronze files it has not seen, facts the silver loads they do not
    hold. A run may be repeated, or follow a later one, with the same outcome.
    """
    ingest(spark, paths, as_of)
    cleanse(spark, paths, as_of, only_new=True)
    tables = model(spark, paths, as_of, start, gate)
    vacuum(spark, paths)
    return run_checks(tables, expectations.CHECKS)
