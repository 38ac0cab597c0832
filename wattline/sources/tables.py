"""Table reads and writes. The format is a parameter; Parquet is the default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.time import Moment, as_datetime, stamp

FORMAT = "parquet"


def read_table(
    spark: SparkSession, path: str, schema=None, table_format: str = FORMAT
) -> DataFrame:
    reader = spark.read.format(table_format)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def with_load_columns(df: DataFrame, as_of: Moment) -> DataFrame:
    day = as_datetime(as_of).date().isoformat()
    return df.withColumn("_ingested_at", stamp(as_of)).withColumn(
        "load_date", F.lit(day).cast("date")
    )


def land_bronze(
    df: DataFrame, path: str, as_of: Moment, table_format: str = FORMAT
) -> None:
    """Append one load, stamped and partitioned by its date.

    Many small payload files would become as many small table files, hence the
    rebalancing to files of the advised size.
    """
    (
        with_load_columns(df, as_of)
        .hint("rebalance")
        .write.format(table_format)
        .mode("append")
        .partitionBy("load_date")
        .save(path)
    )


def loads_since(bronze: DataFrame, load_date: str | None) -> DataFrame:
    """Restrict a bronze table to recent loads; prunes partitions."""
    if load_date is None:
        return bronze
    return bronze.filter(F.col("load_date") >= F.lit(load_date).cast("date"))


def save_as_table(df: DataFrame, name: str, table_format: str = FORMAT) -> None:
    """Full rebuild of a catalog table."""
    df.write.format(table_format).mode("overwrite").saveAsTable(name)


def save_to_path(df: DataFrame, path: str, table_format: str = FORMAT) -> DataFrame:
    """Full rebuild of a table by path; returns the stored rows."""
    df.write.format(table_format).mode("overwrite").save(path)
    return read_table(df.sparkSession, path, df.schema, table_format)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
