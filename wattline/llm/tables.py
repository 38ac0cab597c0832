"""Intermediate tables in the shared folder the cluster names.

Unlike a checkpoint they are columnar and compressed, and they can be removed as
soon as nothing reads them any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattline.operators import storage


class Scratch:
    """The intermediate tables of one call, each written once."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = storage.work_folder(spark, label)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            storage.remove(self.spark, f"{self.folder}/{name}")
