"""Lets Python workers import this package from where the driver did."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """Add the package's folder to the workers' search path.

    Where executors have the package installed this changes nothing.
    """
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{ROOT}".strip(":")
    return spark
