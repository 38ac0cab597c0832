"""Payload files taken once each: a file-source stream whose checkpoint is the ledger.

A run takes the files that no earlier run has taken, as one numbered delivery, and
ends. Files of earlier deliveries are neither opened nor parsed again. A delivery
lands in ``<table>/load_date=<day>/delivery=<number>`` and counts once its write has
committed. A run that dies is taken up by the next one with the same number and the
same files, and replaces whatever the dead one left, on whichever day that was.

A ledger belongs to one table, and a table filled this way holds nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.time import Moment, as_datetime
from wattline.operators import storage
from wattline.operators.contracts import REASON
from wattline.sources.payloads import page_schema
from wattline.sources.tables import FORMAT, with_load_columns

DELIVERY = "delivery"

#: A file is new whatever its modification time, as copies may keep an old one. The
#: driver then remembers every path below the folder; a shorter age bounds that.
ANY_AGE = "36500d"


def stream_pages(
    spark: SparkSession, path: str, feed: str, page_per_line: bool = False, max_age: str = ANY_AGE
) -> DataFrame:
    """Pages of a payload folder as a stream. Text that is not JSON halts the run."""
    reader = spark.readStream.schema(page_schema(feed)).options(
        multiLine=not page_per_line, mode="FAILFAST", maxFileAge=max_age
    )
    return reader.json(path)


def take_new(
    rows: DataFrame, ledger: str, land: Callable[[DataFrame, int], None]
) -> None:
    """Hand what is new in ``rows`` to ``land(batch, number)`` and record it as taken.

    An error in ``land`` ends the run with that error; nothing counts as taken then.
    """
    query = (
        rows.writeStream.option("checkpointLocation", ledger)
        .foreachBatch(land)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _folders(spark: SparkSession, path: str) -> dict[str, int]:
    """Committed deliveries by folder below the table."""
    found = {}
    for day in storage.children(spark, path):
        if day.startswith("load_date="):
            for name in storage.complete_children(spark, f"{path}/{day}", f"{DELIVERY}=*"):
                found[f"{day}/{name}"] = int(name.split("=", 1)[1])
    return found


def newest(spark: SparkSession, path: str) -> int:
    """Number of the newest delivery that has landed; -1 if none has."""
    return max(_folders(spark, path).values(), default=-1)


def land(rows: DataFrame, path: str, number: int, as_of: Moment, table_format: str = FORMAT) -> None:
    """Store one delivery in place of what an earlier try of the same number left."""
    spark = rows.sparkSession
    for day in storage.children(spark, path):
        storage.remove(spark, f"{path}/{day}/{DELIVERY}={number}")
    day = as_datetime(as_of).date().isoformat()
    stamped = with_load_columns(rows, as_of).drop("load_date")
    # Many small payload files would become as many small table files.
    stamped.hint("rebalance").write.format(table_format).save(
        f"{path}/load_date={day}/{DELIVERY}={number}"
    )


def read(
    spark: SparkSession, path: str, schema, after: int = -1, table_format: str = FORMAT
) -> DataFrame:
    """Rows of the deliveries after number ``after``; other folders are not opened.

    The delivery's number comes as a column of its own.
    """
    wanted = [folder for folder, number in _folders(spark, path).items() if number > after]
    if not wanted:
        return spark.createDataFrame([], schema).withColumn(DELIVERY, F.lit(None).cast("int"))
    rows = spark.read.format(table_format).schema(schema).option("basePath", path)
    return rows.load([f"{path}/{w}" for w in wanted])


def read_rejects(spark: SparkSession, path: str, schema: T.StructType, after: int = -1) -> DataFrame:
    """Records that a contract with ``schema`` turned away, with the reason."""
    return read(spark, path, T.StructType([*schema, T.StructField(REASON, T.StringType())]), after)
