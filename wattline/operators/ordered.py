"""Order-dependent operators for series of any size.

A window over one series would sort that whole series in one task. Here the
rows are range-partitioned on the full sort key instead, so a hot series, or
even a hot instant, spreads over many tasks. Each slice is a contiguous stretch
of the order; what a slice needs from its predecessors is one small row per
slice and series, carried over by a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.storage import cut_lineage

SLICE = "_slice"
POSITION = "_position"


def sliced(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number contiguous slices, and the rows, of the total order ``(by, order)``.

    ``order`` should end in a unique column. The result is checkpointed because
    the numbers must not change between the two sides of a later join.
    """
    keys = [*by, *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return cut_lineage(
        placed.withColumn(SLICE, F.spark_partition_id()).withColumn(
            POSITION, F.monotonically_increasing_id()
        )
    )


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "previous",
) -> DataFrame:
    """Add the preceding row's ``value`` within each series (NULL for the first).

    All series form one sequence; the preceding row counts if its series is the
    same. The window over slices sees one row per slice.
    """
    rows = sliced(df, by, order)
    row = F.struct(*by, value)
    local = rows.withColumn("_here", F.lag(row).over(Window.partitionBy(SLICE).orderBy(POSITION)))

    ends = rows.groupBy(SLICE).agg(F.max_by(row, POSITION).alias("_last"))
    carried = ends.select(SLICE, F.lag("_last").over(Window.orderBy(SLICE)).alias("_carried"))

    joined = local.join(carried, SLICE, "left").withColumn(
        "_before", F.coalesce("_here", "_carried")
    )
    same_series = F.col("_before").isNotNull()
    for key in by:
        same_series = same_series & F.col("_before")[key].eqNullSafe(F.col(key))
    return joined.select(*df.columns, F.when(same_series, F.col("_before")[value]).alias(name))


def with_running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    amount: Column,
    name: str = "running",
) -> DataFrame:
    """Add the inclusive running total of ``amount`` within each series."""
    rows = sliced(df.withColumn("_amount", amount), by, order)
    inside = (
        Window.partitionBy(SLICE, *by)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumn("_here", F.sum("_amount").over(inside))

    totals = rows.groupBy(*by, SLICE).agg(F.sum("_amount").alias("_total"))
    before = (
        Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        *by, SLICE, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carried")
    )
    match = local[SLICE] == carried[SLICE]
    for key in by:
        match = match & local[key].eqNullSafe(carried[key])
    joined = local.join(carried, match, "left")
    return joined.select(
        *[local[c] for c in df.columns], (F.col("_here") + F.col("_carried")).alias(name)
    )


def with_last_known(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str = "known"
) -> DataFrame:
    """Add the newest non-null ``value`` of each series up to and including the row.

    A slice that continues a series takes over what the series' earlier slices knew
    last; only its first series can, so that is at most one row per slice.
    """
    rows = sliced(df, by, order)
    inside = (
        Window.partitionBy(SLICE, *by)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumn("_here", F.last(value, ignorenulls=True).over(inside))

    ends = rows.groupBy(*by, SLICE).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(POSITION))).alias("_last")
    )
    before = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *by, SLICE, F.last("_last", ignorenulls=True).over(before).alias("_carried")
    ).filter(F.col("_carried").isNotNull())
    match = local[SLICE] == carried[SLICE]
    for key in by:
        match = match & local[key].eqNullSafe(carried[key])
    joined = local.join(carried, match, "left")
    return joined.select(
        *[local[c] for c in df.columns], F.coalesce("_here", "_carried").alias(name)
    )
