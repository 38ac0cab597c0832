"""Row-level security: a reader sees the rows of entitled members only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.joins import join_fixed


def entitled_rows(
    df: DataFrame, entitlements: DataFrame, reader: str, member: str
) -> DataFrame:
    """``entitlements`` has the columns ``reader`` and ``member``. Grants are made
    distinct, so the join repeats no row."""
    granted = (
        entitlements.filter(F.col("reader") == F.lit(reader))
        .select(F.col("member").alias(member))
        .distinct()
    )
    return join_fixed(df, granted, [member]).select(*df.columns)
