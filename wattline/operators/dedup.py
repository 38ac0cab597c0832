"""One row per key.

Both operators filter on ``row_number() = 1``. Spark prunes that filter to one
row per key inside every map task before the shuffle (window group limit), so a
key holding a third of the table sends one row per task, not a third of the
table, to the task that decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, ranked).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: str = "_ingested_at",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row of each key.

    Rows of one load share their ingestion time, so the remaining columns break
    ties by default; the survivor then depends on the rows alone.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in {*keys, newest}]
    return first_per_key(df, keys, [F.desc(newest), *[F.desc(c) for c in tiebreak]])


def prefer_first(
    df: DataFrame, keys: Sequence[str], rank: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Row from the source of lowest ``rank`` wins, whatever arrived later."""
    return first_per_key(df, keys, [F.asc(rank), *[F.asc(c) for c in tiebreak]])
