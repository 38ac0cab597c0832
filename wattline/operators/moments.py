"""Count, sum and sum of squared deviations that can be stored and merged.

Merging never subtracts squares of large numbers: deviations of the parts' means are
taken from the common mean, which a first small aggregate finds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squares(value: str) -> Column:
    """Aggregate: squared deviations from the group's own mean; 0.0 without a value."""
    return F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0))


def merged(
    parts: DataFrame,
    by: Sequence[str],
    count: str,
    total: str,
    deviations: str,
    more: Sequence[Column] = (),
) -> DataFrame:
    """One row per group with the moments of all its parts; NULL keys form groups.

    ``more`` are further aggregates over the parts. A part without moments (stored
    before they were kept) leaves its group without.
    """
    by = list(by)
    centres = parts.groupBy(*[F.col(k).alias(f"_of_{k}") for k in by]).agg(
        F.try_divide(F.sum(total), F.sum(count)).alias("_centre")
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by])
    apart = F.try_divide(total, count) - F.col("_centre")
    # A part without values has no mean and adds nothing.
    square = F.col(deviations) + F.coalesce(F.col(count) * apart * apart, F.lit(0.0))
    complete = F.count(F.lit(1)) == F.count(deviations)
    return parts.join(centres, same).groupBy(*by).agg(
        F.sum(count).alias(count),
        F.sum(total).alias(total),
        F.when(complete, F.sum(square)).alias(deviations),
        *more,
    )


def mean(count: str, total: str) -> Column:
    return F.try_divide(total, count)


def sample_deviation(count: str, deviations: str) -> Column:
    """NULL for fewer than two values."""
    return F.when(F.col(count) > 1, F.sqrt(F.col(deviations) / (F.col(count) - 1)))
