"""Least squares per group from sums of products that merge.

``moments`` takes counts, means and covariances of every group in one grouping;
Spark combines them before the shuffle, so a hot group sends one row per task.
``before`` merges the groups that come earlier in an order, which trains one model
for every point of time from a single pass over the rows. ``solve`` eliminates the
regressors one after another in plain columns, no matrix leaves its row.

Variables are numbered in the order given, the target last. Rows that lack one of
them are counted nowhere. A regressor that the ones before it explain gets the
coefficient zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share of a regressor's own variance that must be left for it to count.
LEAST_SPREAD = 1e-9

#: Variance, as a share of the squared mean, up to which a regressor is constant but for rounding.
ROUNDING = 1e-24

#: Rows below which a group has no model and its mean stands in.
LEAST_ROWS = 30


def _mean(i: int) -> str:
    return f"_mean_{i}"


def _cov(i: int, j: int) -> str:
    return f"_cov_{min(i, j)}_{max(i, j)}"


def _pairs(size: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(size) for j in range(i, size)]


def moments(rows: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """``_n``, means and covariances of each group; groups without a complete row keep ``_n`` 0."""
    complete = reduce(and_, [F.col(v).isNotNull() for v in variables])
    values = [F.when(complete, F.col(v).cast("double")) for v in variables]
    return rows.groupBy(*keys).agg(
        F.count(values[0]).alias("_n"),
        *[F.avg(v).alias(_mean(i)) for i, v in enumerate(values)],
        *[F.covar_pop(values[i], values[j]).alias(_cov(i, j)) for i, j in _pairs(len(values))],
    )


def before(groups: DataFrame, by: Sequence[str], order: str, size: int) -> DataFrame:
    """Moments of all groups of the same ``by`` that come earlier in ``order``.

    Products are taken around the overall mean, so little is lost by cancellation.
    The window holds one row for each group, never the rows behind it.
    """
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_n").over(whole)
    centers = groups.withColumns(
        {f"_c_{i}": F.try_divide(F.sum(F.col("_n") * F.col(_mean(i))).over(whole), total) for i in range(size)}
    )

    def off(i: int) -> Column:
        return F.col(_mean(i)) - F.col(f"_c_{i}")

    sums = {"_rows": F.coalesce(F.sum("_n").over(earlier), F.lit(0))}
    sums |= {f"_s_{i}": F.sum(F.col("_n") * off(i)).over(earlier) for i in range(size)}
    sums |= {
        f"_p_{i}_{j}": F.sum(F.col("_n") * (F.col(_cov(i, j)) + off(i) * off(j))).over(earlier)
        for i, j in _pairs(size)
    }

    def share(name: str) -> Column:
        return F.try_divide(F.col(name), F.col("_rows"))

    return centers.withColumns(sums).select(
        *by,
        order,
        F.col("_rows").alias("_n"),
        *[(F.col(f"_c_{i}") + share(f"_s_{i}")).alias(_mean(i)) for i in range(size)],
        *[(share(f"_p_{i}_{j}") - share(f"_s_{i}") * share(f"_s_{j}")).alias(_cov(i, j)) for i, j in _pairs(size)],
    )


def solve(groups: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """``keys, _n, _level, _base, _slope_0 ...``: the target's mean, intercept and coefficients.

    Intercept and coefficients are NULL for a group of fewer than ``LEAST_ROWS`` rows.
    """
    target = size - 1
    fixed = [*keys, "_n", *[_mean(i) for i in range(size)]]
    frame = groups.select(
        *fixed,
        *[F.col(_cov(i, i)).alias(f"_whole_{i}") for i in range(target)],
        *[F.col(_cov(i, j)).alias(f"_a_{i}_{j}") for i in range(target) for j in range(size)],
    )
    for k in range(target):
        pivot = F.col(f"_a_{k}_{k}")
        own, mean = F.col(f"_whole_{k}"), F.col(_mean(k))
        usable = (pivot > own * LEAST_SPREAD) & (own > mean * mean * ROUNDING)
        changed = {f"_used_{k}": F.coalesce(usable, F.lit(False))}
        for j in range(k + 1, size):
            scaled = F.try_divide(F.col(f"_a_{k}_{j}"), pivot)
            for i in range(target):
                fresh = scaled if i == k else F.col(f"_a_{i}_{j}") - F.col(f"_a_{i}_{k}") * scaled
                changed[f"_a_{i}_{j}"] = F.when(usable, fresh).otherwise(F.col(f"_a_{i}_{j}"))
        frame = frame.withColumns(changed)
    enough = F.col("_n") >= LEAST_ROWS
    slopes = [F.when(F.col(f"_used_{i}"), F.col(f"_a_{i}_{target}")).otherwise(0.0) for i in range(target)]
    solved = frame.select(
        *fixed, *[F.when(enough, slope).alias(f"_slope_{i}") for i, slope in enumerate(slopes)]
    )
    explained = reduce(add, [F.col(f"_slope_{i}") * F.col(_mean(i)) for i in range(target)])
    return solved.select(
        *keys,
        "_n",
        F.col(_mean(target)).alias("_level"),
        (F.col(_mean(target)) - explained).alias("_base"),
        *[f"_slope_{i}" for i in range(target)],
    )


def predicted(regressors: Sequence[str]) -> Column:
    """The model's value, the mean where a regressor or the model is missing."""
    effects = [F.col(f"_slope_{i}") * F.col(x) for i, x in enumerate(regressors)]
    return F.coalesce(F.col("_base") + reduce(add, effects), F.col("_level"))
