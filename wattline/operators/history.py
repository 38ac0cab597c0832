"""Type-2 history of a dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.time import Moment, stamp

VERSION_COLUMNS = ("valid_from", "valid_to", "is_current")


def open_history(dim: DataFrame, since: Moment) -> DataFrame:
    """First version of every member."""
    return (
        dim.withColumn("valid_from", stamp(since))
        .withColumn("valid_to", F.lit(None).cast("timestamp"))
        .withColumn("is_current", F.lit(True))
    )


def apply_changes(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    as_of: Moment,
) -> DataFrame:
    """Close the current version of changed members and open a new one.

    ``changes`` holds one row per key. A member whose attributes are equal, and
    one that is absent from ``changes``, keeps its version. Each current version
    meets at most one change, so a single keyed join decides everything.
    """
    keys, attributes = list(keys), list(attributes)
    now = stamp(as_of)
    current = dim.filter("is_current").select(
        F.struct(*keys, *attributes, "valid_from").alias("old"), *[F.col(k).alias(f"_old_{k}") for k in keys]
    )
    incoming = changes.select(
        F.struct(*keys, *attributes).alias("new"), *[F.col(k).alias(f"_new_{k}") for k in keys]
    )
    on_key = [F.col(f"_old_{k}") == F.col(f"_new_{k}") for k in keys]
    pairs = current.join(incoming, on_key, "full")

    differs = reduce(or_, [~F.col(f"old.{a}").eqNullSafe(F.col(f"new.{a}")) for a in attributes])
    known, offered = F.col("old").isNotNull(), F.col("new").isNotNull()
    replaced = known & offered & differs

    def version(side: str, start, end, is_current):
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in keys + attributes],
            start.alias("valid_from"),
            end.cast("timestamp").alias("valid_to"),
            is_current.alias("is_current"),
        )

    old_row = version(
        "old", F.col("old.valid_from"), F.when(replaced, now), ~replaced
    )
    new_row = version("new", now, F.lit(None), F.lit(True))
    rows = F.array_compact(
        F.array(F.when(known, old_row), F.when(~known | replaced, new_row))
    )
    changed = pairs.select(F.inline(rows))
    closed = dim.filter(~F.col("is_current")).select(*changed.columns)
    return closed.unionByName(changed)
