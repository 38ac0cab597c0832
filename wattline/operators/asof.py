"""Facts against the version of their member that held at the fact's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.ordered import with_last_known


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    by: Sequence[str],
    time: str,
    attributes: Sequence[str],
    starts: str = "valid_from",
    ends: str = "valid_to",
) -> DataFrame:
    """Every fact once, with the ``attributes`` and the start of its member's version.

    A version holds from its start, inclusive, to its end, exclusive; no end is open.
    A fact whose member is unknown then, or has no key or no time, gets NULLs. Versions
    without a start hold since ever; of versions with one start the last to end counts.

    Facts and versions are put into one order of member and time, and the last version
    is carried forward, so neither a member with most of the facts nor one with many
    versions gathers in one task, and no fact meets more than one version.
    """
    by, attributes = list(by), list(attributes)
    clash = {*attributes, starts} & set(facts.columns)
    if clash:
        raise ValueError(f"facts already have {sorted(clash)}")
    kind = facts.schema[time].dataType
    version = F.struct(*attributes, F.col(starts), F.col(ends))
    keys = [F.col(k).alias(f"_key{i}") for i, k in enumerate(by)]
    names = [f"_key{i}" for i in range(len(by))]
    # At one instant versions come first, an open one last among them.
    changes = history.select(
        *keys,
        F.col(starts).cast(kind).alias("_at"),
        F.lit(0).alias("_rank"),
        F.col(ends).isNull().alias("_open"),
        F.col(ends).cast(kind).alias("_until"),
        version.alias("_version"),
    )
    found = facts.select(
        *keys, F.col(time).alias("_at"), F.lit(1).alias("_rank"), F.struct(*facts.columns).alias("_fact")
    )
    line = changes.unionByName(found, allowMissingColumns=True)
    known = with_last_known(line, names, ["_at", "_rank", "_open", "_until"], "_version", "_known")
    held = F.col("_at").isNotNull() & (
        F.col(f"_known.{ends}").isNull() | (F.col("_at") < F.col(f"_known.{ends}").cast(kind))
    )
    for name in names:
        held = held & F.col(name).isNotNull()
    return known.filter("_rank = 1").select(
        "_fact.*", *[F.when(held, F.col(f"_known.{c}")).alias(c) for c in (*attributes, starts)]
    )
