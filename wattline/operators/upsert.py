"""Keyed upsert: matched rows are replaced, new rows added, none deleted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators import versions

def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of the source and the target rows it does not replace.

    ``source`` holds one row per key. Keys are unique on both sides, so the join
    has no hot key.
    """
    t, s = target.alias("t"), source.select(*keys).alias("s")
    match = reduce(and_, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    kept = t.join(s, match, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def merge_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: str,
    stamps: Sequence[str] = (),
    number_as: str | None = None,
    consumed: Mapping[str, int] | None = None,
    replace: bool = False,
) -> None:
    """Upsert ``source`` into the table at ``path``, which ``read_merged`` reads.

    Only partitions named by the source are read and rewritten, which requires
    ``partition_by`` to be a function of the keys. With ``stamps``, source rows
    that differ from the stored ones in those columns only are left out first, so
    delivering rows again neither restamps them nor rewrites their partition.
    ``number_as`` names a column that gets the number of the load that last changed
    a row. With ``replace`` the source becomes the whole table.

    The load is one commit (see ``versions``): a job that dies on the way changes
    nothing, and a reader sees the table before or after it. ``consumed`` marks what
    the source was read from and is stored by the same commit.
    """
    base = versions.pointer(spark, path)
    stored = None if replace else versions.read(spark, path, base)
    if number_as is not None:
        source = source.withColumn(number_as, F.lit(base.number + 1).cast("long"))
        stamps = [*stamps, number_as]
    held = [source.persist()]
    try:
        merged = source
        if stored is not None:
            if stamps:
                source = _news(_touched(stored, source, partition_by), source, stamps).persist()
                held.append(source)
                if source.isEmpty():
                    if consumed and any(base.consumed.get(k) != v for k, v in consumed.items()):
                        versions.commit(spark, path, base, None, partition_by, consumed)
                    return
            merged = upsert(_touched(stored, source, partition_by), source, keys)
        versions.commit(spark, path, base, merged, partition_by, consumed, replace)
    finally:
        for frame in held:
            frame.unpersist()


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The table as its last commit left it."""
    found = versions.read(spark, path)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    return found


def _news(target: DataFrame, source: DataFrame, stamps: Sequence[str]) -> DataFrame:
    """Source rows that no stored row equals, stamps aside."""
    compared = [c for c in source.columns if c not in stamps]
    t, s = target.alias("t"), source.alias("s")
    same = reduce(and_, [F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in compared])
    return s.join(t, same, "left_anti")


def _touched(target: DataFrame, source: DataFrame, partition_by: str) -> DataFrame:
    """Target rows of the partitions that the source names, NULL among them.

    One aggregate row bounds the partition value, so folders outside the range are
    not opened; the null-safe join then keeps exactly the named partitions, however
    many there are.
    """
    value = F.col(partition_by)
    low, high, nulls = source.agg(
        F.min(value), F.max(value), F.coalesce(F.bool_or(value.isNull()), F.lit(False))
    ).first()
    wanted = value.between(low, high) if low is not None else F.lit(False)
    if nulls:
        wanted = wanted | value.isNull()
    named = source.select(partition_by).distinct()
    t, s = target.filter(wanted).alias("t"), named.alias("s")
    return t.join(s, F.col(f"t.{partition_by}").eqNullSafe(F.col(f"s.{partition_by}")), "left_semi")
