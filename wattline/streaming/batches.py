"""Stores fed by micro-batches.

A micro-batch writes ``<store>/new/batch_id=N`` with overwrite, so a batch that
is retried after a failure replaces its own output and nothing else. A folder
counts once its write has committed. Each store belongs to one checkpoint.

A tick every few seconds leaves many small folders. ``compact`` rewrites the
batches since the last call as one segment ``<store>/merged/batch_id=N``, named
by its last batch; the stretches that segments cover never overlap, and no row
is rewritten twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattline.operators import storage


def _new(store: str) -> str:
    return f"{store}/new"


def _merged(store: str) -> str:
    return f"{store}/merged"


def _folder(area: str, batch_id: int) -> str:
    return f"{area}/batch_id={batch_id}"


def _committed(spark: SparkSession, area: str) -> list[int]:
    names = storage.complete_children(spark, area, "batch_id=*")
    return sorted(int(name.split("=", 1)[1]) for name in names)


def _read(spark: SparkSession, folders: list[str], schema) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def write_batch(df: DataFrame, store: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_folder(_new(store), batch_id))


def _layout(spark: SparkSession, store: str) -> tuple[list[int], list[int]]:
    """Ids of the segments, and of the finished batches after the last segment."""
    segments = _committed(spark, _merged(store))
    upto = segments[-1] if segments else -1
    return segments, [i for i in _committed(spark, _new(store)) if i > upto]


def read_store(spark: SparkSession, store: str, schema) -> DataFrame:
    segments, later = _layout(spark, store)
    folders = [_folder(_merged(store), i) for i in segments]
    return _read(spark, folders + [_folder(_new(store), i) for i in later], schema)


def compact(
    spark: SparkSession,
    store: str,
    schema,
    fold: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Turn the batches since the last call into one segment, reduced by ``fold``.

    The segment counts only once it has committed. The batches it covers stay until
    the next call, so a reader that listed them just before still finds them; only
    what earlier segments cover is removed.
    """
    segments, later = _layout(spark, store)
    if not later:
        return
    rows = _read(spark, [_folder(_new(store), i) for i in later], schema)
    # Rebalancing joins the small inputs into files of the advised size.
    fold(rows).hint("rebalance").write.mode("overwrite").parquet(_folder(_merged(store), later[-1]))
    for done in _committed(spark, _new(store)):
        if segments and done <= segments[-1]:
            storage.remove(spark, _folder(_new(store), done))


def read_state(spark: SparkSession, store: str, before: int, schema) -> DataFrame:
    """The state left by the last finished batch before this one."""
    earlier = [i for i in _committed(spark, _new(store)) if i < before]
    return _read(spark, [_folder(_new(store), i) for i in earlier[-1:]], schema)


def forget_states(spark: SparkSession, store: str, before: int) -> None:
    """Keep the state a retry of batch ``before`` would need, drop older ones."""
    earlier = [i for i in _committed(spark, _new(store)) if i < before]
    for old in earlier[:-1]:
        storage.remove(spark, _folder(_new(store), old))
