"""Tables that change all at once: data in numbered folders, one pointer written last.

A commit writes the partitions it changes into ``<table>/v=<number>`` and then one
small file ``<table>/_commits/<number>.json`` that names, for every partition of the
table, the folder that holds it. The file appears by a rename that does not replace,
so a commit is there or not. Readers resolve the newest pointer and open nothing else:
a reader that began before a commit keeps the older folders, and a job that dies leaves
a folder nobody points to, which the next commit of that number clears.

The commit's number is also the number of the load that it stores. ``consumed`` records
how far the commit has read other tables, so a table and the mark of what went into it
change together.

Folders that no pointer of the last ``KEEP`` commits names are removed by ``vacuum``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wattline.operators import storage

COMMITS = "_commits"

#: Commits whose folders a vacuum leaves for readers that are still at work.
KEEP = 2


@dataclass(frozen=True)
class Pointer:
    """What a table is made of after commit ``number``.

    ``folders`` maps a partition's folder name (empty for a table without partitions) to
    the number of the commit that wrote it.
    """

    number: int = 0
    folders: Mapping[str, int] = field(default_factory=dict)
    consumed: Mapping[str, int] = field(default_factory=dict)
    schema: str | None = None

    def since(self, number: int) -> dict[str, int]:
        """The partitions written after commit ``number``."""
        return {name: n for name, n in self.folders.items() if n > number}


def _file(path: str, number: int) -> str:
    return f"{path}/{COMMITS}/{number:020d}.json"


def folder(path: str, number: int) -> str:
    return f"{path}/v={number}"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits, oldest first."""
    names = storage.children(spark, f"{path}/{COMMITS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] not in "._")


def pointer(spark: SparkSession, path: str, number: int | None = None) -> Pointer:
    """The newest pointer, or that of one commit; a table without commits is empty."""
    known = numbers(spark, path)
    if not known:
        return Pointer()
    text = storage.read_text(spark, _file(path, known[-1] if number is None else number))
    return Pointer(**json.loads(text))


def read(
    spark: SparkSession, path: str, at: Pointer | None = None, since: int = 0
) -> DataFrame | None:
    """Rows of the partitions written after commit ``since``; ``None`` if there never was a commit.

    The partition column is read back from the folder names.
    """
    at = pointer(spark, path) if at is None else at
    if at.schema is None:
        return None
    schema = T.StructType.fromJson(json.loads(at.schema))
    wanted = at.since(since)
    if not wanted:
        return spark.createDataFrame([], schema)
    parts = []
    for number in sorted(set(wanted.values())):
        home = folder(path, number)
        own = [f"{home}/{name}".rstrip("/") for name, n in wanted.items() if n == number]
        parts.append(spark.read.schema(schema).option("basePath", home).parquet(*own))
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def commit(
    spark: SparkSession,
    path: str,
    base: Pointer,
    rows: DataFrame | None,
    partition_by: str | None,
    consumed: Mapping[str, int] | None = None,
    replace: bool = False,
) -> Pointer:
    """Store ``rows`` as the new content of the partitions they fall into.

    ``base`` is the pointer the rows were computed from: if another writer has committed
    since, the pointer's file exists already and the commit fails without effect. With
    ``replace`` partitions that the rows do not name are no longer part of the table.
    Without rows only ``consumed`` moves on.
    """
    number = base.number + 1
    folders, schema = {} if replace else dict(base.folders), base.schema
    if rows is not None:
        home = folder(path, number)
        if number in numbers(spark, path):
            raise RuntimeError(f"{path}: commit {number} exists; another writer was faster")
        storage.remove(spark, home)
        if partition_by is None:
            rows.write.parquet(home)
            folders = {"": number}
        else:
            # Rebalancing lets adaptive execution split a partition value that holds
            # much of the data and join small ones, so files come out evenly sized.
            rows.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(home)
            folders |= {n: number for n in storage.children(spark, home) if "=" in n}
        schema = rows.schema.json()
    new = Pointer(number, folders, dict(base.consumed) | dict(consumed or {}), schema)
    text = json.dumps({"number": number, "folders": folders, "consumed": dict(new.consumed), "schema": schema})
    storage.write_text_once(spark, _file(path, number), text)
    return new


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove folders and pointers that the last ``keep`` commits do not need."""
    known = numbers(spark, path)
    if not known:
        return
    kept = known[-keep:]
    named = {(n, name) for k in kept for name, n in pointer(spark, path, k).folders.items()}
    homes = {n for n, _ in named}
    # A folder above the newest commit may be a commit under way.
    for home in storage.children(spark, path):
        number = int(home[2:]) if home.startswith("v=") else known[-1] + 1
        if number <= known[-1] and number not in homes:
            storage.remove(spark, f"{path}/{home}")
        elif number in homes:
            for name in storage.children(spark, f"{path}/{home}"):
                if "=" in name and (number, name) not in named:
                    storage.remove(spark, f"{path}/{home}/{name}")
    for old in known[:-keep]:
        storage.remove(spark, _file(path, old))


def replace(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Rebuild a table without partitions; returns the stored rows."""
    commit(spark, path, pointer(spark, path), rows, None, replace=True)
    return read(spark, path)
