"""Folders: work space on shared storage, and small file-system questions.

Paths go through Hadoop's file system, so any storage Spark reads will do.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DONE_MARKER = "_SUCCESS"


def _handle(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _handle(spark, path)
    return fs.exists(p)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a Spark write into ``path`` has committed."""
    return exists(spark, f"{path}/{DONE_MARKER}")


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _handle(spark, path)
    if not fs.exists(p):
        return []
    return [status.getPath().getName() for status in fs.listStatus(p)]


def complete_children(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names of the folders below ``path`` whose write has committed, in one request."""
    fs, p = _handle(spark, f"{path}/{pattern}/{DONE_MARKER}")
    return [status.getPath().getParent().getName() for status in fs.globStatus(p) or []]


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _handle(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move ``source`` into the place of ``target``."""
    fs, new = _handle(spark, source)
    _, old = _handle(spark, target)
    fs.mkdirs(old.getParent())
    if fs.exists(old):
        fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"cannot move {source} to {target}")


def files_by_folder(spark: SparkSession, path: str, pattern: str) -> dict[str, int]:
    """Number of visible files in each folder below ``path`` that matches, in one request."""
    fs, p = _handle(spark, f"{path}/{pattern}/*")
    found: dict[str, int] = {}
    for status in fs.globStatus(p) or []:
        if status.getPath().getName()[0] not in "._":
            name = status.getPath().getParent().getName()
            found[name] = found.get(name, 0) + 1
    return found


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    fs, p = _handle(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole or not at all, and never replaces another."""
    fs, p = _handle(spark, path)
    _, fresh = _handle(spark, f"{p.getParent()}/.{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    stream = fs.create(fresh, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    keep_others = spark.sparkContext._gateway.new_array(kind, 1)
    keep_others[0] = kind.NONE
    hadoop.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, p, keep_others)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder: executors elsewhere could not read it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="wattline-")
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
        fs, folder = _handle(spark, current)
        fs.deleteOnExit(folder)
    return named or current


def work_folder(spark: SparkSession, label: str) -> str:
    """A path in a fresh folder below the checkpoint folder; the path itself does not exist.

    Results may be read from it lazily, so the folder goes when the driver ends.
    """
    home = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    fs, folder = _handle(spark, home)
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return f"{home}/data"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are fixed and survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
