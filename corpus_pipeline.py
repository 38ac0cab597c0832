"""From raw documents to a training mixture, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import decontamination, langid, mixing, near_dedup, secret_scan
from wattline.llm.queries import language_rows, table
from wattline.llm.workers import importable
from wattline.operators.storage import work_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known go on; the label becomes the one found."""
    langs, model = langid.train_text(docs.select("text", "lang"))
    return langid.keep_identified(docs, language_rows(docs), langs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return near_dedup.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    model = secret_scan.sample_and_train(spark, docs)
    text = secret_scan.redact(F.col("text"), model)
    return docs.withColumn("text", text).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target marginals."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
]

#: Training, linking and raking have no practical SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    folder = work_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
