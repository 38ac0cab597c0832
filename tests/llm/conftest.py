import pytest
from pyspark.sql import types as T

from wattline.llm.workers import importable

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
)

SMALL = "/root/testdata/sf0.01"
TINY = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """A frame ``(doc_id, text)`` from pairs, or from texts that get numbers."""
    importable(spark)

    def make(rows):
        pairs = [r if isinstance(r, tuple) else (k, r) for k, r in enumerate(rows)]
        return spark.createDataFrame(pairs, DOCUMENTS)

    return make


@pytest.fixture
def given(spark):
    """A given table as a frame."""
    importable(spark)
    return lambda name, folder=SMALL: spark.read.parquet(f"{folder}/{name}.parquet")
