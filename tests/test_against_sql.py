"""Every query against its independent SQL on the small tables."""

import pytest

from harness.compare import compare, connect
from harness.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    good, note = compare(spark, con, name, SF)
    assert good, note


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns[:3] == ["region", "source", "timestamp"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
