"""Join of a large side with a side that is expected, but not known, to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattline.operators.storage import cut_lineage


def join_fixed(large: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with a side that is computed once and stored first.

    Nothing is forced: from the stored side's measured bytes adaptive execution
    broadcasts it below the session's threshold, and beyond that runs a shuffle
    whose hot keys it splits over several tasks.
    """
    return large.join(cut_lineage(small), keys)
