"""Connected components of an edge list, as repeated grouped minima.

Large-star and small-star steps alternate until the edges are stars around their
component's smallest node. A node's neighbours are never gathered: each step
takes a grouped minimum, combined in the map tasks, and joins it back, so a hub
is a skewed join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.tables import Scratch

#: Far above the logarithm of any number of nodes.
MOST_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """Each node ``w`` with the smallest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m")
    )


def _moved(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Every edge's far end, tied to what is smallest around the near one."""
    return edges.join(least, F.col("u") == F.col("w")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (u, v)``; the component is its smallest node."""
    scratch = Scratch(edges.sparkSession, "components")
    stars = scratch.stored(_oriented(edges.select("u", "v")), "0")
    mark = None
    for k in range(MOST_ROUNDS):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: larger neighbours move to the smallest neighbour.
        large = _oriented(_moved(both.where("v > u"), _least(both)))
        # Small star: a node and its smaller neighbours move to the smallest.
        least = _least(large)
        own = least.select(F.col("w").alias("u"), F.col("m").alias("v"))
        stars = scratch.stored(_oriented(_moved(large, least).unionByName(own)), str(k + 1))
        scratch.drop(str(k))
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
