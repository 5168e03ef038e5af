"""Connected components of an edge table by alternating star steps; no node list ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratestrata.llm.common import Workspace


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every node points to one other, which points to none: nothing would move any more."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("center")).unionByName(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("center"))
    )
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("center").alias("center"))
    return nodes.where("out > 1 or (out = 1 and center = 1)").isEmpty()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """`(node, component)` for every node of `edges(a, b)`; a component is named by its smallest node.

    Rounds of large-star and small-star (Kiveris et al. 2014), each a minimum per node and a join back. A node
    with very many neighbours is a skewed join key, which adaptive execution splits; its minimum is
    combined before the shuffle. Nulls, loops and repeated edges are ignored. Rounds grow with the
    logarithm of the nodes.
    """
    work = Workspace(spark, "components")
    pairs = (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and a != b").distinct()
    )
    pairs = work.store(pairs, "edges-0")
    step = 0
    if pairs.isEmpty():
        return pairs.toDF("node", "component")
    while True:
        # Minima are stored before they are joined: such a join shuffles both sides, and a node with very
        # many neighbours can be split. Large star: larger neighbours move to the smallest of the neighbourhood.
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = work.store(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"large-{step}")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = work.store(large.distinct(), f"moved-{step}")
        # small star: smaller neighbours, and the node itself, move to the smallest
        least = work.store(large.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x")), f"small-{step}")
        more = large.join(least.where("m < x"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = least.select("u", F.col("m").alias("v")).unionByName(more).distinct()
        step += 1
        pairs = work.store(small, f"edges-{step}")
        for name in (f"edges-{step - 1}", f"large-{step - 1}", f"moved-{step - 1}", f"small-{step - 1}"):
            work.drop(name)
        if _are_stars(pairs):
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
