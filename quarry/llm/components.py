"""Connected components of a distributed link table, by alternating stars.

Every round hangs the larger neighbours of each node on its least neighbour and
then the smaller ones as well; the edges end as one per node, to the least node
of its component.  Each round is a table in the shared folder, so a lost
executor repeats one round at most, and no links reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._scratch import Scratch


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); component: its least node."""
    edges = scratch.keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    state = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    before, step = state(edges), 0
    while True:
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(root.select("u", F.col("m").alias("v")))
        edges = scratch.keep(small.where("u <> v").distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
