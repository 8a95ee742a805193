"""Connected components of an edge table by alternating star contractions; only joins, minima and row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.scratch import Scratch


def connected_components(scratch: Scratch, edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, component) for every node that has an edge to another one; component = smallest node reachable.

    Each round links every larger neighbour to the node's smallest neighbour, then every smaller neighbour likewise;
    the number of rounds is logarithmic in the size of a component.  A hub's rows are spread by the skew join, minima
    are pre-aggregated, and the driver sees one count and one checksum per round.  Rows with a null end and loops
    are ignored; an empty edge table gives an empty result.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = (edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
           .where(x.isNotNull() & y.isNotNull() & (x != y)).distinct())
    now = scratch.write(now, f"{name}-0")
    before, turn = None, 0
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state["n"] == 0 or tuple(state) == before:
            break
        before, turn = tuple(state), turn + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (now.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        following = (small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        now = scratch.write(following, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
