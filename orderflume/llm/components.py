"""Connected components over an edge table, by alternating large and small stars.

Every round points nodes at smaller nodes of their component until nothing changes; the number of rounds grows with the
logarithm of the component size. Edges stay in tables all the way; between rounds they are written to the shared folder.
Joins on a hub's id are plain shuffle joins, whose heavy partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import stage


def star(pairs: DataFrame, small: bool) -> DataFrame:
    """One star step over edges (u, v): neighbours of u are linked to the least of them and u."""
    if small:
        near = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    linked = near.join(least, near["u"] == least["w"])
    if small:
        moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v")))
    else:
        moved = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge; root is the least node of its component.

    ``edges`` has two long columns u and v; loops, repeats and either direction are fine.
    """
    now = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        now = stage(star(star(now, small=False), small=True), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
