"""Connected components by alternating large-star and small-star steps, all of it in shuffles.

Hub nodes: the minimum is a partial aggregate, and the join back to a hub's edges is a plain
sort-merge join, which adaptive execution splits. Lineage is cut by checkpoint() each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.lineage import checkpoint


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable. Nodes may be structs.

    Nulls and loops link nothing. An empty table gives an empty table.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    e = checkpoint(e.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    seen = _print(e)
    for _ in range(rounds if seen[0] else 0):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpoint(rest.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = _print(e)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _print(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
