"""Connected components of an edge table, by alternating star contraction.

Every step is a minimum per node (combined before the shuffle) and a join, so a
node with very many edges is never gathered in one place. Each round is stored
in the shared folder, which keeps the lineage short."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` (root: the smallest node of its component) for every node
    that has an edge. ``edges`` has long columns a, b; repeated edges, both
    directions and loops are allowed."""
    now = stored(edges.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.selectExpr("b as a", "a as b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a as n", "least(a, m) as m")
        large = both.join(least, F.col("a") == F.col("n")).where("b > a").selectExpr("b as a", "m as b").where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        joined = large.join(low, F.col("a") == F.col("n"))
        small = joined.selectExpr("explode(array(struct(a as a, m as b), struct(b as a, m as b))) as e").select("e.a", "e.b")
        now = stored(small.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.selectExpr("a as node", "b as root").unionByName(now.selectExpr("b as node", "b as root").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them: equal once nothing changes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
