"""Connected components of a graph by alternating stars, as joins and groupings over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortrail.operators.skew import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node goes to the node's smallest neighbour, or to the node if that is smaller."""
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
    least = both.groupBy("a").agg(F.expr("least(a, min(b))").alias("least"))
    return both.where("b > a").join(least, "a").selectExpr("b AS a", "least AS b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    down = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").where("b > least").selectExpr("b AS a", "least AS b")
    return moved.unionByName(least.selectExpr("a", "least AS b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `edges` (a, b) that is not the smallest of its component; root: the smallest.

    Self-links and repeated links do no harm. Each round is written to the shared folder, which cuts the lineage.
    """
    edges = materialize(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    state = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        # Equal count and sum of hashes: no link moved. Both are sums, so nothing but one row comes back.
        found = edges.agg(F.count("*"), F.sum(F.expr("CAST(xxhash64(a, b) AS decimal(38, 0))"))).first()
        if tuple(found) == state:
            return edges.selectExpr("a AS node", "b AS root")
        state = tuple(found)
