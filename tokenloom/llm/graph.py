"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (columns a, b); the component is its smallest node.

    Every round points all larger neighbours of a node to its smallest one, then all smaller neighbours, until nothing
    changes. A round is two aggregations with partial sums and two joins, whatever the degree of a node.
    """
    edges = stored(_star(links.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct()))
    print_of = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    last = print_of(edges)
    while last[0]:
        edges = stored(_star(_spread(edges)))
        now = print_of(edges)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.selectExpr("a as node", "b as component").union(roots)


def _spread(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked with the smallest of the node and its neighbours."""
    both = edges.union(edges.selectExpr("b as a", "a as b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.where("b > a").join(least, "a").selectExpr("b as a", "low as b").distinct()


def _star(edges: DataFrame) -> DataFrame:
    """Each node (a > b) and its smaller neighbours are linked with the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b <> low").selectExpr("b as a", "low as b")
    return least.selectExpr("a", "low as b").union(moved).distinct()
