"""Connected components of a large graph by alternating star joins.

Every round first hangs the larger neighbours of each node on its smallest neighbour, then the smaller ones; the number
of rounds grows with the logarithm of the longest chain, not with its length. A round is a grouped minimum, which
combines before the shuffle, and a join, which adaptive execution splits where a node has very many links. Each round
is a table in the shared folder, so a lost executor costs one round at most; only a count comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.session import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge but the component's smallest node itself.

    ``component`` is the smallest node that can be reached. Repeated edges, loops and edges with a null end are fine;
    the latter two link nothing.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = written(edges, "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u > v"), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node that hangs on none: components are then found."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    others = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1")
    return others.agg(F.count(F.lit(1))).first()[0] == 0
