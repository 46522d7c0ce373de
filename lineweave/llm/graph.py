"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.operators import graph


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): each linked node with the smallest node that it reaches.

    Links may repeat, run both ways or join a node to itself; nulls link nothing.
    """
    one = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    both = one.unionByName(one.select(F.col("y").alias("x"), F.col("x").alias("y")))
    return graph.components(both.select(F.col("x").alias("node")), both, "node")
