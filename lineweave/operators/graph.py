"""Street networks as edge tables: degrees, contraction of degree-2 nodes and components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.operators.tables import SMALL, remove, written


def ends(edges: DataFrame, edge: str, a: str, b: str) -> DataFrame:
    """Both ends of every edge, without unknown ones: (edge, node); a loop has its node twice."""
    both = F.explode(F.array(F.col(a), F.col(b)))
    return edges.select(F.col(edge).alias("edge"), both.alias("node")).where(F.col("node").isNotNull())


def degrees(edges: DataFrame, edge: str, a: str, b: str) -> DataFrame:
    return ends(edges, edge, a, b).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def through_pairs(edges: DataFrame, edge: str, a: str, b: str) -> DataFrame:
    """Pairs (x, y), both ways, of different edges that meet at a node where nothing else does."""
    at = ends(edges, edge, a, b).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("edge").alias("x"), F.max("edge").alias("y"))
    one = at.where("n = 2 and x <> y").select("x", "y")
    return one.unionByName(one.select(F.col("y").alias("x"), F.col("x").alias("y")))


def components(nodes: DataFrame, pairs: DataFrame, node: str, out: str = "component") -> DataFrame:
    """Every node with the smallest node of its component, itself if it is in no pair.

    Smallest label of the neighbours, then the label of that label, until nothing changes: about log n rounds for a
    chain of n. Each round ends in a small table, which the next one replaces.
    """
    pairs, both_ways = written(pairs.select("x", "y").distinct(), "pairs")
    first = pairs.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
    nodes = nodes.select(F.col(node).alias("node")).distinct().join(first, "node", "left")
    labels, path = written(nodes.select("node", F.least("node", "m").alias("label")), "labels")
    # Labels of few nodes are broadcast; of more, both sides of every join are shuffled.
    few = labels.count() <= SMALL
    side = F.broadcast if few else lambda df: df
    while True:
        near = pairs.join(side(labels.withColumnRenamed("node", "y")), "y").groupBy("x").agg(F.min("label").alias("m")).withColumnRenamed("x", "node")
        step = labels.join(side(near), "node", "left").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        target = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        found = step.join(side(target), "label").select("node", "old", F.least("label", "further").alias("label"))
        labels, new = written(found.coalesce(1) if few else found, "labels")
        remove(path)
        path = new
        if labels.where("label <> old").isEmpty():
            remove(both_ways)
            return labels.select(F.col("node").alias(node), F.col("label").alias(out))
        labels = labels.select("node", "label")


def blocks(edges: DataFrame, edge: str, a: str, b: str) -> DataFrame:
    """(edge, block_id): edges joined through nodes of degree 2 are one block, named by its smallest edge."""
    found = components(edges, through_pairs(edges, edge, a, b), edge, "block_id")
    return found


def end_classes(edges: DataFrame, edge: str, a: str, b: str) -> DataFrame:
    """Whether each end of an edge is a junction or dead end (degree other than 2; an unknown node counts as degree 1)."""
    known = degrees(edges, edge, a, b)
    out = edges.select(edge, a, b)
    for end, name in ((a, "from_end"), (b, "to_end")):
        out = out.join(known.select(F.col("node").alias(end), F.col("degree").alias(f"_{name}")), end, "left")
        out = out.withColumn(name, F.coalesce(f"_{name}", F.lit(1)) != 2).drop(f"_{name}")
    return out.select(edge, "from_end", "to_end")
