"""Points in polygons of many edges.

A polygon is prepared once: its edges are cut into slabs across the axis along which they overlap least, so that a point
tests the edges of its slab and not all. Slabs are rows, so a boundary of any length is spread over tasks, and a point
meets its slab by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.functions import geometry as G
from lineweave.operators import tables
from lineweave.operators.joins import mixed_box_join

EDGES = 16  #: of a slab, about


def prepared(polygons: DataFrame, key: str, g: str = "g", edges: int = EDGES) -> tuple[DataFrame, DataFrame]:
    """(key, its box, turned, low, step, slabs) of each polygon, and (key, slab, e) with the edges that touch each of its slabs.

    With ``turned`` the slabs lie across x, and edges have x and y exchanged, as the points that are tested must have.
    """
    sides = polygons.select(key, F.explode(G.sides(F.col(g))).alias("e")).select(key, "e.*")
    sides, _ = tables.written(sides, "sides")
    box = {f"{s}{a}": f(g(f"{a}1", f"{a}2")) for a in "xy" for s, f, g in (("low", F.min, F.least), ("high", F.max, F.greatest))}
    run = {f"run{a}": F.sum(F.abs(F.col(f"{a}2") - F.col(f"{a}1"))) for a in "xy"}
    plan = sides.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *(v.alias(k) for k, v in (box | run).items()))
    # How many edges a line across the axis meets on average: less is better.
    meet = lambda a: F.col(f"run{a}") / F.nullif(F.col(f"high{a}") - F.col(f"low{a}"), F.lit(0.0))
    plan = plan.withColumn("turned", F.coalesce(meet("x") < meet("y"), F.lit(False)))
    pick = lambda c: F.when(F.col("turned"), F.col(f"{c}x")).otherwise(F.col(f"{c}y"))
    slabs = F.greatest(F.ceil(F.col("n") / edges), F.lit(1)).cast("long")
    plan = plan.select(key, *box, "turned", pick("low").alias("low"), ((pick("high") - pick("low")) / slabs).alias("step"), slabs.alias("slabs"))
    plan, _ = tables.written(plan, "polygons")
    turned = lambda c: F.when(F.col("turned"), F.col(("y" if c[0] == "x" else "x") + c[1])).otherwise(F.col(c))
    cut = sides.join(tables.beside(plan), key).select(key, "low", "step", "slabs", *(turned(c).alias(c) for c in ("x1", "y1", "x2", "y2")))
    a, b = slab_of(F.least("y1", "y2")), slab_of(F.greatest("y1", "y2"))
    cut = cut.withColumn("slab", F.explode(F.sequence(a, b)))
    return plan, cut.groupBy(key, "slab").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("e"))


def slab_of(y: Column) -> Column:
    """The slab of a place along the axis, by the columns low, step and slabs; places beyond the ends count to the outer ones."""
    return F.least(F.greatest(F.when(F.col("step") > 0, F.floor((y - F.col("low")) / F.col("step"))).otherwise(0), F.lit(0)), F.col("slabs") - 1).cast("long")


def points_in(points: DataFrame, polygons: DataFrame, key: str, x: str, y: str, g: str = "g", edges: int = EDGES, closed: bool = True) -> DataFrame:
    """Pairs of a point's row and the ``key`` of each polygon that it is in or on the boundary of.

    Without ``closed`` a place on the boundary counts by halves, as in ``G.contains``, so polygons side by side share no point.

    ``points`` may have a column named ``key``: each point is then tested against that polygon only. Otherwise polygons are
    found by their boxes. Points with an unknown place are in none.
    """
    plan, slabs = prepared(polygons, key, g, edges)
    asks = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if key in points.columns:
        asked = asks.join(tables.beside(plan), key)
    else:
        finest = plan.agg(F.greatest(F.min(F.greatest(F.col("highx") - F.col("lowx"), F.col("highy") - F.col("lowy"))), F.lit(1e-6))).first()[0]
        asks = asks.withColumns({"_px": F.col(x), "_py": F.col(y)})
        asked = mixed_box_join(asks, plan, [("_px", "_px"), ("_py", "_py")], [("lowx", "highx"), ("lowy", "highy")], finest or 1.0)
    u, v = F.when(F.col("turned"), F.col(y)).otherwise(F.col(x)), F.when(F.col("turned"), F.col(x)).otherwise(F.col(y))
    asked = asked.withColumns({"_u": u, "_v": v}).withColumn("slab", slab_of(F.col("_v")))
    inside = asked.join(slabs, [key, "slab"]).where((G.covers if closed else G.contains)(F.col("e"), F.col("_u"), F.col("_v")))
    return inside.select(*points.columns, *([] if key in points.columns else [key]))
