"""Repair of polygons whose rings cross, touch or repeat themselves.

The edges of all polygons are put side by side and met with those of their own polygon by a join on grid cells, so a ring
of many points is noded by many tasks and no ring is compared with itself edge by edge. Edges are split where they meet;
stretches that lie on each other an even number of times cancel, as no side of them differs under the even-odd rule. What
remains bounds the polygon's even-odd area, and is traced into simple rings, which is the only work done polygon by polygon.
Polygons of few points need no join: the edges of a batch of them meet by array arithmetic in their task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.functions import geometry as G
from lineweave.operators import tables
from lineweave.operators.joins import box_join

Point = tuple[float, float]
FEW = 64  #: points of a polygon that is repaired in its row


def _cross(o: dict[str, Column], x: Column, y: Column) -> Column:
    return (o["x2"] - o["x1"]) * (y - o["y1"]) - (o["y2"] - o["y1"]) * (x - o["x1"])


def numbered_edges(df: DataFrame, key: str, g: str) -> DataFrame:
    """(key, ring, at, of, x1, y1, x2, y2): a row for each edge, rings closed if they aren't, repeated points left out.

    ``at`` is the edge's place among the ``of`` edges of its ring.
    """
    fresh = lambda p: F.filter(p, lambda v, i: (i == 0) | (v != F.get(p, i - 1)))
    rings = df.select(key, F.posexplode(F.filter(F.col(g), lambda p: F.size(p) > 1)).alias("ring", "p"))
    rings = rings.select(key, "ring", F.when(F.get("p", F.lit(0)) != F.element_at("p", -1), F.concat("p", F.slice("p", 1, 1))).otherwise(F.col("p")).alias("p"))
    rings = rings.select(key, "ring", fresh(F.col("p")).alias("p"))
    edges = rings.select(key, "ring", F.posexplode(G.sides(F.array("p"))).alias("at", "e"), (F.size("p") - 1).alias("of"))
    return edges.select(key, "ring", "at", "of", "e.*")


def _crossing_of(e: dict[str, Column], f: dict[str, Column]) -> Column:
    """``_crossing`` on columns."""

    def level(o: dict[str, Column]) -> Column:
        turned = (o["x1"] > o["x2"]) | ((o["x1"] == o["x2"]) & (o["y1"] > o["y2"]))
        return F.struct(*(F.when(turned, o[a]).otherwise(o[b]).alias(b) for a, b in (("x2", "x1"), ("y2", "y1"), ("x1", "x2"), ("y1", "y2"))))

    def of(s: Column) -> Column:
        p, q = s["p"], s["q"]
        t1, t2 = (_cross(q, p[f"x{n}"], p[f"y{n}"]) for n in (1, 2))
        return G.bind(t1 / (t1 - t2), lambda t: F.struct((p["x1"] + t * (p["x2"] - p["x1"])).alias("x"), (p["y1"] + t * (p["y2"] - p["y1"])).alias("y")))

    return G.bind(F.struct(F.least(level(e), level(f)).alias("p"), F.greatest(level(e), level(f)).alias("q")), of)


def meetings(edges: DataFrame, key: str, size: float) -> DataFrame:
    """(key, ring, at, x, y, how): the points where an edge meets another one of its polygon.

    ``how`` is "cross" (inside both), "on" (a corner of another ring, inside this edge), "fold" (a corner of its own ring) or
    "ends" (two corners of one ring in one place, which splits nothing).
    """
    boxed = edges.withColumns({"a0": F.least("x1", "x2"), "a1": F.greatest("x1", "x2"), "b0": F.least("y1", "y2"), "b1": F.greatest("y1", "y2")})
    other = boxed.select(key, *(F.col(c).alias(f"o_{c}") for c in boxed.columns if c != key))
    axes = [("a0", "a1"), ("b0", "b1")]
    pairs = box_join(boxed, other, axes, [(f"o_{a}", f"o_{b}") for a, b in axes], size, (key,))
    pairs = pairs.where((F.col("ring") < F.col("o_ring")) | ((F.col("ring") == F.col("o_ring")) & (F.col("at") < F.col("o_at"))))
    e, f = ({c: F.col(p + c) for c in ("x1", "y1", "x2", "y2")} for p in ("", "o_"))
    sides = {"s1": _cross(e, f["x1"], f["y1"]), "s2": _cross(e, f["x2"], f["y2"]), "t1": _cross(f, e["x1"], e["y1"]), "t2": _cross(f, e["x2"], e["y2"])}
    pairs = pairs.withColumns(sides)
    proper = (F.signum("s1") * F.signum("s2") < 0) & (F.signum("t1") * F.signum("t2") < 0)
    both = _crossing_of(e, f)

    def on(side: str, p: str, n: int, q: str) -> Column:
        """Corner n of the edge q, where it lies inside the edge p."""
        x, y = F.col(f"{q}x{n}"), F.col(f"{q}y{n}")
        inside = (F.col(side) == 0) & x.between(F.col(f"{p}a0"), F.col(f"{p}a1")) & y.between(F.col(f"{p}b0"), F.col(f"{p}b1"))
        end = ((x == F.col(f"{p}x1")) & (y == F.col(f"{p}y1"))) | ((x == F.col(f"{p}x2")) & (y == F.col(f"{p}y2")))
        return F.when(inside & ~end, F.struct(x.alias("x"), y.alias("y")))

    def hit(p: str, point: Column, how: Column) -> Column:
        return F.when(point.isNotNull(), F.struct(F.col(f"{p}ring").alias("ring"), F.col(f"{p}at").alias("at"), point.alias("p"), how.alias("how")))

    same = lambda n, m: (F.col(f"x{n}") == F.col(f"o_x{m}")) & (F.col(f"y{n}") == F.col(f"o_y{m}"))
    # Within a ring edge k ends where k + 1 begins; any other shared corner is a touch, seen where both edges begin there.
    touch = (F.col("ring") == F.col("o_ring")) & same(1, 1)
    crossing, other_ring = F.when(proper, both), F.when(F.col("ring") == F.col("o_ring"), "fold").otherwise("on")
    found = F.array(
        hit("", crossing, F.lit("cross")), hit("o_", crossing, F.lit("cross")), hit("", on("s1", "", 1, "o_"), other_ring), hit("", on("s2", "", 2, "o_"), other_ring),
        hit("o_", on("t1", "o_", 1, ""), other_ring), hit("o_", on("t2", "o_", 2, ""), other_ring), hit("", F.when(touch, F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))), F.lit("ends")),
    )
    hits = pairs.select(key, F.explode(F.filter(found, lambda h: h.isNotNull())).alias("h"))
    return hits.select(key, "h.ring", "h.at", "h.p.x", "h.p.y", "h.how")


def boundary(edges: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """(key, a, b, n): the noded stretches, each once with its lesser end first, and how often the rings run along it."""
    cuts = hits.where("how <> 'ends'").groupBy(key, "ring", "at").agg(F.collect_set(F.struct("x", "y")).alias("cuts"))
    first, last = (F.struct(F.col(f"x{n}").alias("x"), F.col(f"y{n}").alias("y")) for n in (1, 2))
    away = lambda p: (p["x"] - F.col("x1")) * (F.col("x2") - F.col("x1")) + (p["y"] - F.col("y1")) * (F.col("y2") - F.col("y1"))
    inner = F.transform(F.array_sort(F.transform(F.coalesce("cuts", F.array().cast("array<struct<x:double,y:double>>")), lambda p: F.struct(away(p).alias("d"), p.alias("p")))), lambda s: s["p"])
    path = edges.join(cuts, [key, "ring", "at"], "left").select(key, F.concat(F.array(first), inner, F.array(last)).alias("p"))
    steps = path.select(key, F.explode(F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"), F.slice("p", 2, F.size("p") - 1).alias("b"))).alias("s"))
    steps = steps.where("s.a <> s.b").select(key, F.least("s.a", "s.b").alias("a"), F.greatest("s.a", "s.b").alias("b"))
    return steps.groupBy(key, "a", "b").agg(F.count(F.lit(1)).alias("n"))


def trace(a: np.ndarray, b: np.ndarray) -> list[list[Point]]:
    """Simple closed rings, the area on their left, from stretches (ends as rows x, y) of which an even number meets at each point."""
    around: dict[Point, list[Point]] = {}
    ends = [(tuple(p), tuple(q)) for p, q in zip(a.tolist(), b.tolist())]
    for p, q in ends:
        around.setdefault(p, []).append(q)
        around.setdefault(q, []).append(p)
    for p, near in around.items():
        near.sort(key=lambda q: math.atan2(q[1] - p[1], q[0] - p[0]))
    turn = {(p, q): near[k - 1] for q, near in around.items() for k, p in enumerate(near)}  # from p to q, and on: clockwise from where it came

    def inside(p: Point, q: Point) -> bool:
        """Whether the area is left of the step from p to q, which isn't level: by the stretches to the right of its middle."""
        x, y = (p[0] + q[0]) / 2, (p[1] + q[1]) / 2
        if len(ends) <= FEW:
            past = [u for u, v in ends if (u[1] > y) != (v[1] > y) and u[0] + (y - u[1]) / (v[1] - u[1]) * (v[0] - u[0]) > x and (u, v) != (p, q) and (u, v) != (q, p)]
            return (len(past) % 2 == 1) != (q[1] > p[1])
        spans = (a[:, 1] > y) != (b[:, 1] > y)
        u, v = a[spans], b[spans]
        own = ((u == p).all(1) & (v == q).all(1)) | ((u == q).all(1) & (v == p).all(1))
        right = (u[:, 0] + (y - u[:, 1]) / (v[:, 1] - u[:, 1]) * (v[:, 0] - u[:, 0]) > x) & ~own
        return (int(right.sum()) % 2 == 1) != (q[1] > p[1])

    rings, left = [], dict.fromkeys(s for p, q in ends for s in ((p, q), (q, p)))
    while left:
        step = next(iter(left))
        path = []
        while step in left:
            del left[step]
            path.append(step[0])
            step = (step[1], turn[step])
        if not inside(*next((p, q) for p, q in zip(path, path[1:] + path[:1]) if p[1] != q[1])):
            continue
        stack: list[Point] = []
        seen: dict[Point, int] = {}
        for p in [*path, path[0]]:  # a point that comes again closes a ring of its own
            if p in seen:
                loop = stack[seen[p] :]
                for q in loop:
                    del seen[q]
                del stack[len(stack) - len(loop) :]
                if len(loop) > 2:
                    k = loop.index(min(loop))
                    rings.append([*loop[k:], *loop[: k + 1]])
            seen[p] = len(stack)
            stack.append(p)
    return sorted(rings)


def traced(stretches: DataFrame, key: str) -> DataFrame:
    """(key, g): the rings of each polygon's stretches."""
    kind = stretches.schema[key].dataType.simpleString()
    rows = stretches.groupBy(key).agg(F.collect_list(F.struct(F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
        for batch in batches:
            found = []
            for s in batch.column("s").to_pylist():
                p = np.array([[e["x1"], e["y1"], e["x2"], e["y2"]] for e in s])
                found.append([[{"x": x, "y": y} for x, y in r] for r in trace(p[:, :2], p[:, 2:])])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, ring)], [key, "g"])

    return rows.mapInArrow(run, f"{key} {kind}, g {G.PARTS}")


def _runs(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each range of whole numbers, its end left out, its row and each number in it."""
    n = np.maximum(high - low, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, low[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]


def _edges_of(column: pa.Array) -> tuple[np.ndarray, ...]:
    """``numbered_edges`` of a batch: (row, ring, edges of the ring, x1, y1, x2, y2), rings numbered through."""
    each = lambda c: pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    rings = column.flatten()
    points = rings.flatten()
    x, y = (pc.struct_field(points, c).to_numpy(zero_copy_only=False) for c in "xy")
    of, n = np.repeat(np.arange(len(column)), each(column)), each(rings)
    begin = np.cumsum(n) - n
    of, n, begin = of[n > 1], n[n > 1], begin[n > 1]
    last = begin + n - 1
    ring, at = _runs(np.zeros(len(n), dtype=np.int64), n + ((x[begin] != x[last]) | (y[begin] != y[last])))
    at = begin[ring] + at % n[ring]
    x, y = x[at], y[at]
    fresh = np.concatenate(([True], (np.diff(ring) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)))[: len(x)]
    x, y, ring = x[fresh], y[fresh], ring[fresh]
    k = np.flatnonzero(np.diff(ring) == 0)
    return of[ring[k]], ring[k], (np.bincount(ring, minlength=len(n)) - 1)[ring[k]], x[k], y[k], x[k + 1], y[k + 1]


def _crossing(i: np.ndarray, j: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where edges cross: the same to the last bit whichever way they run and whichever is named first, so that stretches of edges
    that lie on each other still do when both are cut."""
    turned = (ends[:, 0] > ends[:, 2]) | ((ends[:, 0] == ends[:, 2]) & (ends[:, 1] > ends[:, 3]))
    ends = np.where(turned[:, None], ends[:, [2, 3, 0, 1]], ends)
    rank = np.empty(len(ends), dtype=np.int64)
    rank[np.lexsort(ends.T)] = np.arange(len(ends))
    e, f = (ends[np.where((rank[i] < rank[j]) == first, i, j)].T for first in (True, False))
    t1, t2 = ((f[2] - f[0]) * (e[n + 1] - f[1]) - (f[3] - f[1]) * (e[n] - f[0]) for n in (0, 2))
    t = t1 / (t1 - t2)
    return e[0] + t * (e[2] - e[0]), e[1] + t * (e[3] - e[1])


def _hits(row: np.ndarray, ring: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``meetings`` of a batch: (edge, x, y) where edges are to be split, and the rows that aren't valid by how edges meet."""
    i, j = _runs(np.arange(len(row)) + 1, np.searchsorted(row, row, side="right"))
    a0, a1, b0, b1 = np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2)
    near = (a1[i] >= a0[j]) & (a0[i] <= a1[j]) & (b1[i] >= b0[j]) & (b0[i] <= b1[j])
    i, j = i[near], j[near]
    cross = lambda e, x, y: (x2[e] - x1[e]) * (y - y1[e]) - (y2[e] - y1[e]) * (x - x1[e])
    s1, s2, t1, t2 = cross(i, x1[j], y1[j]), cross(i, x2[j], y2[j]), cross(j, x1[i], y1[i]), cross(j, x2[i], y2[i])
    same = ring[i] == ring[j]
    k = np.flatnonzero((np.sign(s1) * np.sign(s2) < 0) & (np.sign(t1) * np.sign(t2) < 0))
    px, py = _crossing(i[k], j[k], np.column_stack((x1, y1, x2, y2)))
    found, bad = [(i[k], px, py), (j[k], px, py)], [row[i[k]]]
    for side, e, x, y in ((s1, i, x1[j], y1[j]), (s2, i, x2[j], y2[j]), (t1, j, x1[i], y1[i]), (t2, j, x2[i], y2[i])):
        inside = (side == 0) & (x >= a0[e]) & (x <= a1[e]) & (y >= b0[e]) & (y <= b1[e])
        inside &= ~(((x == x1[e]) & (y == y1[e])) | ((x == x2[e]) & (y == y2[e])))
        found.append((e[inside], x[inside], y[inside]))
        bad.append(row[e[inside & same]])
    bad.append(row[i[same & (x1[i] == x1[j]) & (y1[i] == y1[j])]])
    return *(np.concatenate(v) for v in zip(*found)), np.concatenate(bad)


def _stretches(row: np.ndarray, ends: tuple[np.ndarray, ...], hits: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """``boundary`` of a batch: (row, ax, ay, bx, by, how often), rows rising."""
    x1, y1, x2, y2 = ends
    e, x, y = hits
    every, none = np.arange(len(row)), np.zeros(len(row))
    of, rank = np.concatenate((every, e, every)), np.repeat((0, 1, 2), (len(row), len(e), len(row)))
    d = np.concatenate((none, (x - x1[e]) * (x2[e] - x1[e]) + (y - y1[e]) * (y2[e] - y1[e]), none))
    x, y = np.concatenate((x1, x, x2)), np.concatenate((y1, y, y2))
    order = np.lexsort((y, x, d, rank, of))
    of, x, y = of[order], x[order], y[order]
    k = np.flatnonzero((np.diff(of) == 0) & ((np.diff(x) != 0) | (np.diff(y) != 0)))
    turned = (x[k] > x[k + 1]) | ((x[k] == x[k + 1]) & (y[k] > y[k + 1]))
    a, b = np.where(turned, k + 1, k), np.where(turned, k, k + 1)
    found = [row[of[k]], x[a], y[a], x[b], y[b]]
    order = np.lexsort(found[::-1])
    found = [v[order] for v in found]
    new = np.concatenate(([True], np.any([np.diff(v) != 0 for v in found], axis=0)))[: len(k)]
    first = np.flatnonzero(new)
    return *(v[first] for v in found), np.diff(np.append(first, len(k)))


def _repaired(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Polygons of a batch, repaired where they aren't valid, and which of them were."""
    row, ring, of, *ends = _edges_of(column)
    e, x, y, crossed = _hits(row, ring, *ends)
    at, ax, ay, bx, by, n = _stretches(row, tuple(ends), (e, x, y))
    bad = np.zeros(len(column), dtype=bool)
    bad[np.concatenate((crossed, at[n > 1], row[of < 3])).astype(np.int64)] = True
    keep = np.flatnonzero((n % 2 == 1) & bad[at])
    at, a, b = at[keep], np.column_stack((ax[keep], ay[keep])), np.column_stack((bx[keep], by[keep]))
    wrong = np.flatnonzero(bad)
    first, last = np.searchsorted(at, wrong, side="left"), np.searchsorted(at, wrong, side="right")
    rings = [trace(a[p:q], b[p:q]) for p, q in zip(first.tolist(), last.tolist())]
    points = np.array([v for g in rings for r in g for v in r], dtype=float).reshape(-1, 2)
    starts = lambda sizes: pa.array(np.cumsum([0, *sizes]), pa.int32())
    flat = pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], names=["x", "y"])
    mended = pa.ListArray.from_arrays(starts(map(len, rings)), pa.ListArray.from_arrays(starts(len(r) for g in rings for r in g), flat))
    pick = np.arange(len(column))
    pick[wrong] = len(column) + np.arange(len(wrong))
    return pa.concat_arrays([column, mended.cast(column.type)]).take(pa.array(pick)), bad


def repair_small(df: DataFrame, g: str) -> DataFrame:
    """``repair`` of polygons of few points, each in its row: edges of a batch meet by arrays, and nothing is shuffled."""

    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mended, bad = _repaired(batch.column(g))
            columns = [mended if c == g else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bad)], names=[*names, "was_repaired"])

    kinds = [T.StructField(f.name, f.dataType) for f in df.schema]
    return df.mapInArrow(run, T.StructType([*kinds, T.StructField("was_repaired", T.BooleanType())]))


def repair(df: DataFrame, key: str, g: str = "g", size: float = 50.0, few: int = FEW) -> DataFrame:
    """Adds ``was_repaired`` and replaces the geometry of polygons that aren't valid by rings around its even-odd area.

    Not valid are rings that cross or touch themselves, rings that cross or overlap each other, and rings without area. A ring
    that touches another in a point, or repeats a point in place, is valid and stays as it is. ``key`` is unique; ``size`` is
    the side of the grid's cells, somewhat above the length of most edges. A polygon without area left has no rings; an
    unknown geometry stays unknown. Polygons of up to ``few`` points are repaired in their rows, others by joins.
    """
    sound = lambda p: (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf"))
    small = F.coalesce((F.size(F.flatten(g)) <= few) & F.forall(g, lambda r: F.forall(r, sound)), F.lit(False))
    marked = tables.once(df, {"_small": small})
    large, names = marked.where("not _small").drop("_small"), [*df.columns, "was_repaired"]
    mended = repair_small(marked.where("_small").drop("_small"), g).select(*names)
    return mended if large.isEmpty() else mended.unionByName(repair_large(large, key, g, size).select(*names))


def repair_large(df: DataFrame, key: str, g: str, size: float) -> DataFrame:
    """``repair`` by joins, for polygons of any number of points."""
    edges, _ = tables.written(numbered_edges(df, key, g), "edges")
    hits, _ = tables.written(meetings(edges, key, size), "meetings")
    noded, _ = tables.written(boundary(edges, hits, key), "noded")
    crossing = hits.where("how <> 'on'").select(key)
    along = noded.where("n > 1").select(key)
    flat = edges.where("of < 3").select(key)
    bad = crossing.unionByName(along).unionByName(flat).distinct().withColumn("_bad", F.lit(True))
    mended = traced(noded.where("n % 2 = 1").join(bad.select(key), key, "left_semi"), key).withColumnRenamed("g", "_mended")
    rows = df.join(bad, key, "left").join(mended, key, "left")
    wrong = F.coalesce("_bad", F.lit(False))
    ring = F.coalesce("_mended", F.expr(f"cast(array() as {G.PARTS})"))
    return rows.withColumns({g: F.when(wrong, ring).otherwise(F.col(g)), "was_repaired": wrong}).drop("_bad", "_mended")
