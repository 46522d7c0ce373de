"""What transects meet first, by one exchange of stations and array arithmetic in tasks.

A station (cx, cy, ux, uy, half: a centre, a unit direction and how far it looks along it both ways) has its home in the
tile of its centre. Lines and polygons go to every tile from which a station can reach them. So a station meets all that it
can in one task, and comes out with its result: no pair leaves a task, and nothing is aggregated behind the join. Tiles are
dealt out to groups by hash; a tile with many stations is dealt out in parts, to each of which its lines go.

Inside a group pairs come from cells of a finer grid, and places of crossing from arrays over all edges of all pairs, some
hundred thousand at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.functions import geometry as G
from lineweave.operators import tables
from lineweave.operators.joins import FACTOR, _level

TILE, GROUP, PAIRS = 2000.0, 50_000, 500_000  #: side of a tile, stations of a group and edges of pairs at once, about


STATIONS = 200_000  #: that are made at once, about


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each list begins in what all lists hold, with the end."""
    return column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten()


class _Lines:
    """Lines as arrays over all their edges: where each edge begins and ends along its line."""

    def __init__(self, parts: pa.Array):
        outer, inner = _flat(parts)
        inner, flat = _flat(inner)
        x, y = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in "xy")
        size = np.diff(inner)
        begins = np.ones(len(x), dtype=bool)  # points that begin an edge: all but the last of each part
        begins[inner[1:][size > 0] - 1] = False
        a = np.flatnonzero(begins)
        self.x1, self.y1, self.x2, self.y2 = x[a], y[a], x[a + 1], y[a + 1]
        self.begin = np.concatenate(([0], np.cumsum(np.maximum(size - 1, 0))))[outer]
        self.dx, self.dy = self.x2 - self.x1, self.y2 - self.y1
        self.size = np.sqrt(self.dx * self.dx + self.dy * self.dy)
        every = np.concatenate(([0], np.cumsum(self.size.astype(np.longdouble))))
        self.base = every[self.begin]  # of all lines before; wide enough to lose nothing when it is taken off
        of = np.repeat(np.arange(len(self.begin) - 1), np.diff(self.begin))
        self.at, self.end = (every[:-1] - self.base[of]).astype(float), (every[1:] - self.base[of]).astype(float)
        self.ends = every[1:].astype(float)

    def along(self, k: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The points at distances along lines, kept between their ends, as offsets from where each line begins: far from the
        origin a difference of two places has lost more digits than one of two offsets."""
        first, last = self.begin[k], self.begin[k + 1] - 1
        e, some = first, np.flatnonzero(last > first)  # the one edge of a line is not looked for
        if len(some):
            e = first.copy()
            e[some] = self._edge(first[some], last[some], self.base[k[some]].astype(float), d[some])
        size = self.size[e]
        t = np.clip(np.divide(d - self.at[e], size, out=np.zeros_like(d), where=size > 0), 0, 1)
        x, y = self.dx[e] * t, self.dy[e] * t
        if len(some):
            x[some] += self.x1[e[some]] - self.x1[first[some]]
            y[some] += self.y1[e[some]] - self.y1[first[some]]
        return x, y

    def _edge(self, first: np.ndarray, last: np.ndarray, base: np.ndarray, d: np.ndarray) -> np.ndarray:
        e = np.clip(np.searchsorted(self.ends, base + d), first, last)
        while (back := (e > first) & (self.end[e - 1] >= d)).any():
            e = e - back
        while (on := (e < last) & (self.end[e] < d)).any():
            e = e + on
        return e


def _placed(lines: _Lines, count: np.ndarray, start: np.ndarray, span: np.ndarray, chord: float) -> tuple[np.ndarray, ...]:
    """(line, sample_no, d, cx, cy, ux, uy) of the stations on lines, those of a line together and in order."""
    count = np.where(np.diff(lines.begin) > 0, count, 0)
    k, no = _cells(np.zeros(len(count), dtype=np.int64), count - 1)
    d = start[k] + span[k] * no / np.maximum(count - 1, 1)[k]
    size = lines.end[lines.begin[k + 1] - 1]
    first, (cx, cy) = lines.begin[k], lines.along(k, d)
    cx, cy = lines.x1[first] + cx, lines.y1[first] + cy
    ax, ay = lines.along(k, np.maximum(d - chord, 0))
    bx, by = lines.along(k, np.minimum(d + chord, size))
    m = np.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))
    to = np.flatnonzero(m > 0)
    return k[to], no[to], d[to], cx[to], cy[to], -(by - ay)[to] / m[to], (bx - ax)[to] / m[to]


def stations_along(lines: DataFrame, g: str, first: Column, span: Column, n: Column, chord: float, keep: list[str]) -> DataFrame:
    """(keep, sample_no, d, cx, cy, ux, uy): ``n`` stations on each line, from ``first`` on over ``span``, their places, and the unit
    normals 90 degrees to the left of the chord over ``chord`` to both sides. Where a line comes back on itself there is no
    direction and no station; one station lies at ``first``.
    """
    rows = lines.select(*keep, F.col(g).alias("_g"), first.cast("double").alias("_first"), span.cast("double").alias("_span"), n.cast("long").alias("_n"))
    rows = rows.where("_n > 0 and flatten(_g) is not null and _first is not null and _span is not null")
    more = [T.StructField(c, T.LongType() if c == "sample_no" else T.DoubleType()) for c in ("sample_no", "d", "cx", "cy", "ux", "uy")]
    shape = T.StructType([*(rows.schema[c] for c in keep), *more])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            counts = whole.column("_n").to_numpy()
            part = np.cumsum(counts) // STATIONS
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(edges, edges[1:]):
                batch, count = whole.slice(a, b - a), counts[a:b]
                if not len(count):
                    continue
                k, *place = _placed(_Lines(batch.column("_g")), count, batch.column("_first").to_numpy(), batch.column("_span").to_numpy(), chord)
                out = [batch.column(c).take(pa.array(k)) for c in keep] + [pa.array(v) for v in place]
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in shape])

    return rows.mapInArrow(make, shape)


def _boxed_edges(lines: DataFrame, by: str, g: str) -> DataFrame:
    """(by, x1, y1, x2, y2, _x0, _x1, _y0, _y1): every edge with its box, without lambdas, which Spark does not compile."""
    parts = lines.select(by, F.explode(F.when(F.flatten(g).isNotNull(), F.col(g))).alias("p"))
    n = F.greatest(F.size("p") - 1, F.lit(0))
    a, b = F.slice("p", 1, n), F.slice("p", 2, n)
    edges = parts.select(by, F.inline(F.arrays_zip(a["x"], a["y"], b["x"], b["y"])).alias("x1", "y1", "x2", "y2"))
    box = {"_x0": F.least("x1", "x2"), "_x1": F.greatest("x1", "x2"), "_y0": F.least("y1", "y2"), "_y1": F.greatest("y1", "y2")}
    return edges.withColumns(box).where("_x0 is not null and _y0 is not null")


def _tile(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(size))


def _dealt(stations: DataFrame, lines: DataFrame, box: list[str], tile: float, group: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the number of the group that each row goes to; ``box`` names xmin, xmax, ymin, ymax of the lines."""
    at = {"_tx": _tile(F.col("cx"), tile), "_ty": _tile(F.col("cy"), tile)}
    counts, _ = tables.written(stations.select(*(v.alias(k) for k, v in at.items()), "half").groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias("n"), F.max("half").alias("far")), "tiles")
    n, far = counts.agg(F.sum("n"), F.max("far")).first()
    groups = max(1, -(-(n or 0) // group))
    crowded = counts.where(F.col("n") > group).select("_tx", "_ty", F.ceil(F.col("n") / group).cast("int").alias("_parts"))
    crowded = tables.beside(crowded)
    number = lambda part: F.pmod(F.xxhash64("_tx", "_ty", part.cast("int")), F.lit(groups)).cast("int")
    parts = F.coalesce("_parts", F.lit(1))
    mine = stations.withColumns(at).join(crowded, ["_tx", "_ty"], "left")
    mine = mine.withColumn("_group", number(F.pmod(F.xxhash64("cx", "cy", "ux", "uy"), parts))).select(*stations.columns, "_group")
    xmin, xmax, ymin, ymax = (F.col(c) for c in box)
    reach = F.lit(float(far or 0.0))
    theirs = lines
    for c, low, high in (("_tx", xmin - reach, xmax + reach), ("_ty", ymin - reach, ymax + reach)):
        theirs = theirs.withColumn(c, F.explode(F.sequence(_tile(low, tile), _tile(high, tile))))
    theirs = theirs.join(crowded, ["_tx", "_ty"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    # A line may come to one group by several tiles or parts.
    return mine, theirs.withColumn("_group", number(F.col("_part"))).select(*lines.columns, "_group")


def _cells(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each range of whole numbers its row and each number in it."""
    sizes = high - low + 1
    row = np.repeat(np.arange(len(low)), sizes)
    return row, low[row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _spread(box: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell x and cell y of the cells that each box (x0, x1, y0, y1) touches."""
    cell = np.floor(box / size).astype(np.int64)
    row, x = _cells(cell[:, 0], cell[:, 1])
    inner, y = _cells(cell[row, 2], cell[row, 3])
    return row[inner], x[inner], y


def _meeting(a: np.ndarray, b: np.ndarray, weight: np.ndarray, size: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of boxes that meet, each once, the first ones rising, in parts of about ``PAIRS`` in the weights of the second."""
    row, x, y = _spread(b, size)
    key = x * (1 << 31) + y
    order = np.argsort(key, kind="stable")
    row, key = row[order], key[order]
    upto = np.concatenate(([0], np.cumsum(weight[row])))
    mine, mx, my = _spread(a, size)
    wanted = mx * (1 << 31) + my
    first, last = np.searchsorted(key, wanted, side="left"), np.searchsorted(key, wanted, side="right")
    # A part ends with a box of the first side, so that what is known of it is known together.
    load = np.zeros(len(a) + 1)
    np.add.at(load, mine + 1, upto[last] - upto[first])
    part = (np.cumsum(load)[:-1] // PAIRS)[mine] if len(mine) else mine
    for k in np.unique(part[last > first]):
        at = np.flatnonzero((part == k) & (last > first))
        one, other = _cells(first[at], last[at] - 1)
        one, other = at[one], row[other]
        i = mine[one]
        p, q = a[i], b[other]
        keep = (p[:, 1] >= q[:, 0]) & (p[:, 0] <= q[:, 1]) & (p[:, 3] >= q[:, 2]) & (p[:, 2] <= q[:, 3])
        keep &= (np.floor(np.maximum(p[:, 0], q[:, 0]) / size) == mx[one]) & (np.floor(np.maximum(p[:, 2], q[:, 2]) / size) == my[one])
        yield i[keep], other[keep]


def _stations(left: pa.Table) -> tuple[np.ndarray, ...]:
    cx, cy, ux, uy, half = (left.column(c).to_numpy() for c in ("cx", "cy", "ux", "uy", "half"))
    dx, dy = np.abs(half * ux), np.abs(half * uy)
    return cx, cy, ux, uy, half, np.column_stack((cx - dx, cx + dx, cy - dy, cy + dy))


def _numbers(column: pa.ChunkedArray, name: str) -> np.ndarray:
    return pc.struct_field(column, name).to_numpy()


def _ranks(column: pa.ChunkedArray) -> np.ndarray:
    """The order of values, of structs by their fields."""
    table = pa.table({"v": column})
    while any(pa.types.is_struct(f.type) for f in table.schema):
        table = table.flatten()
    order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in table.column_names], null_placement="at_start")
    rank = np.empty(len(table), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(table))
    return rank


def nearest_lines(stations: DataFrame, lines: DataFrame, by: str, g: str, band: float, cell: float = 100.0, tile: float = TILE, group: int = GROUP) -> DataFrame:
    """All stations with right_ft, right_<by>, left_ft, left_<by>: the nearest line crossed or touched on each side.

    Places within ``band`` of the centre don't count, nor do those beyond ``half``; of lines as near the one with the smaller
    ``by`` is taken; edges along the transect give none.
    """
    edges = _boxed_edges(lines, by, g)
    mine, theirs = _dealt(stations, edges, ["_x0", "_x1", "_y0", "_y1"], tile, group)
    kind = edges.schema[by].dataType
    more = [T.StructField(f"{side}_{what}", k) for side in ("right", "left") for what, k in (("ft", T.DoubleType()), (by, kind))]
    shape = T.StructType([*stations.schema.fields, *more])

    def cross(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.drop_columns("_group")
        n = left.num_rows
        cx, cy, ux, uy, half, box = _stations(left)
        x1, y1, x2, y2 = (right.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2"))
        theirs = np.column_stack([right.column(c).to_numpy() for c in ("_x0", "_x1", "_y0", "_y1")])
        best = {side: (np.full(n, np.nan), np.full(n, -1, dtype=np.int64)) for side in ("right", "left")}
        rank = _ranks(right.column(by)) if right.num_rows else None
        for i, j in _meeting(box, theirs, np.ones(len(x1)), cell) if n and len(x1) else ():
            a = ux[i] * (y1[j] - cy[i]) - uy[i] * (x1[j] - cx[i])
            b = ux[i] * (y2[j] - cy[i]) - uy[i] * (x2[j] - cx[i])
            hit = (a * b <= 0) & (a != b)
            i, j, t = i[hit], j[hit], a[hit] / (a[hit] - b[hit])
            s = (x1[j] - cx[i] + t * (x2[j] - x1[j])) * ux[i] + (y1[j] - cy[i] + t * (y2[j] - y1[j])) * uy[i]
            for side, sign in (("right", 1), ("left", -1)):
                k = np.flatnonzero((sign * s > band) & (np.abs(s) <= half[i]))
                k = k[np.lexsort((rank[j[k]], np.abs(s[k]), i[k]))]
                k = k[np.concatenate(([True], np.diff(i[k]) != 0))] if len(k) else k
                best[side][0][i[k]], best[side][1][i[k]] = s[k], j[k]
        out = left
        for side, (s, j) in best.items():
            none = j < 0
            out = out.append_column(f"{side}_ft", pa.array(s, mask=none))
            out = out.append_column(f"{side}_{by}", right.column(by).take(pa.array(np.maximum(j, 0), mask=none)) if right.num_rows else pa.nulls(n, right.schema.field(by).type))
        return out

    return mine.groupBy("_group").cogroup(theirs.groupBy("_group")).applyInArrow(cross, shape)


# ---- whole lines ------------------------------------------------------------------------------------------------
# Where only something of each line is wanted, its stations are made where they are measured: lines go to the task and not
# stations, and a row for each line, or for few of its stations, comes out.

CHUNK = 32  #: stations that look for lines together
SAME = 1e-9  #: by how much directions of a straight chunk may differ


@dataclass
class Met:
    """Stations of whole lines, in order: the line's row, place, and of the nearest line on each side the signed distance (or NaN)
    and its row in ``by`` (or -1)."""

    k: np.ndarray
    d: np.ndarray
    cx: np.ndarray
    cy: np.ndarray
    right: np.ndarray
    right_row: np.ndarray
    left: np.ndarray
    left_row: np.ndarray
    by: pa.ChunkedArray


def _homes(lines: DataFrame, others: DataFrame, box: list[str], tile: float, group: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the number of the group that each row goes to: a line with its box ``_b0`` to ``_b3`` and ``_n`` stations to the
    cell of its lower corner, at the level whose cells are as long as it; others to all cells where a line they meet has its home."""
    lines = lines.withColumn("_finest", F.lit(tile)).withColumn("_level", _level([("_b0", "_b1"), ("_b2", "_b3")], tile))
    size = F.lit(tile) * F.pow(F.lit(float(FACTOR)), F.col("_level"))
    home = ["_level", "_hx", "_hy"]
    lines = lines.withColumns({"_hx": F.floor(F.col("_b0") / size), "_hy": F.floor(F.col("_b2") / size)}).drop("_finest")
    wide = [F.max(F.col(b) - F.col(a)) for a, b in (("_b0", "_b1"), ("_b2", "_b3"))]
    counts, _ = tables.written(lines.groupBy(*home).agg(F.sum("_n").alias("n"), wide[0].alias("dx"), wide[1].alias("dy")), "homes")
    levels = counts.groupBy("_level").agg(F.sum("n").alias("n"), F.max("dx").alias("dx"), F.max("dy").alias("dy")).collect()  # few: they grow by powers
    groups = max(1, -(-sum(r["n"] for r in levels) // group))
    crowded = tables.beside(counts.where(F.col("n") > group).select(*home, F.ceil(F.col("n") / group).cast("int").alias("_parts")))
    number = lambda part: F.pmod(F.xxhash64(*home, part.cast("int")), F.lit(groups)).cast("int")
    parts = F.coalesce("_parts", F.lit(1))
    mine = lines.join(crowded, home, "left").withColumn("_group", number(F.pmod(F.xxhash64("_b0", "_b1", "_b2", "_b3"), parts))).drop(*home, "_parts")
    kinds = "array<struct<_level:int,size:double,dx:double,dy:double>>"
    known = F.from_json(F.lit("[" + ",".join(f'{{"_level":{r["_level"]},"size":{tile * FACTOR ** r["_level"]!r},"dx":{r["dx"]!r},"dy":{r["dy"]!r}}}' for r in levels) + "]"), kinds)
    theirs = others.withColumn("_l", F.explode(known)).withColumn("_level", F.col("_l._level"))
    for c, low, high, span in (("_hx", box[0], box[1], "_l.dx"), ("_hy", box[2], box[3], "_l.dy")):
        theirs = theirs.withColumn(c, F.explode(F.sequence(F.floor((F.col(low) - F.col(span)) / F.col("_l.size")), F.floor(F.col(high) / F.col("_l.size")))))
    theirs = theirs.join(crowded, home, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return mine, theirs.withColumn("_group", number(F.col("_part"))).select(*others.columns, "_group")


class _Chunks:
    """Stations (line, number, d, cx, cy, ux, uy) of lines in chunks. Those of a straight chunk look the same way and lie in order along it,
    so an edge is crossed by a stretch of them; of other chunks by any."""

    def __init__(self, place: tuple[np.ndarray, ...], half: np.ndarray):
        k, no, _, cx, cy, ux, uy = place
        self.begin = np.flatnonzero(np.concatenate(([True], (np.diff(k) != 0) | (np.diff(no // CHUNK) != 0))))
        self.end = np.append(self.begin[1:], len(k))
        dx, dy = np.abs(half * ux), np.abs(half * uy)
        ends = ((np.minimum, cx - dx), (np.maximum, cx + dx), (np.minimum, cy - dy), (np.maximum, cy + dy))
        self.box = np.column_stack([f.reduceat(v, self.begin) for f, v in ends])
        self.x, self.y, self.ux, self.uy = (v[self.begin] for v in (cx, cy, ux, uy))
        x, y, px, py = (np.repeat(v, self.end - self.begin) for v in (self.x, self.y, self.ux, self.uy))
        at = py * (cx - x) - px * (cy - y)  # along the chunk
        step = np.diff(at, prepend=0.0)
        step[self.begin] = 0.0
        bent = (np.abs(ux - px) + np.abs(uy - py) > SAME) | ~(step >= 0)
        self.straight = ~np.logical_or.reduceat(bent, self.begin)
        size = np.where(self.straight, at[self.end - 1], 0.0)
        self.base = np.cumsum(size + 1) - (size + 1)  # chunks one behind the other, so that one search does for all
        self.at = np.where(np.repeat(self.straight, self.end - self.begin), at, 0.0) + np.repeat(self.base, self.end - self.begin)
        self.far = (self.box[:, 1] - self.box[:, 0]) + (self.box[:, 3] - self.box[:, 2]) + np.abs(self.box).max() + self.at[-1]

    def facing(self, c: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last station of each chunk that can cross the edge with it; wide enough for what rounding may hide."""
        a1, b1, a2, b2 = x1 - self.x[c], y1 - self.y[c], x2 - self.x[c], y2 - self.y[c]
        p, q = self.uy[c] * a1 - self.ux[c] * b1, self.uy[c] * a2 - self.ux[c] * b2
        slack = 2 * SAME * (np.abs(a1) + np.abs(b1) + np.abs(a2) + np.abs(b2) + self.far[c])
        low = np.searchsorted(self.at, self.base[c] + np.minimum(p, q) - slack, side="left")
        high = np.searchsorted(self.at, self.base[c] + np.maximum(p, q) + slack, side="right")
        begin, end, straight = self.begin[c], self.end[c], self.straight[c]
        return np.where(straight, np.clip(low, begin, end), begin), np.where(straight, np.clip(high, begin, end), end) - 1


def _nearest(place: tuple[np.ndarray, ...], half: np.ndarray, edges: tuple[np.ndarray, ...], box: np.ndarray, band: float, cell: float) -> list[np.ndarray]:
    """(right, its row, left, its row) of stations (line, number, d, cx, cy, ux, uy); of edges as near the first is taken."""
    k, _, _, cx, cy, ux, uy = place
    n, none = len(k), len(box)
    least, rows = [np.full(n, np.inf) for _ in range(2)], [np.full(n, none, dtype=np.int64) for _ in range(2)]
    if n and none:
        x1, y1, x2, y2 = edges
        chunks = _Chunks(place, half)
        # All edges that a chunk may meet come together, so what is least is known.
        for chunk, other in _meeting(chunks.box, box, np.full(none, float(CHUNK)), cell):
            pair, i = _cells(*chunks.facing(chunk, *(v[other] for v in edges)))
            j = other[pair]
            a = ux[i] * (y1[j] - cy[i]) - uy[i] * (x1[j] - cx[i])
            b = ux[i] * (y2[j] - cy[i]) - uy[i] * (x2[j] - cx[i])
            hit = np.flatnonzero((a * b <= 0) & (a != b))
            i, t, j = i[hit], a[hit] / (a[hit] - b[hit]), j[hit]
            s = (x1[j] - cx[i] + t * (x2[j] - x1[j])) * ux[i] + (y1[j] - cy[i] + t * (y2[j] - y1[j])) * uy[i]
            far = np.abs(s)
            fits = (far <= half[i]) & (far > band)
            for side, on in enumerate((s > 0, s < 0)):
                m = np.flatnonzero(fits & on)
                station, away = i[m], far[m]
                np.minimum.at(least[side], station, away)
                as_near = away == least[side][station]
                np.minimum.at(rows[side], station[as_near], j[m][as_near])
    found = [np.isfinite(v) for v in least]
    return [v for side, sign in ((0, 1), (1, -1)) for v in (np.where(found[side], sign * least[side], np.nan), np.where(found[side], rows[side], -1))]


def along_lines(
    lines: DataFrame, g: str, n: Column, chord: float, keep: list[str], others: DataFrame, by: str, og: str, band: float, use: Callable[[pa.Table, Met], pa.Table], shape: T.StructType,
    cell: float = 300.0, tile: float = TILE, group: int = GROUP, beside: tuple[DataFrame, str] | None = None,
) -> DataFrame:
    """What ``use`` makes of lines, some at a time and each whole, with the ``n`` stations on each, as ``stations_along`` and
    ``nearest_lines`` have them. ``keep``, with ``len`` and ``half``, are the columns that it gets of the lines; a table ``beside`` them,
    with its key, is joined only when it is known where each goes.

    A line is held in one task; its stations take some hundred bytes each there.
    """
    box = dict(zip(("_b0", "_b1", "_b2", "_b3"), (G.bounds(F.col(g))[c] for c in ("xmin", "xmax", "ymin", "ymax"))))
    rows = lines.select(*keep, F.col(g).alias("_g"), n.cast("long").alias("_n"), *(v.alias(k) for k, v in box.items()))
    rows = rows.where("_n > 0 and len is not null and half is not null and _b0 is not null and _b2 is not null")
    rows = rows.withColumns({c: F.col(c) + F.col("half") * sign for c, sign in (("_b0", -1), ("_b1", 1), ("_b2", -1), ("_b3", 1))})
    mine, theirs = _homes(rows, _boxed_edges(others, by, og), ["_x0", "_x1", "_y0", "_y1"], tile, group)
    mine = mine.drop(*box)
    mine = mine.join(beside[0], beside[1]) if beside else mine
    keep = keep + [c for c in beside[0].columns if c not in keep] if beside else keep
    names = [f.name for f in shape]

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        if right.num_rows:
            right = right.take(pa.array(np.argsort(_ranks(right.column(by)), kind="stable")))
        ends = tuple(right.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2"))
        boxes = np.column_stack([right.column(c).to_numpy() for c in ("_x0", "_x1", "_y0", "_y1")])
        counts = left.column("_n").to_numpy()
        part = np.cumsum(counts) // STATIONS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            some = left.slice(a, b - a).combine_chunks()
            if not some.num_rows:
                continue
            size = some.column("len").to_numpy()
            place = _placed(_Lines(some.column("_g").chunk(0)), counts[a:b], np.zeros(b - a), size, chord)
            k, _, d, cx, cy, _, _ = place
            near = _nearest(place, some.column("half").to_numpy()[k], ends, boxes, band, cell)
            out.append(use(some.select(keep), Met(k, d, cx, cy, *near, right.column(by))).select(names))
        return pa.concat_tables(out) if out else use(left.select(keep), Met(*(np.zeros(0, dtype=t) for t in "lddddldl"), right.column(by))).select(names)

    return mine.groupBy("_group").cogroup(theirs.groupBy("_group")).applyInArrow(measure, shape)


def _paired(pair: np.ndarray, s: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, low, high) of the stretches between the first and second, third and fourth place of each pair, cut to its reach."""
    order = np.lexsort((s, pair))
    pair, s = pair[order], s[order]
    new = np.concatenate(([True], np.diff(pair) != 0)) if len(pair) else np.zeros(0, dtype=bool)
    place = np.arange(len(pair)) - np.maximum.accumulate(np.where(new, np.arange(len(pair)), 0)) if len(pair) else pair
    first = np.flatnonzero((place % 2 == 0) & np.append(~new[1:], False)) if len(pair) else pair
    low, high = np.maximum(s[first], -half[pair[first]]), np.minimum(s[first + 1], half[pair[first]])
    keep = high > low
    return pair[first][keep], low[keep], high[keep]


def _inside(a: np.ndarray, b: np.ndarray, s: np.ndarray, pair: np.ndarray, half: np.ndarray, closed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, low, high): the stretches of transects inside polygons, or along their edges.

    ``a`` and ``b`` tell how far the ends of each edge lie from the transect's line, ``s`` where it crosses it. An end on the line
    counts as beside it, first on one side and, for pairs with an edge on the line, then on the other; what lies inside by
    either count is inside the closed polygon.
    """
    hit = (a >= 0) != (b >= 0)
    found = _paired(pair[hit], s[hit], half)
    if not closed:
        return found
    on = np.zeros(len(half), dtype=bool)
    on[pair[(a == 0) & (b == 0)]] = True
    if not on.any():
        return found
    hit = ((a > 0) != (b > 0)) & on[pair]
    more = _paired(pair[hit], s[hit], half)
    pair, low, high = (np.concatenate(x) for x in zip(found, more))
    order = np.lexsort((high, low, pair))
    merged: list[list] = []
    for p, l, h in zip(pair[order].tolist(), low[order].tolist(), high[order].tolist()):  # noqa: E741
        if merged and merged[-1][0] == p and l <= merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], h)
        else:
            merged.append([p, l, h])
    if not merged:
        return found
    pair, low, high = zip(*merged)
    return np.array(pair), np.array(low), np.array(high)


def _stretches(left: pa.Table, right: pa.Table, cell: float, closed: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(station, low, high) of every stretch inside a polygon, stations rising."""
    cx, cy, ux, uy, half, box = _stations(left)
    if not len(cx) or not right.num_rows:
        return
    right = right.take(np.unique(right.column("_row").to_numpy(), return_index=True)[1])  # once, by however many tiles it came
    column = right.column("e").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    begin, flat = _flat(column)
    x1, y1, x2, y2 = (_numbers(flat, c) for c in ("x1", "y1", "x2", "y2"))
    theirs = np.column_stack([right.column(c).to_numpy() for c in ("xmin", "xmax", "ymin", "ymax")])
    for i, j in _meeting(box, theirs, np.diff(begin), cell):
        pair, e = _cells(begin[j], begin[j + 1] - 1)
        k = i[pair]
        a = ux[k] * (y1[e] - cy[k]) - uy[k] * (x1[e] - cx[k])
        b = ux[k] * (y2[e] - cy[k]) - uy[k] * (x2[e] - cx[k])
        with np.errstate(divide="ignore", invalid="ignore"):
            t = a / (a - b)
            s = (x1[e] - cx[k] + t * (x2[e] - x1[e])) * ux[k] + (y1[e] - cy[k] + t * (y2[e] - y1[e])) * uy[k]
        p, low, high = _inside(a, b, s, pair, half[i], closed)
        yield i[p], low, high


def _boxed(polygons: DataFrame, g: str) -> DataFrame:
    boxed = polygons.withColumns(G.bounds(F.col(g))).select(F.monotonically_increasing_id().alias("_row"), G.sides(F.col(g)).alias("e"), "xmin", "xmax", "ymin", "ymax")
    return boxed.where("xmin is not null and ymin is not null and size(e) > 0")


def polygon_edges(stations: DataFrame, polygons: DataFrame, g: str, cell: float = 300.0, tile: float = TILE, group: int = GROUP, closed: bool = True) -> DataFrame:
    """All stations with left_edge, right_edge, straddling: the nearest end of a stretch inside a polygon on each side, and how many
    stretches the centre is inside of. Without ``closed`` a transect along an edge is inside the polygon to its right only."""
    mine, theirs = _dealt(stations, _boxed(polygons, g), ["xmin", "xmax", "ymin", "ymax"], tile, group)
    shape = T.StructType([*stations.schema.fields, T.StructField("left_edge", T.DoubleType()), T.StructField("right_edge", T.DoubleType()), T.StructField("straddling", T.LongType())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.drop_columns("_group")
        n = left.num_rows
        below, above, over = np.full(n, -np.inf), np.full(n, np.inf), np.zeros(n, dtype=np.int64)
        for i, low, high in _stretches(left, right, cell, closed):
            k = high <= 0
            np.maximum.at(below, i[k], high[k])
            k = low >= 0
            np.minimum.at(above, i[k], low[k])
            over += np.bincount(i[(low < 0) & (high > 0)], minlength=n)
        edges = (("left_edge", pa.array(below, mask=np.isinf(below))), ("right_edge", pa.array(above, mask=np.isinf(above))), ("straddling", pa.array(over)))
        for name, column in edges:
            left = left.append_column(name, column)
        return left

    return mine.groupBy("_group").cogroup(theirs.groupBy("_group")).applyInArrow(meet, shape)


def polygon_stretches(stations: DataFrame, polygons: DataFrame, g: str, keys: list[str], cell: float = 300.0, tile: float = TILE, group: int = GROUP) -> DataFrame:
    """(keys, s_lo, s_hi): every stretch of a transect inside a polygon; a station that meets none comes with nulls."""
    mine, theirs = _dealt(stations, _boxed(polygons, g), ["xmin", "xmax", "ymin", "ymax"], tile, group)
    shape = T.StructType([*(stations.schema[k] for k in keys), T.StructField("s_lo", T.DoubleType()), T.StructField("s_hi", T.DoubleType())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(_stretches(left, right, cell))
        i, low, high = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0))
        none = np.setdiff1d(np.arange(left.num_rows), i)
        out = left.select(keys).take(np.concatenate((i, none)))
        mask = np.arange(len(i) + len(none)) >= len(i)
        for name, v in (("s_lo", low), ("s_hi", high)):
            out = out.append_column(name, pa.array(np.concatenate((v, np.zeros(len(none)))), mask=mask))
        return out

    return mine.groupBy("_group").cogroup(theirs.groupBy("_group")).applyInArrow(meet, shape)
