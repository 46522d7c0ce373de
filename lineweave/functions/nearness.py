"""Whether lines come near polygons, by array arithmetic on Arrow batches: ``geometry.within`` for many pairs of geometries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRS = 500_000  #: of edges at once, about

Edges = tuple[np.ndarray, ...]


def _edges(column: pa.Array) -> tuple[np.ndarray, Edges]:
    """Where each row's edges begin, with the end, and x1, y1, x2, y2 of all."""
    flat = column.flatten()
    begin = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)))).astype(np.int64)
    return begin, tuple(pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2"))


def _distance2(e: Edges, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``geometry._edge_distance2``."""
    x1, y1, x2, y2 = e
    dx, dy, px, py, qx, qy = x2 - x1, y2 - y1, x - x1, y - y1, x - x2, y - y2
    along, size, off = px * dx + py * dy, dx * dx + dy * dy, dx * py - dy * px
    slant = np.divide(off * off, size, out=np.zeros(len(along)), where=size > 0)
    beside = np.where(dy == 0, py * py, np.where(dx == 0, px * px, slant))
    return np.where(along <= 0, px * px + py * py, np.where(along >= size, qx * qx + qy * qy, beside))


def _cross(e: Edges, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (e[2] - e[0]) * (y - e[1]) - (e[3] - e[1]) * (x - e[0])


def _matched(row: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``row`` with each of the edges of their row, some at a time."""
    n = np.diff(begin)[row]
    part = np.cumsum(n) // PAIRS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(row)]
    for a, b in zip(cuts, cuts[1:]):
        k = np.repeat(np.arange(a, b), n[a:b])
        yield k, begin[row[k]] + np.arange(len(k)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])


def near(lines: pa.Array, polygons: pa.Array, d: float) -> np.ndarray:
    """Whether the line of each row comes within ``d`` of its polygon."""
    (lb, le), (pb, pe) = _edges(lines), _edges(polygons)
    found, turns = np.zeros(len(lines), dtype=bool), np.zeros(len(lines), dtype=np.int64)
    some = np.flatnonzero(np.diff(lb) > 0)
    for k, f in _matched(some, pb):  # the line's first point in the polygon or on it
        row = some[k]
        e, x, y = tuple(v[f] for v in pe), le[0][lb[row]], le[1][lb[row]]
        found[row[_distance2(e, x, y) == 0]] = True
        between = (e[1] > y) != (e[3] > y)
        share = np.divide(y - e[1], e[3] - e[1], out=np.zeros(len(y)), where=between)
        turns += np.bincount(row[between & (x < e[0] + (e[2] - e[0]) * share)], minlength=len(lines))
    found |= turns % 2 == 1
    of = np.repeat(np.arange(len(lines)), np.diff(lb))
    for k, f in _matched(of, pb):
        e, f = tuple(v[k] for v in le), tuple(v[f] for v in pe)
        least = np.minimum(np.minimum(_distance2(f, e[0], e[1]), _distance2(f, e[2], e[3])), _distance2(e, f[0], f[1]))
        meet = (_cross(e, f[0], f[1]) * _cross(e, f[2], f[3]) < 0) & (_cross(f, e[0], e[1]) * _cross(f, e[2], e[3]) < 0)
        found[of[k[(least <= d * d) | meet]]] = True
    return found


def within(line_edges: Column, polygon_edges: Column, d: float) -> Column:
    """``geometry.within``; unknown geometries give null."""

    @F.arrow_udf("boolean")
    def run(lines: pa.Array, polygons: pa.Array) -> pa.Array:
        none = pc.or_(lines.is_null(), polygons.is_null()).to_numpy(zero_copy_only=False)
        return pa.array(near(lines, polygons, d), mask=none)

    return run(line_edges, polygon_edges)
