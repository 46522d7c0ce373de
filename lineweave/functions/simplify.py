"""Line simplification: the one geometric operator that needs Python, on Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from lineweave.functions.geometry import PARTS


def keep_points(xy: np.ndarray, tolerance: float) -> np.ndarray:
    """Mask of the points that stay: ends, and of each stretch the furthest point while it is further than the tolerance."""
    keep = np.zeros(len(xy), dtype=bool)
    keep[[0, -1]] = True
    todo = [(0, len(xy) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d = xy[b] - xy[a]
        size = d @ d
        p = xy[a + 1 : b] - xy[a]
        t = np.clip(p @ d / size, 0, 1) if size else np.zeros(len(p))
        far = np.hypot(*(p - t[:, None] * d).T)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def kept(begin: np.ndarray, x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """``keep_points`` of many lines at once: the points of line k are those from ``begin[k]`` up to ``begin[k + 1]``.

    All stretches that are still open are looked through together, in as many rounds as stretches lie in one another, and in
    each round only their points; so short lines cost no more than their points do.
    """
    keep = np.zeros(len(x), dtype=bool)
    some = np.diff(begin) > 0
    a, b = begin[:-1][some], begin[1:][some] - 1
    keep[a] = keep[b] = True
    while len(a := a[open_ := b - a > 1]):
        b = b[open_]
        n = b - a - 1
        first = np.cumsum(n) - n
        k = np.repeat(np.arange(len(a)), n)
        at = a[k] + 1 + np.arange(len(k)) - first[k]
        dx, dy = (x[b] - x[a])[k], (y[b] - y[a])[k]
        px, py = x[at] - x[a][k], y[at] - y[a][k]
        size = dx * dx + dy * dy
        t = np.clip(np.divide(px * dx + py * dy, size, out=np.zeros(len(at)), where=size > 0), 0, 1)
        far = np.hypot(px - t * dx, py - t * dy)
        most = np.maximum.reduceat(far, first)
        cut = np.minimum.reduceat(np.where(far == most[k], at, len(x)), first)  # the first of those as far
        further = most > tolerance
        a, b, cut = a[further], b[further], cut[further]
        keep[cut] = True
        a, b = np.concatenate((a, cut)), np.concatenate((cut, b))
    return keep


def simplify(parts: Column, tolerance: float) -> Column:
    """Each part with the points that matter at the tolerance; null stays null, short parts stay as they are."""

    @F.arrow_udf(PARTS)
    def run(lines: pa.Array) -> pa.Array:
        parts = lines.flatten()  # of known lines
        points = parts.flatten()
        begin = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)))).astype(np.int64)
        keep = kept(begin, *(pc.struct_field(points, c).to_numpy(zero_copy_only=False) for c in "xy"), tolerance)
        left = np.concatenate(([0], np.cumsum(keep)))[begin]
        known = lambda begin, of: pa.array(begin.astype(np.int32), pa.int32(), mask=np.append(of.is_null().to_numpy(zero_copy_only=False), False))
        found = pa.ListArray.from_arrays(known(left, parts), points.filter(pa.array(keep)))
        each = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False))))
        return pa.ListArray.from_arrays(known(each, lines), found)

    return run(parts)
