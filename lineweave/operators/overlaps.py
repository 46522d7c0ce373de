"""How many boxes each box meets, and the least and most value of them, without pairs.

Boxes go to tiles that hold about as many rows each; a task counts in its tile by sorted arrays. Along an axis two boxes meet
in one of two ways: the low end of one is in the other, or the low end of the other is above it and in the first. The first
way is a stab of an interval, the second a range of places, and both are sums, least and most values over stretches of an
order. With two axes the first one is cut into nodes of powers of two, and every pair is met in one node only. So work grows
with rows times a power of their logarithm, however many pairs there are.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.operators.joins import met

ROWS = 200_000  #: rows of both sides in a tile, about
CROWD = 1_000_000  #: rows of one side in a tile, from which on it is dealt out in parts
LEAST, MOST = np.iinfo(np.int64).max, np.iinfo(np.int64).min  # of no value

Axes = list[tuple[str, str]]


class _Sums(NamedTuple):
    n: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @classmethod
    def none(cls, size: int) -> _Sums:
        return cls(np.zeros(size, dtype=np.int64), np.full(size, LEAST), np.full(size, MOST))

    def add(self, at: np.ndarray, more: _Sums) -> None:
        np.add.at(self.n, at, more.n)
        np.minimum.at(self.least, at, more.least)
        np.maximum.at(self.most, at, more.most)

    def __getitem__(self, at) -> _Sums:
        return _Sums(self.n[at], self.least[at], self.most[at])


def _levels(s: np.ndarray, e: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(k, rows whose stretch from s to e holds 2**k places, but not twice as many), by rising k; empty stretches have none."""
    k = np.frexp((e - s).astype(np.float64))[1] - 1
    return [(x, np.flatnonzero((k == x) & (e > s))) for x in range(int(k.max(initial=-1)) + 1)]


def _gathered(op: np.ufunc, values: np.ndarray, s: np.ndarray, e: np.ndarray, none: int) -> np.ndarray:
    """``op`` over the values from s to e, of each stretch."""
    out = np.full(len(s), none)
    for k, at in _levels(s, e):
        if k:
            values = op(values[: -(1 << k - 1)], values[1 << k - 1 :])
        out[at] = op(values[s[at]], values[e[at] - (1 << k)])
    return out


def _painted(op: np.ufunc, size: int, s: np.ndarray, e: np.ndarray, values: np.ndarray, none: int) -> np.ndarray:
    """``op`` over the values of all stretches that hold a place, of each place."""
    out = np.full(size, none)
    for k, at in reversed(_levels(s, e)):
        op.at(out, s[at], values[at])
        op.at(out, e[at] - (1 << k), values[at])
        if k:
            half = 1 << k - 1
            below = out.copy()
            below[half:] = op(out[half:], out[:-half])
            out = below
    return out


class _Boxes(NamedTuple):
    """Ranks of the ends along one axis, and whether the low end lies in the tile."""

    low: np.ndarray
    high: np.ndarray
    home: np.ndarray

    def __getitem__(self, at) -> _Boxes:
        return _Boxes(self.low[at], self.high[at], self.home[at])


def _along(g: np.ndarray, q: _Boxes, h: np.ndarray, d: _Boxes, values: _Sums, ranks: int) -> tuple[np.ndarray, _Sums]:
    """(rows of ``q``, what each meets of those ``d`` that have its group)."""
    a, b, c, e = g * ranks + q.low, g * ranks + q.high, h * ranks + d.low, h * ranks + d.high
    i, j = np.argsort(a), np.argsort(c)  # places are found faster in order
    a, b, c, e, values, asked, there = a[i], b[i], c[j], e[j], values[j], q.home[i], d.home[j]
    # Places of d in the stretch of q, above its low end.
    places, some = (c, values) if there.all() else (c[there], values[there])
    low, high = np.searchsorted(places, a, "right"), np.searchsorted(places, b, "right")
    total = np.concatenate(([0], np.cumsum(some.n)))
    out = _Sums(np.where(high > low, total[high] - total[low], 0), _gathered(np.minimum, some.least, low, high, LEAST), _gathered(np.maximum, some.most, low, high, MOST))
    # Low ends of q in the stretches of d.
    places = a if asked.all() else a[asked]
    low, high = np.searchsorted(places, c), np.searchsorted(places, e, "right")
    some = high > low
    low, high, values = low[some], high[some], values[some]
    steps = np.zeros(len(places) + 1, dtype=np.int64)
    np.add.at(steps, low, values.n)
    np.subtract.at(steps, high, values.n)
    stabbed = _Sums(np.cumsum(steps)[:-1], _painted(np.minimum, len(places), low, high, values.least, LEAST), _painted(np.maximum, len(places), low, high, values.most, MOST))
    out.add(np.flatnonzero(asked), stabbed)
    return i, out


def _nodes(s: np.ndarray, e: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(level, rows, their node): stretches from s to e as whole nodes of 2**level places, two of a level at most."""
    at = np.flatnonzero(e > s)
    s, e, level = s[at], e[at], 0
    while len(at):
        low, high = (s & 1) == 1, (e & 1) == 1
        yield level, np.concatenate((at[low], at[high])), np.concatenate((s[low], e[high] - 1))
        s, e = s + low >> 1, e - high >> 1
        more = e > s
        s, e, at, level = s[more], e[more], at[more], level + 1


def _in_plane(q: list[_Boxes], d: list[_Boxes], values: _Sums, ranks: list[int]) -> _Sums:
    """What each box of ``q`` meets of ``d``, with one axis or two."""
    out = _Sums.none(len(q[0].low))
    if len(q) == 1:
        out.add(*_along(np.zeros(len(out.n), dtype=np.int64), q[0], np.zeros(len(values.n), dtype=np.int64), d[0], values, ranks[0]))
        return out

    def meet(i: np.ndarray, g: np.ndarray, j: np.ndarray, h: np.ndarray, nodes: int) -> None:
        for mine in (True, False):  # only those whose node the other side has too
            has = np.zeros(nodes, dtype=bool)
            has[h if mine else g] = True
            if mine:
                i, g = i[has[g]], g[has[g]]
            else:
                j, h = j[has[h]], h[has[h]]
        if len(i) and len(j):
            at, more = _along(g, q[1][i], h, d[1][j], values[j], ranks[1])
            out.add(i[at], more)

    # Low ends of q in the stretches of d.
    i = np.flatnonzero(q[0].home)
    places, at = np.unique(q[0].low[i], return_inverse=True)
    for level, j, h in _nodes(np.searchsorted(places, d[0].low), np.searchsorted(places, d[0].high, "right")):
        meet(i, at >> level, j, h, len(places) + 1)
    # Low ends of d in the stretches of q, above its own.
    j = np.flatnonzero(d[0].home)
    places, at = np.unique(d[0].low[j], return_inverse=True)
    for level, i, g in _nodes(*(np.searchsorted(places, x, "right") for x in (q[0].low, q[0].high))):
        meet(i, g, j, at >> level, len(places) + 1)
    return out


def _spread(low: list[np.ndarray], high: list[np.ndarray], cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, tile, whether the row begins before the tile and ends behind it along every axis) of each tile that a row touches."""
    first, last = ([np.searchsorted(c, x, "right") for c, x in zip(cuts, ends)] for ends in (low, high))
    row = np.arange(len(low[0]))
    tile, across = np.zeros(len(row), dtype=np.int64), np.ones(len(row), dtype=bool)
    for a, b, c in zip(first, last, cuts):
        n = (b - a + 1)[row]
        k = np.repeat(np.arange(len(row)), n)
        at = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + a[row[k]]
        row, tile, across = row[k], tile[k] * (len(c) + 1) + at, across[k] & (at > a[row[k]]) & (at < b[row[k]])
    return row, tile, across


def _floats(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]


def overlapped(
    left: DataFrame, right: DataFrame, key: str, left_axes: Axes, right_axes: Axes, value: str, pairs: Callable[..., DataFrame], rows: int = ROWS, crowd: int = CROWD
) -> DataFrame:
    """(key, n, least, most): how many rows of ``right`` the rows of a key of ``left`` meet (ends count), and the least and most ``value`` of them,
    a whole number; keys that meet nothing are left out. Boxes have one axis or two; those with nulls meet nothing.

    No pair is made. A tile that holds more than ``crowd`` rows of a side is dealt out in parts, and each part of one side meets
    all of the other. Boxes of ``right`` that reach over a whole tile are added up before they are shuffled, so a large one goes to
    the tiles along its border; one of ``left`` goes to all that it touches, so it should be the smaller. Boxes whose high end is
    below their low one meet by ``pairs`` (the two sides and their axes).
    """
    kind = right.schema[value].dataType
    plain = [(f"_a{k}", f"_b{k}") for k in range(len(left_axes))]
    ends = [c for axis in plain for c in axis]

    def ready(df: DataFrame, axes: Axes, more: dict) -> DataFrame:
        given = {p: F.col(c).cast("double") for axis, names in zip(axes, plain) for c, p in zip(axis, names)}
        rows = df.select(*(c.alias(name) for name, c in (more | given).items()))
        return rows.where(functools.reduce(operator.and_, (F.col(c).isNotNull() for c in ends)))

    mine, theirs = ready(left, left_axes, {"_key": F.col(key)}), ready(right, right_axes, {"_v": F.col(value).cast("long")})
    turned = functools.reduce(operator.or_, (F.col(b) < F.col(a) for a, b in plain))
    (n, odd), (m, odder) = (df.agg(F.count(F.lit(1)), F.count(F.when(turned, 1))).first() for df in (mine, theirs))

    # Tiles: cuts by shares of the low ends.
    tiles = max(math.ceil((n + m) / rows), min(left.sparkSession.sparkContext.defaultParallelism, math.ceil((n + m) / 20_000)), 1)
    each = math.ceil(tiles ** (1 / len(plain)))
    cuts = [np.zeros(0)] * len(plain)
    if each > 1:
        shares = [(k + 1) / each for k in range(each - 1)]
        lows = mine.select(*(a for a, _ in plain)).unionByName(theirs.select(*(a for a, _ in plain)))
        found = lows.agg(*(F.percentile_approx(a, shares, max(10_000, 20 * each)) for a, _ in plain)).first()
        cuts = [np.unique(np.array(c, dtype=np.float64)) for c in found]
    count = math.prod(len(c) + 1 for c in cuts)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(count, dtype=np.int64)
        for batch in batches:
            low, high = (_floats(batch, [axis[k] for axis in plain]) for k in (0, 1))
            _, tile, across = _spread(low, high, cuts)
            seen += np.bincount(tile[~across], minlength=count)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["tile", "n"])

    def parts(df: DataFrame) -> np.ndarray:
        out = np.ones(count, dtype=np.int64)
        for tile, k in df.select(*ends).where(~turned).mapInArrow(tally, "tile long, n long").groupBy("tile").agg(F.sum("n")).where(F.col("sum(n)") > crowd).collect():
            out[tile] = -(-k // crowd)
        return out

    dealt = (parts(mine), parts(theirs)) if n + m > crowd else (np.ones(count, dtype=np.int64),) * 2
    begin = np.concatenate(([0], np.cumsum(dealt[0] * dealt[1])))
    of = np.repeat(np.arange(count), dealt[0] * dealt[1])  # the tile of each group

    def grouped(side: int, row: np.ndarray, tile: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, group): a part of its tile by hash, and all parts of the other side with it."""
        other = dealt[1 - side][tile]
        k = np.repeat(np.arange(len(row)), other)
        every = np.arange(len(k)) - np.repeat(np.cumsum(other) - other, other)
        row, tile = row[k], tile[k]
        part = h[row] % dealt[side][tile]
        first, second = (part, every) if side == 0 else (every, part)
        return row, begin[tile] + first * dealt[1][tile] + second

    def deal_mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (_floats(batch, [axis[k] for axis in plain]) for k in (0, 1))
            row, tile, _ = _spread(low, high, cuts)
            row, group = grouped(0, row, tile, _floats(batch, ["_h"])[0])
            yield pa.RecordBatch.from_arrays([pa.array(group), *(batch.column(batch.schema.get_field_index(c)).take(pa.array(row)) for c in ("_key", *ends))], ["_group", "_key", *ends])

    def deal_theirs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_group", *ends, "n", "least", "most"]
        for batch in batches:
            low, high = (_floats(batch, [axis[k] for axis in plain]) for k in (0, 1))
            v = batch.column(batch.schema.get_field_index("_v"))
            least, most = (v.fill_null(x).to_numpy() for x in (LEAST, MOST))
            row, tile, across = _spread(low, high, cuts)
            over, back = np.unique(tile[across], return_inverse=True)
            sums = _Sums.none(len(over))
            sums.add(back, _Sums(np.ones(len(back), dtype=np.int64), least[row[across]], most[row[across]]))
            k, group = grouped(1, np.arange(len(over)), over, over)
            endless = [np.full(len(k), x) for _ in plain for x in (-np.inf, np.inf)]
            whole = [group, *endless, sums.n[k], sums.least[k], sums.most[k]]
            row, group = grouped(1, row[~across], tile[~across], _floats(batch, ["_h"])[0])
            some = [group, *(x[row] for pair in zip(low, high) for x in pair), np.ones(len(row), dtype=np.int64), least[row], most[row]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(some, whole)], names)

    def count_tile(a: pa.Table, b: pa.Table) -> pa.Table:
        empty = pa.table({"_key": a.column("_key").slice(0, 0), **{c: pa.array([], pa.int64()) for c in ("n", "least", "most")}})
        if not a.num_rows or not b.num_rows:
            return empty
        at = np.unravel_index(of[a.column("_group")[0].as_py()], [len(c) + 1 for c in cuts])
        q, d, ranks = [], [], []
        for (low, high), c, k in zip(plain, cuts, at):
            given = [t.column(x).to_numpy() for t in (a, b) for x in (low, high)]
            places, rank = np.unique(np.concatenate(given), return_inverse=True)
            w, x, y, z = np.split(rank.astype(np.int64), np.cumsum([len(g) for g in given])[:-1])
            q.append(_Boxes(w, x, np.searchsorted(c, given[0], "right") == k))
            d.append(_Boxes(y, z, np.searchsorted(c, given[2], "right") == k))
            ranks.append(len(places))
        found = _in_plane(q, d, _Sums(*(b.column(c).to_numpy() for c in ("n", "least", "most"))), ranks)
        some = np.flatnonzero(found.n)
        out = pa.table({"_key": a.column("_key").take(pa.array(some)), "n": pa.array(found.n[some])})
        for name, x, none in (("least", found.least[some], LEAST), ("most", found.most[some], MOST)):
            out = out.append_column(name, pa.array(x, mask=x == none))
        return out

    held = T.StructType([T.StructField("_group", T.LongType()), mine.schema["_key"], *(T.StructField(c, T.DoubleType()) for c in ends)])
    added = T.StructType([T.StructField(c, T.DoubleType() if c in ends else T.LongType()) for c in ("_group", *ends, "n", "least", "most")])
    hashed = lambda df: df.where(~turned).withColumn("_h", F.xxhash64(*df.columns))
    a, b = hashed(mine).mapInArrow(deal_mine, held), hashed(theirs).mapInArrow(deal_theirs, added)
    found = a.groupBy("_group").cogroup(b.groupBy("_group")).applyInArrow(count_tile, T.StructType([mine.schema["_key"], *(T.StructField(c, T.LongType()) for c in ("n", "least", "most"))]))
    far = [(f"_c{k}", f"_d{k}") for k in range(len(plain))]
    other = theirs.withColumnsRenamed({p: q for x, y in zip(plain, far) for p, q in zip(x, y)})
    turned_there = functools.reduce(operator.or_, (F.col(d) < F.col(c) for c, d in far))
    for some, x, y in ((odd, mine.where(turned), other), (odder, mine.where(~turned), other.where(turned_there))):
        if some:
            found = found.unionByName(met(x, y, plain, far, "_v", pairs).select("_key", "n", "least", "most"))
    sums = found.groupBy(F.col("_key").alias(key)).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    return sums.withColumns({c: F.col(c).cast(kind) for c in ("least", "most")})
