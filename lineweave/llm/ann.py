"""Nearest neighbours by inner product over several Hilbert orderings.

Vectors are scaled into the unit ball and lifted onto its sphere (one more coordinate, 0 for queries), so that the largest
inner product is the nearest point. Each of ``curves`` orderings projects them to ``dims`` other orthogonal directions
with a random shift and sorts by the Hilbert key of their grid cell. Spark range-partitions rows by (curve, key, id) and
numbers them; blocks of ``block`` rows in order are the tiles. A query meets the blocks up to ``window / 2`` of all rows
before and after its own place in every curve; each tile keeps a query's best, which are merged over tiles and curves.
Scores are sums of products in double precision on the original vectors, the same in every tile.

The window is a share of the rows, as the vectors of one neighbourhood are a share of them; what a tile holds is bounded
by ``block`` candidates and the queries of ``SUPER`` blocks, whatever the size. The grid is fitted on a bounded sample
(``SAMPLE`` vectors, the first by a hash of their id), all rows are indexed.

Defined cases: vectors that are null, zero, hold null or non-finite components or are not of the commonest length (the
longer of two as common) take no part, nor do null ids; equal scores go to the smaller id; repeated rows of one id count
once, the first by value; with fewer candidates all are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineweave.llm.common import written
from lineweave.llm.mixing import SMALL

CURVES, DIMS, BITS, WINDOW = 8, 4, 12, 0.14
BLOCK, SUPER, SAMPLE, SEED = 2048, 64, 2000, 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of grid cells (n, dims), each coordinate of ``bits`` bits, on the Hilbert curve.

    Per bit from the top: an axis whose bit is set flips the lower bits of the first axis, else the two exchange them;
    the Gray code of the result, read across the axes bit by bit, is the place.
    """
    x = [c.astype(np.int64) for c in cells.T]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            flip = (x[i] >> bit) & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> bit) & 1 == 1, turn ^ ((1 << bit) - 1), turn)
    key = np.zeros(len(turn), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ turn) >> bit) & 1
    return key


def usable(vector: Column, length: int) -> Column:
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return (F.size(vector) == length) & F.coalesce(F.forall(vector, finite), F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Index:
    """The projections, shifts and grids of all curves."""

    def __init__(self, sample: np.ndarray, norm: float, curves: int, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        self.norm, self.curves, self.dims, self.bits = norm, curves, dims, bits
        d = sample.shape[1] + 1
        dims = self.dims = min(dims, d)
        turns = [np.linalg.qr(rng.standard_normal((d, d)))[0] for _ in range(-(-curves * dims // (d // dims * dims)))]
        axes = np.concatenate([t[:, : d // dims * dims] for t in turns], axis=1)[:, : curves * dims]
        at = self.lift(sample, False) @ axes
        low, high = np.quantile(at, 0.002, axis=0), np.quantile(at, 0.998, axis=0)
        step = np.maximum(high - low, 1e-9) / (1 << bits)
        self.axes, self.origin = axes / step, low / step - rng.random(curves * dims)

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        size = np.linalg.norm(x, axis=1)
        if query:
            return np.concatenate((x / size[:, None], np.zeros((len(x), 1))), axis=1)
        rest = np.sqrt(np.maximum(0, 1 - (size / self.norm) ** 2))
        return np.concatenate((x / self.norm, rest[:, None]), axis=1)

    def keys(self, x: np.ndarray, query: bool) -> np.ndarray:
        """(curves, n)"""
        cells = np.clip(self.lift(x, query) @ self.axes - self.origin, 0, (1 << self.bits) - 1).astype(np.int64)
        return np.stack([hilbert_keys(cells[:, c * self.dims : (c + 1) * self.dims], self.bits) for c in range(self.curves)])


def _best(queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best; equal scores go to the smaller name."""
    out = []
    for a in range(0, len(queries), 256):
        rough = queries[a : a + 256] @ candidates.T
        rough[ids[a : a + 256, None] == names[None, :]] = -np.inf
        least = np.partition(rough, -k, axis=1)[:, -k, None] if len(names) > k else np.full((len(rough), 1), -np.inf)
        slack = 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(least), least, 0)))
        q, c = np.nonzero((rough >= least - slack) & (rough > -np.inf))
        exact = (queries[a + q] * candidates[c]).sum(axis=1)
        order = np.lexsort((names[c], -exact, q))
        q, c, exact = q[order], c[order], exact[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < k
        out.append((ids[a + q[keep]], names[c[keep]], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _tile(k: int):
    def tile(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        query = rows.column("query").to_numpy()
        ids = rows.column("id").to_numpy()
        if query.all() or not query.any():
            found = ([], [], [])
        else:
            x = _matrix(rows.column("v").chunk(0))
            found = _best(x[query], ids[query], x[~query], ids[~query], k)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    return tile


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
    curves: int = CURVES, dims: int = DIMS, window: float = WINDOW, block: int = BLOCK, seed: int = SEED,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the nearest found of each row that ``queries`` (on ``id``) selects."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v")).where("id is not null")
    common = rows.where("size(v) > 0").groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    empty = rows.limit(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    if common is None:
        return empty
    rows = rows.where(usable(F.col("v"), common["length"])).groupBy("id").agg(F.min("v").alias("v"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("m"), F.count_if(queries).alias("asked")).first()
    if not total["n"]:
        return empty
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()])
    index = Index(sample, float(np.sqrt(total["m"])), curves, dims, BITS, seed)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(a, 1024) for a in range(0, whole.num_rows, 1024)):
                x, query = _matrix(batch.column("v")), batch.column("query").to_numpy(zero_copy_only=False)
                keys = np.where(query, index.keys(x, True), index.keys(x, False))
                for c in range(curves):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c, np.int32)), pa.array(keys[c]), *batch.columns], names=["curve", "key", *batch.schema.names])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(curves, np.int64)
        for batch in batches:
            curve, no = batch.column("curve").to_numpy(), np.empty(batch.num_rows, np.int64)
            for c in np.unique(curve):
                mine = curve == c
                no[mine] = seen[c] + np.arange(mine.sum())
                seen[c] += mine.sum()
            columns = [batch.column(x) for x in ("curve", "id", "query", "v")]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(no), part, np.int32)), pa.array(no), *columns], names=["part", "no", "curve", "id", "query", "v"])

    both = rows.withColumn("query", F.lit(False)).unionByName(rows.where(queries).withColumn("query", F.lit(True)))
    # As floats where nothing is lost by it, the index is half as large.
    exact = rows.where(F.exists("v", lambda x: x.cast("float").cast("double") != x)).isEmpty()
    kind = "array<float>" if exact else "array<double>"
    placed = both.select("id", "query", F.col("v")).mapInArrow(keyed, "curve int, key long, id long, query boolean, v array<double>")
    placed = placed.withColumn("v", F.col("v").cast(kind)).repartitionByRange("curve", "key", "id", "query").sortWithinPartitions("curve", "key", "id", "query")
    placed = written(placed.mapInArrow(numbered, f"part int, no long, curve int, id long, query boolean, v {kind}"), "curves")
    # Numbers along each curve: those inside a partition, and the counts of the partitions before it.
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n")).select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    n_parts = curves * (placed.agg(F.max("part")).first()[0] + 1)
    placed = placed.join(F.broadcast(offsets) if n_parts <= SMALL else offsets, ["curve", "part"])
    placed = placed.withColumn("block", F.floor((F.col("offset") + F.col("no")) / block).cast("long"))
    reach = int(np.ceil(window / 2 * total["n"] / block))
    # Windows are shifted inward at both ends of a curve, so that each query meets its full share.
    last = (total["n"] + total["asked"] - 1) // block
    end = max(last - 2 * reach, 0)
    at = F.col("block")
    first = F.least(F.greatest(at - reach, F.lit(0)), F.lit(end))
    low, high = F.when(at <= 2 * reach, 0).otherwise(at - reach), F.when(at >= end, last).otherwise(at + reach)  # blocks of queries whose window a block is in
    group = lambda x: F.floor(x / SUPER).cast("long")
    asks = placed.where("query").withColumn("super", group(F.col("block"))).withColumn("tile", F.explode(F.sequence(first, F.least(first + 2 * reach, F.lit(last)))))
    has = placed.where("not query").withColumn("tile", F.col("block")).withColumn("super", F.explode(F.sequence(group(low), group(high))))
    names = ["curve", "tile", "super", "id", "query", "v"]
    found = asks.select(*names).unionByName(has.select(*names)).groupBy("curve", "tile", "super").applyInArrow(_tile(k), "query_id long, vec_id long, score double")
    found = found.dropDuplicates(["query_id", "vec_id"])
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
