"""Map tiles of lines: clipped by zoom, numbered along a Hilbert curve, kept in archives that are read by ranges.

A world is a square that zoom z cuts into 4 to the power of z tiles. Lines are cut at the tiles' edges by column arithmetic,
edge by edge, and tiles are range-partitioned by number, so each archive holds a stretch of the curve. An archive is the
payloads of its tiles, a directory and a footer; neighbouring tiles with equal payloads are one entry with a run length. To
read the tiles of a box a task reads an archive's footer and directory and then the stretches of bytes that it needs.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.functions import geometry as G
from lineweave.sources.split import files, store

MAGIC = b"LWTILES1"
ENTRY, FOOTER = struct.Struct("<QIQI"), struct.Struct("<QII8s")  #: first number, run, offset, length; place of the directory, entries, zooms, magic


@dataclass(frozen=True)
class World:
    x: float
    y: float
    side: float


def number(z: Column, x: Column, y: Column) -> Column:
    """The tile's place along the Hilbert curve of its zoom, behind all tiles of the zooms before."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(s: Column, k: Column) -> Column:
        side = F.pow(F.lit(2.0), k).cast("long")
        right, up = F.when(s["x"].bitwiseAND(side) > 0, 1).otherwise(0), F.when(s["y"].bitwiseAND(side) > 0, 1).otherwise(0)
        d = s["d"] + side * side * (3 * right).bitwiseXOR(up)
        mirrored = (up == 0) & (right == 1)
        u, v = F.when(mirrored, side - 1 - s["x"]).otherwise(s["x"]), F.when(mirrored, side - 1 - s["y"]).otherwise(s["y"])
        u, v = u.bitwiseAND(side - 1), v.bitwiseAND(side - 1)
        return F.struct(F.when(up == 0, v).otherwise(u).alias("x"), F.when(up == 0, u).otherwise(v).alias("y"), d.alias("d"))

    bits = F.when(z > 0, F.sequence(z - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    before = ((F.pow(F.lit(4.0), z) - 1) / 3).cast("long")
    return before + F.aggregate(bits, start, step, lambda s: s["d"])


def place(n: int) -> tuple[int, int, int]:
    """Zoom, x and y of a tile's number."""
    z = 0
    while n >= 4**z:
        n -= 4**z
        z += 1
    x = y = 0
    for k in range(z):
        side = 1 << k
        right, up = n >> 1 & 1, (n ^ n >> 1) & 1
        if up == 0:
            if right:
                x, y = side - 1 - x, side - 1 - y
            x, y = y, x
        x, y, n = x + side * right, y + side * up, n >> 2
    return z, x, y


def clipped(lines: DataFrame, key: str, g: str, world: World, zooms: list[int]) -> DataFrame:
    """(z, tx, ty, key, x1, y1, x2, y2): the part of each edge in each tile that it passes through; a point alone is none."""
    e = lines.select(key, F.explode(G.sides(F.col(g))).alias("e")).select(key, "e.*")
    e = e.withColumn("z", F.explode(F.array(*(F.lit(z) for z in zooms))))
    side = F.lit(world.side) / F.pow(F.lit(2.0), F.col("z"))
    last = F.pow(F.lit(2.0), F.col("z")).cast("long") - 1
    for axis, origin in (("x", world.x), ("y", world.y)):
        low, high = F.least(f"{axis}1", f"{axis}2"), F.greatest(f"{axis}1", f"{axis}2")
        at = lambda v: F.floor((v - F.lit(origin)) / side)  # noqa: B023, E731
        first, end = F.greatest(at(low), F.lit(0)), F.least(at(high), last)
        e = e.withColumn(f"t{axis}", F.explode(F.when(end >= first, F.sequence(first, end))))
    x0, y0 = F.lit(world.x) + F.col("tx") * side, F.lit(world.y) + F.col("ty") * side
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def span(d: Column, v: Column, low: Column) -> tuple[Column, Column]:
        a, b = (low - v) / F.nullif(d, F.lit(0.0)), (low + side - v) / F.nullif(d, F.lit(0.0))
        return F.coalesce(F.least(a, b), F.lit(0.0)), F.coalesce(F.greatest(a, b), F.lit(1.0))

    (a, b), (c, d) = span(dx, F.col("x1"), x0), span(dy, F.col("y1"), y0)
    e = e.withColumns({"_a": F.greatest(a, c, F.lit(0.0)), "_b": F.least(b, d, F.lit(1.0))}).where((F.col("_a") < F.col("_b")) & ((dx != 0) | (dy != 0)))
    ends = {f"{k}{n}": F.col(f"{k}1") + F.col(t) * delta for n, t in ((1, "_a"), (2, "_b")) for k, delta in (("x", dx), ("y", dy))}
    return e.select("z", "tx", "ty", key, *(v.alias(k) for k, v in ends.items()))


def write_tiles(parts: DataFrame, path: str, key: str, places: int = 3) -> list[str]:
    """Writes what ``clipped`` gives as archives and gives their names; in a tile lines stand by key and place."""
    fixed = lambda c: F.round(F.col(c) * 10.0**places) / 10.0**places
    rows = parts.groupBy("z", "tx", "ty").agg(F.array_sort(F.collect_list(F.struct(key, *(fixed(c).alias(c) for c in ("x1", "y1", "x2", "y2"))))).alias("lines"))
    rows = rows.select(number(F.col("z"), F.col("tx"), F.col("ty")).alias("n"), F.to_json("lines").alias("payload"))
    system, folder = store(path)
    system.create_dir(folder, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, hidden = f"part-{TaskContext.get().partitionId():05d}.tiles", f"_{uuid.uuid4().hex}"
        system, folder = store(path)
        entries, at, before, out = [], 0, None, None
        for batch in batches:
            for n, payload in zip(batch.column("n").to_pylist(), batch.column("payload").to_pylist()):
                out = out or system.open_output_stream(f"{folder}/{hidden}")
                if entries and payload == before and n == entries[-1][0] + entries[-1][1]:
                    entries[-1][1] += 1
                    continue
                data = payload.encode()
                entries.append([n, 1, at, len(data)])
                out.write(data)
                at, before = at + len(data), payload
        if out:
            out.write(b"".join(entry_bytes(*e) for e in entries) + footer_bytes(at, len(entries)))
            out.close()
            system.move(f"{folder}/{hidden}", f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"name": [name]})

    return sorted(r["name"] for r in rows.repartitionByRange("n").sortWithinPartitions("n").mapInArrow(write, "name string").collect())


def entry_bytes(*entry: int) -> bytes:
    return ENTRY.pack(*entry)


def footer_bytes(at: int, entries: int) -> bytes:
    return FOOTER.pack(at, entries, 0, MAGIC)


def directory(file, size: int) -> list[tuple[int, int, int, int]]:
    """The entries of an archive: two ranged reads."""
    file.seek(size - FOOTER.size)
    at, n, _, magic = FOOTER.unpack(file.read(FOOTER.size))
    if magic != MAGIC:
        raise ValueError("no archive of tiles")
    file.seek(at)
    return list(ENTRY.iter_unpack(file.read(n * ENTRY.size)))


def read_tiles(spark: SparkSession, path: str, world: World, zoom: int, box: tuple[float, float, float, float], key: str) -> DataFrame:
    """(z, tx, ty, key, x1, y1, x2, y2): the lines of the tiles of one zoom that a box (least x, most x, least y, most y) touches."""
    side = world.side / 2**zoom
    x0, x1, y0, y1 = (int((v - o) // side) for v, o in zip(box, (world.x, world.x, world.y, world.y)))
    archives = spark.createDataFrame(files(path), "file string, size long")
    archives = archives.repartition(max(1, archives.count()), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size in zip(batch.column("file").to_pylist(), batch.column("size").to_pylist()):
                system, one = store(name)
                with system.open_input_file(one) as file:
                    for n, run, at, length in directory(file, size):
                        found = [p for p in map(place, range(n, n + run)) if p[0] == zoom and x0 <= p[1] <= x1 and y0 <= p[2] <= y1]
                        if found:
                            file.seek(at)
                            payload = file.read(length).decode()
                            yield pa.RecordBatch.from_pydict({"z": [p[0] for p in found], "tx": [p[1] for p in found], "ty": [p[2] for p in found], "payload": [payload] * len(found)})

    rows = archives.mapInArrow(read, "z long, tx long, ty long, payload string")
    line = F.explode(F.from_json("payload", f"array<struct<{key}:string,x1:double,y1:double,x2:double,y2:double>>")).alias("l")
    return rows.select("z", "tx", "ty", line).select("z", "tx", "ty", "l.*")
