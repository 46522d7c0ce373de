"""GeoPackage sink and scan: one file for each partition, or several of a large one, each a whole GeoPackage with an R-tree.

A task builds its file in a folder of its own, copies it to the output folder under a name that readers pass over, and
renames it, so a lost task leaves no file that counts, and one that runs twice leaves one file. A scan copies a file at a time
to a folder of the task, a megabyte at once, and asks the R-tree where a box is given.
"""

from __future__ import annotations

import itertools
import json
import shutil
import sqlite3
import struct
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.functions import geometry as G
from lineweave.sources.files import store
from lineweave.sources.split import files

# Fixed values of the format: numbers of geometry types, application id and version, tables that every file has.
KINDS = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}
APPLICATION, VERSION = 0x47504B47, 10300
TABLES = """
create table gpkg_spatial_ref_sys (srs_name text not null, srs_id integer primary key, organization text not null, organization_coordsys_id integer not null, definition text not null, description text);
create table gpkg_contents (table_name text primary key, data_type text not null, identifier text unique, description text default '', last_change datetime, min_x double, min_y double, max_x double, max_y double, srs_id integer);
create table gpkg_geometry_columns (table_name text not null, column_name text not null, geometry_type_name text not null, srs_id integer not null, z tinyint not null, m tinyint not null, primary key (table_name, column_name));
create table gpkg_extensions (table_name text, column_name text, extension_name text not null, definition text not null, scope text not null);
"""
SQL_TYPES = {"string": "TEXT", "double": "DOUBLE", "float": "DOUBLE", "boolean": "BOOLEAN"}
FEATURES = 250_000  #: of a file, at most
HEAD = struct.Struct("<2sBBi4d")

Ring = list[dict[str, float]]


def _points(points: Ring) -> bytes:
    return struct.pack("<I", len(points)) + struct.pack(f"<{2 * len(points)}d", *(v for p in points for v in (p["x"], p["y"])))


def blob(kind: str, g: list[Ring], srs: int) -> tuple[bytes, tuple[float, float, float, float]]:
    """The geometry with its envelope in front, and the envelope (least x, most x, least y, most y)."""
    xs, ys = [p["x"] for r in g for p in r], [p["y"] for r in g for p in r]
    box = (min(xs), max(xs), min(ys), max(ys))
    head = lambda k: struct.pack("<BI", 1, KINDS[k])
    if kind == "Point":
        body = head(kind) + struct.pack("<2d", g[0][0]["x"], g[0][0]["y"])
    elif kind == "LineString":
        body = head(kind) + _points(g[0])
    elif kind == "MultiPoint":
        body = head(kind) + struct.pack("<I", len(g[0])) + b"".join(head("Point") + struct.pack("<2d", p["x"], p["y"]) for p in g[0])
    elif kind == "MultiLineString":
        body = head(kind) + struct.pack("<I", len(g)) + b"".join(head("LineString") + _points(r) for r in g)
    else:
        rings = struct.pack("<I", len(g)) + b"".join(_points(r) for r in g)
        body = head("Polygon") + rings if kind == "Polygon" else head(kind) + struct.pack("<I", 1) + head("Polygon") + rings
    return HEAD.pack(b"GP", 0, 3, srs, *box) + body, box


def envelope(data: bytes) -> tuple[float, float, float, float]:
    return HEAD.unpack_from(data)[4:]


def unpack(data: bytes) -> tuple[str, list[Ring]]:
    """Kind and parts of a geometry as ``blob`` writes it; polygons of a multipolygon lie side by side."""
    at = HEAD.size

    def take(form: str) -> tuple:
        nonlocal at
        found = struct.unpack_from("<" + form, data, at)
        at += struct.calcsize("<" + form)
        return found

    def points() -> Ring:
        n = take("I")[0]
        values = take(f"{2 * n}d")
        return [{"x": x, "y": y} for x, y in zip(values[::2], values[1::2])]

    def geometry() -> tuple[str, list[Ring]]:
        _, number = take("BI")
        kind = next(k for k, n in KINDS.items() if n == number)
        if kind == "Point":
            x, y = take("2d")
            return kind, [[{"x": x, "y": y}]]
        if kind == "LineString":
            return kind, [points()]
        parts = [points() if kind == "Polygon" else geometry()[1] for _ in range(take("I")[0])]
        if kind == "Polygon":
            return kind, parts
        flat = [ring for part in parts for ring in part]
        return kind, [[p for ring in flat for p in ring]] if kind == "MultiPoint" else flat

    return geometry()


def write_geopackage(df: DataFrame, path: str, layer: str, kind: Column, g: str, properties: list[str], srs: int = 4326) -> list[str]:
    """Writes a file for each partition that has rows, or for each ``FEATURES`` of them, and gives their names; an unknown geometry is kept as null, out of the R-tree."""
    names = {c: SQL_TYPES.get(df.schema[c].dataType.simpleString(), "INTEGER") for c in properties}
    quoted = lambda name: '"' + name.replace('"', '""') + '"'
    rows = df.select(kind.alias("kind"), F.col(g).alias("g"), F.to_json(F.struct(*(F.col(f"`{c}`") for c in properties)), {"ignoreNullFields": "false"}).alias("properties"))
    system, folder = store(path)
    system.create_dir(folder, recursive=True)
    table = quoted(layer)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in batch.to_pylist():
                known = bool(row["g"]) and any(row["g"])
                data, box = blob(row["kind"], row["g"], srs) if known else (None, None)
                yield data, box, [json.loads(row["properties"])[c] for c in properties]

    most = FEATURES

    def build(place: str, some: Iterator[tuple]) -> int:
        with sqlite3.connect(place) as c:
            c.executescript(f"pragma application_id = {APPLICATION}; pragma user_version = {VERSION};{TABLES}")
            c.execute("insert into gpkg_spatial_ref_sys values (?, ?, 'EPSG', ?, 'undefined', null)", (f"EPSG:{srs}", srs, srs))
            c.execute(f"create table {table} (fid integer primary key autoincrement, geom geometry{''.join(f', {quoted(n)} {k}' for n, k in names.items())})")
            c.execute(f"create virtual table {quoted(f'rtree_{layer}_geom')} using rtree(id, minx, maxx, miny, maxy)")
            n, whole = 0, None
            for n, (data, box, values) in enumerate(some, 1):
                c.execute(f"insert into {table} values (?, ?{', ?' * len(values)})", (n, data, *values))
                if box:
                    c.execute(f"insert into {quoted(f'rtree_{layer}_geom')} values (?, ?, ?, ?, ?)", (n, *box))
                    whole = box if whole is None else (min(whole[0], box[0]), max(whole[1], box[1]), min(whole[2], box[2]), max(whole[3], box[3]))
            x0, x1, y0, y1 = whole or (None,) * 4
            c.execute("insert into gpkg_contents values (?, 'features', ?, '', strftime('%Y-%m-%dT%H:%M:%fZ', 'now'), ?, ?, ?, ?, ?)", (layer, layer, x0, y0, x1, y1, srs))
            c.execute("insert into gpkg_geometry_columns values (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, srs))
            c.execute("insert into gpkg_extensions values (?, 'geom', 'gpkg_rtree_index', 'http://www.geopackage.org/spec/#extension_rtree', 'write-only')", (layer,))
        c.close()
        return n

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rest = TaskContext.get().partitionId(), features(batches)
        for k in itertools.count():
            first = next(rest, None)
            if first is None:
                return
            own = tempfile.mkdtemp()
            try:
                n = build(f"{own}/part.gpkg", itertools.chain([first], itertools.islice(rest, most - 1)))
                name, hidden = f"part-{part:05d}-{k:03d}.gpkg", f"_{uuid.uuid4().hex}"
                system, folder = store(path)
                with open(f"{own}/part.gpkg", "rb") as from_, system.open_output_stream(f"{folder}/{hidden}") as to:
                    shutil.copyfileobj(from_, to, 1 << 20)
                system.move(f"{folder}/{hidden}", f"{folder}/{name}")
                yield pa.RecordBatch.from_pydict({"name": [name], "n": [n]})
            finally:
                shutil.rmtree(own, ignore_errors=True)

    return sorted(r["name"] for r in rows.mapInArrow(write, "name string, n long").collect())


def read_geopackage(spark: SparkSession, path: str, layer: str, properties: T.StructType, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Rows (kind, g, the properties) of all files of a folder; with ``box`` (least x, most x, least y, most y) those whose envelopes meet it."""
    quoted = lambda name: '"' + name.replace('"', '""') + '"'
    where = f" where fid in (select id from {quoted(f'rtree_{layer}_geom')} where maxx >= ? and minx <= ? and maxy >= ? and miny <= ?)" if box else ""

    def meets(data: bytes) -> bool:
        """By the envelope itself, as the R-tree rounds outwards."""
        x0, x1, y0, y1 = envelope(data)
        return x1 >= box[0] and x0 <= box[1] and y1 >= box[2] and y0 <= box[3]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                own = tempfile.mkdtemp()
                try:
                    system, place = store(name)
                    with system.open_input_stream(place) as from_, open(f"{own}/part.gpkg", "wb") as to:
                        shutil.copyfileobj(from_, to, 1 << 20)
                    c = sqlite3.connect(f"file:{own}/part.gpkg?immutable=1", uri=True)
                    c.row_factory = sqlite3.Row
                    cursor = c.execute(f"select * from {quoted(layer)}{where}", box or ())
                    while some := cursor.fetchmany(10_000):
                        some = [r for r in some if not box or meets(r["geom"])]
                        found = [(*(unpack(r["geom"]) if r["geom"] is not None else (None, None)), json.dumps({k: r[k] for k in r.keys() if k not in ("fid", "geom")})) for r in some]
                        if not found:
                            continue
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*found), (pa.string(), ring, pa.string()))], ["kind", "g", "properties"])
                    c.close()
                finally:
                    shutil.rmtree(own, ignore_errors=True)

    ring = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    found = [(name,) for name, _ in files(path) if name.endswith(".gpkg")]
    listed = spark.createDataFrame(found, "file string").repartition(max(len(found), 1))
    rows = listed.mapInArrow(read, f"kind string, g {G.PARTS}, properties string")
    # SQLite has no type of its own for truth.
    plain = T.StructType([T.StructField(f.name, T.IntegerType() if isinstance(f.dataType, T.BooleanType) else f.dataType) for f in properties])
    found = rows.select("kind", "g", F.from_json("properties", plain).alias("p"))
    return found.select("kind", "g", *(F.col("p").getField(f.name).cast(f.dataType).alias(f.name) for f in properties))
