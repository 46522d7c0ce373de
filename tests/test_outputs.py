"""GeoPackages, pages and stages: what files hold, and what a broken run leaves for the next."""

import json
import os
from pathlib import Path
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.functions import geometry as G
from lineweave.operators import stages
from lineweave.sources import geojson, geopackage, paged, split, tiles

SHAPES = [
    ("Point", [[(1, 2)]]), ("LineString", [[(0, 0), (3, 4)]]), ("MultiLineString", [[(0, 0), (1, 1)], [(5, 5), (6, 7), (8, 8)]]), ("Polygon", [[(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]]),
    ("MultiPolygon", [[(0, 0), (4, 0), (4, 4), (0, 0)]]), ("MultiPoint", [[(1, 1), (9, 9)]]), ("Point", None), ("LineString", []),
]


def layer(spark):
    rows = [(k, kind, None if g is None else [[{"x": float(x), "y": float(y)} for x, y in r] for r in g], k % 2 == 0 if k % 3 else None, 'na"me' if k else None, k / 4) for k, (kind, g) in enumerate(SHAPES)]
    return spark.createDataFrame(rows, f"id long, kind string, g {G.PARTS}, ok boolean, name string, size double")


def test_geopackages_hold_all_kinds_and_come_back(spark, tmp_path):
    path = str(tmp_path / "out")
    df = layer(spark).repartition(3, "id")
    names = geopackage.write_geopackage(df, path, 'my "layer"', F.col("kind"), "g", ["id", "ok", "name", "size"], 2913)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == names
    table, tree = '"my ""layer"""', '"rtree_my ""layer""_geom"'
    for name in names:
        c = sqlite3.connect(f"{path}/{name}")
        assert c.execute("pragma application_id").fetchone()[0] == 0x47504B47 and c.execute("pragma integrity_check").fetchone() == ("ok",)
        (known,) = c.execute(f'select count(*) from {table} where geom is not null').fetchone()
        assert c.execute(f'select count(*) from {tree}').fetchone()[0] == known
        assert c.execute("select srs_id, data_type from gpkg_contents").fetchone() == (2913, "features")
        head = c.execute(f'select substr(geom, 1, 2), substr(geom, 4, 1) from {table} where geom is not null').fetchone()
        assert head is None or head == (b"GP", b"\x03")
    kinds = T.StructType.fromDDL("id long, ok boolean, name string, size double")
    got = {r["id"]: r for r in geopackage.read_geopackage(spark, path, 'my "layer"', kinds).collect()}
    for r in layer(spark).collect():
        mine, g = got[r["id"]], r["g"] or None
        assert (mine["ok"], mine["name"], mine["size"]) == (r["ok"], r["name"], r["size"])
        assert (mine["kind"], mine["g"]) == ((r["kind"], g) if g else (None, None))
    inside = geopackage.read_geopackage(spark, path, 'my "layer"', kinds, (5.0, 7.0, 5.0, 7.0)).collect()
    assert {r["id"] for r in inside} == {2, 5}


def test_pages_are_tried_again_and_resumed(spark, tmp_path):
    folder = str(tmp_path / "pages")

    def page(k, n):
        return json.dumps({"features": [{"type": "Feature", "properties": {"id": 100 * k + i}, "geometry": None} for i in range(n)]}).encode()

    def flaky(k, n):
        if k == 1:
            raise OSError("down")
        if k == 2:
            return b'{"error": "features"}'
        if k == 3 and n < 2:
            return b"{cut off"
        return page(k, k)

    first = {r["page"]: (r["state"], r["tries"], r["error"] is None) for r in paged.fetch_pages(spark, 5, flaky, folder, wait=0.0).collect()}
    assert first == {0: ("fetched", 1, True), 1: ("failed", 3, False), 2: ("failed", 3, False), 3: ("fetched", 3, True), 4: ("fetched", 1, True)}
    (tmp_path / "pages" / "_half").write_bytes(b"left by a lost task")

    def sound(k, n):
        assert k in (1, 2, 5)
        return page(k, k)

    then = {r["page"]: r["state"] for r in paged.fetch_pages(spark, 6, sound, folder, wait=0.0, at_once=1).collect()}
    assert then == {0: "kept", 1: "fetched", 2: "fetched", 3: "kept", 4: "kept", 5: "fetched"}
    assert {r["state"] for r in paged.fetch_pages(spark, 6, sound, folder).collect()} == {"kept"}
    rows = split.read_split(spark, folder, T.StructType.fromDDL("id long")).collect()
    assert sorted(r["id"] for r in rows) == sorted(100 * k + i for k in range(6) for i in range(k))


def test_a_broken_run_goes_on_behind_what_it_finished(spark, tmp_path):
    folder, calls = str(tmp_path), []

    def make(name, breaks=False):
        def run(df):
            calls.append(name)
            if breaks:
                raise RuntimeError("lost")
            return df.select("id", F.lit(name).alias("of"))

        return run

    def go(df, breaks=False, version="1"):
        s = stages.Stages(spark, folder)
        a = s.table("a", make("a"), s.source(df))
        b = s.table("b", make("b", breaks), a, version=version)
        return s, b

    df = spark.range(10)
    with pytest.raises(RuntimeError):
        go(df, True)
    s, b = go(df.repartition(3))  # rows in another order are the same rows
    assert calls == ["a", "b", "b"] and (s.made, s.kept) == (["b"], ["a"]) and b.df.count() == 10
    assert go(df)[0].made == [] and go(df, version="2")[0].made == ["b"]
    assert go(spark.range(11))[0].made == ["a", "b"]
    assert go(df)[0].made == []  # the tables before are still there
    assert stages.content(df) != stages.content(df.union(df)) and stages.content(df) != stages.content(df.withColumnRenamed("id", "x"))


def test_collections_in_parts_are_one_when_put_together(spark, tmp_path):
    df = spark.createDataFrame([(k % 40, [[{"x": float(k), "y": 0.0}]]) for k in range(100)], f"id long, g {G.PARTS}").repartition(5)
    path = str(tmp_path / "c")
    geojson.write_collection(df, path, F.lit("Point"), "g", ["id"], ["id"], files=4)
    parts = sorted(p for p in (tmp_path / "c").iterdir() if p.name.startswith("part"))
    whole = json.loads("".join(p.read_text() for p in parts))
    assert len(parts) > 1 and [f["properties"]["id"] for f in whole["features"]] == sorted(k % 40 for k in range(100))
    geojson.write_collection(df.limit(0), path, F.lit("Point"), "g", ["id"], ["id"])
    assert json.loads("".join(p.read_text() for p in (tmp_path / "c").glob("part*")))["features"] == []


def test_tiles_are_numbered_along_a_curve(spark):
    cells = [(z, x, y) for z in range(5) for x in range(1 << z) for y in range(1 << z)]
    df = spark.createDataFrame(cells, "z int, x long, y long")
    got = {r["n"]: (r["z"], r["x"], r["y"]) for r in df.select("*", tiles.number(F.col("z"), F.col("x"), F.col("y")).alias("n")).collect()}
    assert sorted(got) == list(range(len(cells))) and all(tiles.place(n) == cell for n, cell in got.items())
    order = [got[n][1:] for n in sorted(got) if got[n][0] == 4]
    assert all(abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for a, b in zip(order, order[1:]))


def test_archives_share_equal_tiles_and_clip_lines(spark, tmp_path):
    world = tiles.World(-8.0, -8.0, 16.0)
    lines = [(1, [(-7.5, -7.5), (7.5, -7.5), (7.5, 7.5)]), (2, [(-100.0, 1.0), (100.0, 1.0)]), (3, [(3.0, 3.0), (3.0, 3.0)]), (4, [(90.0, 90.0), (99.0, 99.0)])]
    df = spark.createDataFrame([(k, [[{"x": x, "y": y} for x, y in p]]) for k, p in lines], f"id int, g {G.PARTS}")
    parts = tiles.clipped(df, "id", "g", world, [2])
    path = str(tmp_path / "tiles")
    assert len(tiles.write_tiles(parts, path, "id")) >= 1
    got = sorted(tuple(r) for r in tiles.read_tiles(spark, path, world, 2, (-8.0, 8.0, -8.0, 8.0), "id").collect())
    assert [r for r in got if r[3] == "2"] == [(2, k, 2, "2", 4.0 * k - 8, 1.0, 4.0 * k - 4, 1.0) for k in range(4)]
    assert len([r for r in got if r[3] == "1"]) == 4 + 4 and {r[3] for r in got} == {"1", "2"}
    some = tiles.read_tiles(spark, path, world, 2, (0.0, 1.0, 0.0, 1.0), "id").collect()
    assert [(r["tx"], r["ty"], r["id"]) for r in some] == [(2, 2, "2")]
    # Equal payloads side by side on the curve are one entry.
    rows = [(3, x, y, 5, 0.0, 0.0, 1.0, 1.0) for x in range(8) for y in range(8)]
    same = spark.createDataFrame(rows, "z int, tx long, ty long, id int, x1 double, y1 double, x2 double, y2 double").coalesce(1)
    names = tiles.write_tiles(same, str(tmp_path / "same"), "id")
    entries = []
    for name in names:
        file = tmp_path / "same" / name
        with split.store(str(file))[0].open_input_file(str(file)) as f:
            entries += tiles.directory(f, file.stat().st_size)
    assert len(entries) == len(names) and sum(run for _, run, _, _ in entries) == 64
    back = tiles.read_tiles(spark, str(tmp_path / "same"), world, 3, (-8.0, 7.9, -8.0, 7.9), "id").collect()
    assert {(r["tx"], r["ty"]) for r in back} == {(x, y) for x in range(8) for y in range(8)}


def test_one_file_is_put_together_from_sorted_parts(spark, tmp_path):
    """No task sorts or holds the whole collection, and small ranges share tasks."""
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 37) % 5000).alias("id"), F.lit(None).cast(G.PARTS).alias("g"))
    path = str(tmp_path / "one")
    seen = []
    together = geojson.put_together
    geojson.put_together = lambda s, parts, *more: (seen.append(len(list(Path(parts.removeprefix("file:")).glob("part*")))), together(s, parts, *more))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        geojson.write_collection(df, path, F.lit("Point"), "g", ["id"], ["id"])
    finally:
        geojson.put_together = together
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (name,) = (p.name for p in (tmp_path / "one").iterdir() if not p.name.startswith("."))
    assert seen[0] > 1 and [f["properties"]["id"] for f in json.loads((tmp_path / "one" / name).read_text())["features"]] == list(range(5000))
    rows = split.read_split(spark, path, T.StructType.fromDDL("id long"), 500)
    assert rows.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism and sorted(r["id"] for r in rows.collect()) == list(range(5000))


def test_a_large_partition_fills_several_geopackages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(geopackage, "FEATURES", 30)
    df = spark.range(100).select("id", F.array(F.array(G.point(F.col("id"), F.lit(0)), G.point(F.col("id"), F.lit(1)))).alias("g")).coalesce(1)
    path = str(tmp_path / "many")
    names = geopackage.write_geopackage(df, path, "l", F.lit("LineString"), "g", ["id"])
    assert len(names) == 4
    kinds = T.StructType.fromDDL("id long")
    assert sorted(r["id"] for r in geopackage.read_geopackage(spark, path, "l", kinds).collect()) == list(range(100))
    assert sorted(r["id"] for r in geopackage.read_geopackage(spark, path, "l", kinds, (10.0, 40.0, 0.0, 1.0)).collect()) == list(range(10, 41))


@pytest.mark.parametrize("size", (1, 7, 1 << 16))
def test_features_of_a_page_are_counted_in_blocks(size):
    blocks = lambda text: (text.encode()[k : k + size] for k in range(0, len(text.encode()), size))
    odd = {"more": [1.5, {"features": [3]}], "features": [{"a": "]},{é\\\""}, 12, -3.5e7, [], {}, None, "x"], "n": 12}
    for text in (json.dumps(odd), json.dumps(odd, indent=3, ensure_ascii=False), '{"features":[]}', ' {"features" : [ 1 , 23 ] } \n', '{"features":1,"features":[true]}'):
        assert paged.features_of(blocks(text)) == paged.features_of(text.encode()) == len(json.loads(text)["features"])
    for text in ("", "[]", "{}", '{"features":3}', '{"features":[1', '{"features":[1,]}', '{"features":[1]} x', '{"features":[1],}', '{"features":[1],"features":2}', '{"error":"down"}', "{1:2}"):
        with pytest.raises(ValueError):
            paged.features_of(blocks(text))


def test_a_page_larger_than_its_blocks_is_never_held(spark, tmp_path):
    """100 MB of features, of which a task may hold some; a page that breaks off leaves no file."""

    def fetch(page, attempt):
        import tracemalloc

        tracemalloc.start()
        yield b'{"features":['
        for k in range(100 if page == 0 else 1):
            yield (b"," if k else b"") + b",".join([b'{"type":"Feature","properties":{"seg":1}}'] * 25_000)
        if tracemalloc.get_traced_memory()[1] > 30 << 20:
            raise MemoryError("the page was held")
        tracemalloc.stop()
        yield b"]}" if page == 0 else b"]"

    folder = str(tmp_path / "pages")
    got = {r["page"]: (r["state"], r["error"]) for r in paged.fetch_pages(spark, 2, fetch, folder, tries=1).collect()}
    assert got[0] == ("fetched", None) and got[1][0] == "failed" and os.listdir(folder) == [paged.page_name(0)]
    assert os.path.getsize(f"{folder}/{paged.page_name(0)}") > 100 << 20
