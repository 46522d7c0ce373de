"""Repair, split scans, prepared polygons, boxes of mixed sizes, quantiles and numbers against plain Python."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.functions import geometry as G
from lineweave.operators import numbering
from lineweave.operators.joins import mixed_box_join, nearest_1d
from lineweave.operators.polygons import points_in
from lineweave.operators.quantiles import quantiles
from lineweave.operators.repair import repair
from lineweave.sources import split


def odd(rings, x, y):
    """Whether a point is inside by turns."""
    n = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            n += (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return n % 2 == 1


def rows_of(spark, polygons):
    shaped = [(k, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings] if rings is not None else None) for k, rings in polygons]
    return spark.createDataFrame(shaped, f"id int, g {G.PARTS}")


def test_repaired_rings_are_simple_and_enclose_the_same(spark):
    rng = random.Random(4)
    polygons = []
    for k in range(60):
        rings = []
        for _ in range(rng.randint(1, 3)):
            ring = [(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(rng.randint(3, 9))]
            rings.append([*ring, ring[0]])
        polygons.append((k, rings))
    polygons += [(100, None), (101, []), (102, [[(0, 0), (5, 0), (0, 0)]]), (103, [[(0, 0), (4, 0), (4, 4), (0, 4)]]), (104, [[(1, 1), (1, 1), (1, 1)]])]
    found = {r["id"]: r for r in repair(rows_of(spark, polygons), "id", size=4.0).collect()}
    assert len(found) == len(polygons)
    for k, rings in polygons[:60]:
        mine = [[(p["x"], p["y"]) for p in r] for r in found[k]["g"]]
        assert sum(found[k]["was_repaired"] for k in range(60)) > 40
        for _ in range(200):
            x, y = rng.uniform(-1, 13), rng.uniform(-1, 13)
            assert odd(mine, x, y) == odd(rings, x, y), (k, x, y)
        if found[k]["was_repaired"]:
            for ring in mine:
                assert ring[0] == ring[-1] and len(set(ring)) == len(ring) - 1 >= 3
    assert found[100]["g"] is None and found[102]["g"] == [] and found[102]["was_repaired"]
    assert not found[103]["was_repaired"] and not found[101]["was_repaired"] and not found[104]["was_repaired"]


TRICKY = ['{"type":"Feature"}', '\\', '\\\\"', '"{[', ']}"\n', 'é漢"', '{' * 9, '\\"' * 5, ""]


def collection(n, indent, other):
    features = []
    for k in range(n):
        g = {"type": "Point", "coordinates": [k, -k]}
        p = {"id": k, "note": TRICKY[k % len(TRICKY)]}
        features.append([{"type": "Feature", "properties": p, "geometry": g}, {"geometry": g, "note": {"a": [{}]}, "properties": p, "type": "Feature"}][k % 2])
    whole = {"type": "FeatureCollection", "note": TRICKY[4], **({"crs": {"properties": {"name": "{["}}, "others": [{"type": "Other", "x": {"y": []}}]} if other else {}), "features": features}
    return json.dumps(whole, indent=indent, ensure_ascii=n % 2 == 0), features


@pytest.mark.parametrize("indent, other", [(None, False), (None, True), (2, True)])
def test_every_cut_finds_each_object_once(tmp_path, indent, other):
    text, features = collection(13, indent, other)
    path = tmp_path / "c.json"
    path.write_text(text, encoding="utf-8")
    size = path.stat().st_size
    for step in [*range(1, 90), 250, 1000, size, size + 5]:
        inside, depth, found = False, 0, []
        with split.store(str(path))[0].open_input_file(str(path)) as file:
            for a in range(0, size, step):
                data, raw = split._slice(file, a, min(a + step, size))
                if len(data):
                    found += [json.loads(t) for t in split._objects(file, data, raw, file.tell(), inside, depth)]
                crossed, outside, within = split.summary(data)
                depth += within if inside else outside
                inside = inside != crossed
        assert [f for f in found if f.get("type") == "Feature"] == features, step


def test_split_scan_reads_folders_and_pages_without_features(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"p{k}.geojson").write_text(collection(10 + k, None, True)[0])
    (tmp_path / "p3.geojson").write_text('{"error":{"code":500,"note":"{"}}')
    (tmp_path / "p4.geojson").write_text("")
    kind = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.StringType())])
    rows = split.read_split(spark, str(tmp_path), kind, 200).collect()
    assert sorted((r["id"], r["note"]) for r in rows) == sorted((k, TRICKY[k % len(TRICKY)]) for n in (10, 11, 12) for k in range(n))
    assert all(r["kind"] == "Point" and r["g"][0][0]["x"] == r["id"] for r in rows)
    with pytest.raises(FileNotFoundError):
        split.read_split(spark, str(tmp_path / "none"), kind)


def test_quantiles_of_a_hot_group_without_holding_it(spark):
    rng = random.Random(2)
    hot = [rng.choice([rng.gauss(0, 1), rng.gauss(1e6, 5), 7.0]) for _ in range(6000)] + [-1e308, 1e308]
    rows = [("hot", v) for v in hot] + [("flat", 3.0)] * 900 + [(None, float(v)) for v in range(50)] + [("few", 1.0), ("few", 4.0), ("few", float("nan")), ("few", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    names = {"p05": 0.05, "p50": 0.5, "p999": 0.999, "most": 1.0, "least": 0.0}
    for keys in (["k"], []):
        got = {r["k"] if keys else "all": r for r in quantiles(df, keys, "v", names, small=100, cells=16).collect()}
        groups = {}
        for k, v in rows:
            groups.setdefault(k if keys else "all", []).append(v)
        assert set(got) == set(groups)
        for k, values in groups.items():
            values = [v for v in values if v is not None and v == v]
            assert got[k]["n"] == len(values)
            for name, p in names.items():
                want = np.quantile(np.array(values) / 4, p) * 4 if values else None
                assert got[k][name] == (pytest.approx(want, rel=1e-9) if values else None), (k, name)
    assert quantiles(df.limit(0), ["k"], "v", names).count() == 0


@pytest.mark.parametrize("hot", [5, 20_000])
def test_boxes_of_all_sizes_meet_once(spark, hot):
    rng = random.Random(6)

    def boxes(n):
        found = [(0, -1000.0, 2000.0, -1000.0, 2000.0), (1, None, 1.0, 2.0, 3.0), (2, 5.0, 5.0, 5.0, 5.0)]
        for k in range(3, n):
            x, y, w, h = rng.uniform(0, 100), rng.uniform(0, 100), 10 ** rng.uniform(-2, 2), 10 ** rng.uniform(-2, 2)
            if k % 3 == 0:  # a dense cell
                x, y, w, h = 50 + x / 1000, 50 + y / 1000, w / 1000, h / 1000
            found.append((k, x, x + w, y, y + h))
        return found

    a, b = boxes(90), boxes(120)
    left = spark.createDataFrame(a, "i int, a0 double, a1 double, b0 double, b1 double")
    right = spark.createDataFrame(b, "j int, c0 double, c1 double, d0 double, d1 double")
    got = mixed_box_join(left, right, [("a0", "a1"), ("b0", "b1")], [("c0", "c1"), ("d0", "d1")], 0.5, hot).select("i", "j").collect()
    want = [(p[0], q[0]) for p in a for q in b if None not in p + q and p[2] >= q[1] and p[1] <= q[2] and p[4] >= q[3] and p[3] <= q[4]]
    assert sorted(map(tuple, got)) == sorted(want)
    cells = mixed_box_join(left.where("i = 0"), right.where("j > 2"), [("a0", "a1"), ("b0", "b1")], [("c0", "c1"), ("d0", "d1")], 0.5)
    assert cells.count() == 117


def test_points_in_polygons_of_many_corners(spark):
    rng = random.Random(9)
    polygons = []
    for k, (n, wide) in enumerate([(3, 5.0), (40, 9.0), (700, 30.0)]):
        angle = sorted(rng.uniform(0, 6.283) for _ in range(n))
        ring = [(wide * rng.uniform(0.4, 1) * np.cos(t) + 10 * k, wide * rng.uniform(0.4, 1) * np.sin(t)) for t in angle]
        polygons.append((k, [[*ring, ring[0]]]))
    polygons.append((3, [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]))
    points = [(k, rng.uniform(-20, 60), rng.uniform(-30, 30)) for k in range(400)] + [(400, 4.0, 2.0), (401, 0.0, 0.0), (402, None, 1.0), (403, 1.5, 1.5), (404, 1.0, 1.5)]
    df = spark.createDataFrame(points, "p int, x double, y double")
    got = {(r["p"], r["id"]) for r in points_in(df, rows_of(spark, polygons), "id", "x", "y", edges=4).collect()}
    want = {(p, k) for p, x, y in points[:400] for k, rings in polygons if odd(rings, x, y)}
    assert {g for g in got if g[0] < 400} == want
    assert {(400, 3), (401, 3), (404, 3)} <= got and (403, 3) not in got and not any(p == 402 for p, _ in got)
    asked = points_in(df.withColumn("id", F.lit(3)), rows_of(spark, polygons), "id", "x", "y").collect()
    assert {r["p"] for r in asked} == {p for p, k in got if k == 3}


def test_numbers_are_dense_with_ties_and_nulls(spark):
    rows = [(k % 5 if k % 7 else None, k % 3) for k in range(500)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(7)
    got = numbering.numbered(df, [F.asc_nulls_first("g"), F.asc("v")], "no")[0].orderBy("no").collect()
    assert [r["no"] for r in got] == list(range(500))
    assert [(r["g"], r["v"]) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    inside = numbering.numbered_within(df, ["g"], [F.desc("v")], "no")[0].collect()
    for g in {r[0] for r in rows}:
        mine = sorted((r["no"], -r["v"]) for r in inside if r["g"] == g)
        assert [n for n, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)
    assert numbering.numbered(df.limit(0), ["g"], "no")[0].count() == 0


def test_nearest_with_an_outlier_and_a_hot_place(spark):
    rng = random.Random(1)
    left = [(k, rng.choice([rng.uniform(0, 100), 50.0])) for k in range(600)] + [(600, 1e12)]
    right = [(k, rng.uniform(0, 100)) for k in range(200)] + [(200, 1e12 + 3)]
    a, b = spark.createDataFrame(left, "i int, x double"), spark.createDataFrame(right, "j int, y double")
    got = {r["i"]: (r["j"], r["d"]) for r in nearest_1d(a, b, "x", "j", "y", 5.0, per_cell=50).collect()}
    want = {}
    for i, x in left:
        d, j = min((abs(x - y), j) for j, y in right)
        if d <= 5.0:
            want[i] = (j, d)
    assert got == want


def test_places_on_a_skyline_are_beside_it(spark):
    """A skyline 10 over even and 13 over odd places: a dot on it is not inside, one on the ground is."""
    ring = [(float(k), 10.0 + 3 * (k % 2)) for k in range(40)] + [(39.0, 0.0), (0.0, 0.0), (0.0, 10.0)]
    dots = spark.createDataFrame([(k, float(k), 10.0 + 3 * (k % 2)) for k in range(39)] + [(100 + k, k + 0.5, 11.5) for k in range(39)] + [(200 + k, float(k), 0.0) for k in range(39)], "p int, x double, y double")
    got = {r["p"] for r in points_in(dots, rows_of(spark, [(1, [ring])]), "id", "x", "y", edges=4, closed=False).collect()}
    assert got == set(range(200, 239))
    assert len(points_in(dots, rows_of(spark, [(1, [ring])]), "id", "x", "y", edges=4).collect()) == 117


def test_polygons_of_few_points_are_repaired_in_their_rows_as_by_joins(spark):
    draw = random.Random(21)
    at = lambda: {"x": draw.uniform(0, 7), "y": draw.uniform(0, 7)}

    def ring(n):
        points = [at() for _ in range(n)]
        points = [p for p in points for _ in range(draw.choice((1, 1, 1, 2)))]
        return points + points[: draw.choice((0, 1, 1))]

    rows = [(k, [ring(draw.randrange(6)) for _ in range(draw.choice((0, 1, 1, 2, 3)))], "x") for k in range(250)]
    box = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))]
    rows += [(300, None, "n"), (301, [box, box], "twice"), (302, [[*box, None]], "unknown point"), (303, [box[:2] * 40, box], "many"), (304, [None, box], "unknown ring"), (305, [box, box, box], "thrice")]
    df = spark.createDataFrame(rows, "id long, g array<array<struct<x:double,y:double>>>, note string")
    both = [{r["id"]: r for r in repair(df, "id", size=3.0, few=n).collect()} for n in (-1, 64)]
    assert all(len(b) == len(rows) and b[0].asDict().keys() == {"id", "g", "note", "was_repaired"} for b in both)

    def twice(g):
        return None if g is None else sum(p["x"] * q["y"] - q["x"] * p["y"] for r in g if r for p, q in zip(r, r[1:]) if p and q)

    for k, _, _ in rows:
        a, b = both[0][k], both[1][k]
        assert a["was_repaired"] == b["was_repaired"], (k, rows[k])
        assert twice(a["g"]) == pytest.approx(twice(b["g"]), abs=1e-9), (k, rows[k][1], a["g"], b["g"])
        assert a["was_repaired"] or a["g"] == b["g"]
    assert "Join" not in repair(df.where("id < 300"), "id")._jdf.queryExecution().executedPlan().toString()
