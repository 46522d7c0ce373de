"""Rounding, null and tie rules with known answers."""

import random

from pyspark.sql import functions as F

from lineweave.functions import geometry as G
from lineweave.functions import semantics as S
from lineweave.operators import aggregates as A
from lineweave.operators import joins as J
from lineweave.sources import files, geojson


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_rounding(spark):
    assert [one(spark, S.whole(F.lit(x))) for x in (0.5, 1.5, 2.5, 2.7, -2.5)] == [0, 2, 2, 3, -2]
    assert [one(spark, S.rnd(F.lit(x), n)) for x, n in ((1.005, 2), (0.15, 1), (28.35, 1), (2.5, 0), (-2.5, 0))] == [1.0, 0.2, 28.4, 3.0, -3.0]
    assert one(spark, S.rnd(F.lit(None), 1)) is None


def test_ranges(spark):
    assert one(spark, S.counting(F.lit(0), F.lit(0))) is None
    assert one(spark, S.counting(F.lit(0), F.lit(3))) == [0, 1, 2]


def test_picks_skip_nulls(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5, 2), (1, 4, 2)], "k int, v int, b int")
    assert df.groupBy("k").agg(S.least_by(F.col("v"), F.col("b"), F.col("v")).alias("x"), S.any_known(F.col("v")).isNotNull().alias("y")).first()[1:] == (4, True)


def test_dominant_value(spark):
    def pick(*rows):
        return A.dominant_by_weight(spark.createDataFrame([(1, *r) for r in rows], "k int, v string, w double"), ["k"], "v", "w").first()["dominant"]

    assert pick(("A", 400.0), ("B", 60.0), ("B", 60.0)) == "A"
    assert pick(("B", 100.0), ("A", 100.0)) == "A"
    assert pick((None, 300.0), ("A", 100.0)) is None
    assert pick((None, 100.0), ("A", 100.0)) == "A"


def test_mode_ties_go_to_the_smaller(spark):
    df = spark.createDataFrame([(1, 61.0), (1, 60.0), (1, 60.0), (1, 61.0), (1, None)], "k int, v double")
    assert A.mode_by_count(df, ["k"], "v").first()["mode"] == 60.0


def test_interval_ends_at_zero_count_for_their_side(spark):
    e = A.interval_edges(spark.createDataFrame([(1, 0.0, 30.0), (1, -30.0, 0.0)], "k int, s_lo double, s_hi double"), "k").first()
    assert (e["left_edge"], e["right_edge"], e["straddling"]) == (0.0, 0.0, 0)


def test_box_join_gives_each_pair_once(spark):
    left = spark.createDataFrame([(i, i * 7.0 % 50, i * 7.0 % 50 + i % 9) for i in range(60)], "i int, a double, b double")
    right = spark.createDataFrame([(j, j * 11.0 % 50, j * 11.0 % 50 + j % 7) for j in range(60)], "j int, c double, d double")
    got = sorted((r["i"], r["j"]) for r in J.box_join(left, right, [("a", "b")], [("c", "d")], 4.0).collect())
    l, r = left.collect(), right.collect()
    assert got == sorted((x["i"], y["j"]) for x in l for y in r if x["b"] >= y["c"] and x["a"] <= y["d"])


def test_geojson_comes_back(spark, tmp_path):
    from pyspark.sql import types as T

    lines = [[{"x": 1.234567, "y": 2.0}, {"x": 3.0, "y": 4.0}]]
    df = spark.createDataFrame([(2, None, lines), (1, "a", lines)], "n int, name string, g array<array<struct<x:double,y:double>>>")
    geojson.write_collection(df, str(tmp_path / "out"), F.lit("LineString"), "g", ["n", "name"], ["n"], 3)
    back = geojson.read_layer(spark, str(tmp_path / "out" / "part-*"), T.StructType.fromDDL("n int, name string")).collect()
    assert [(r["kind"], r["n"], r["name"]) for r in back] == [("LineString", 1, "a"), ("LineString", 2, None)]
    assert back[0]["g"][0][0]["x"] == 1.235 and back[0]["g"][0][1]["y"] == 4.0
    (tmp_path / "error.json").write_text('{"error": 500}')
    assert geojson.read_layer(spark, str(tmp_path / "error.json"), T.StructType.fromDDL("n int")).count() == 0


def test_fingerprints(spark, tmp_path):
    for name, text in (("a", "1"), ("b", "2"), ("c", "3")):
        (tmp_path / name).write_text(text)
    found = files.fingerprints(spark, str(tmp_path))
    expected = spark.createDataFrame([("a", 1, "no"), ("d", 1, "x"), *[tuple(r) for r in found.where("name = 'b'").collect()]], "name string, size long, sha256 string")
    assert {tuple(r) for r in files.fingerprint_diff(found, expected).collect()} == {("a", "changed"), ("c", "extra"), ("d", "missing")}


def test_object_keeps_null_keys(spark, tmp_path):
    files.write_object(spark.sql("select 1 as a, cast(null as int) as b"), str(tmp_path / "o"))
    assert spark.read.text(str(tmp_path / "o")).first()[0] == '{"a":1,"b":null}'


def test_ordered_neighbours_are_the_nearest(spark):
    rng = random.Random(8)
    near = lambda: rng.choice([rng.randint(-50, 50) / 2, rng.uniform(-40, 40), 7.0])
    left = [(i, near()) for i in range(300)] + [(900, None), (901, float("nan")), (902, 1e6), (3, 7.0)]
    right = [(i % 90, near()) for i in range(120)] + [(500, None), (501, 0.25), (502, -0.25), (503, float("nan"))]
    known = [(c, y) for c, y in right if y is not None and y == y]
    a, b = spark.createDataFrame(left, "i long, x double").withColumn("cell", F.lit("clash")), spark.createDataFrame(right, "c long, y double")
    for per_cell, reach in ((1, 3.0), (7, 100.0), (50_000, 0.5)):
        expected = []
        for i, x in left:
            best = min(((abs(x - y), c) for c, y in known), default=None) if x is not None and x == x else None
            if best and best[0] <= reach:
                expected.append((i, best[1], best[0]))
        found = J.nearest_1d(a, b, "x", "c", "y", reach, per_cell)
        assert found.columns == ["i", "x", "cell", "c", "d"]
        assert sorted((r["i"], r["c"], r["d"]) for r in found.collect()) == sorted(expected)
    assert J.nearest_1d(a.limit(0), b, "x", "c", "y", 9.0).count() == 0 and J.nearest_1d(a, b.limit(0), "x", "c", "y", 9.0).count() == 0


def test_left_box_join_keeps_rows_that_meet_nothing(spark):
    left = spark.createDataFrame([(1, 0.0, 9.0), (2, 100.0, 101.0)], "i int, a double, b double")
    right = spark.createDataFrame([(5, 4.0, 5.0)], "j int, c double, d double")
    got = {(r["i"], r["j"]) for r in J.box_join(left, right, [("a", "b")], [("c", "d")], 4.0, how="left").collect()}
    assert {(1, 5), (2, None)} <= got and got <= {(1, 5), (1, None), (2, None)}


def test_sides_are_edges_without_lengths(spark):
    ring = "array(array(named_struct('x', 0d, 'y', 0d), named_struct('x', 3d, 'y', 4d), named_struct('x', 0d, 'y', 4d)), array(named_struct('x', 1d, 'y', 1d)), cast(array() as array<struct<x:double,y:double>>))"
    r = spark.range(1).select(F.expr(ring).alias("g")).select(G.sides(F.col("g")).alias("s"), G.edges(F.col("g")).alias("e")).first()
    assert [tuple(x) for x in r["s"]] == [tuple(x)[:4] for x in r["e"]] == [(0.0, 0.0, 3.0, 4.0), (3.0, 4.0, 0.0, 4.0)]


def test_rows_that_share_a_box_are_met_once(spark, monkeypatch):
    left = [(k, float(k % 3), k % 3 + 1.0) for k in range(60)] + [(60, None, None), (61, 99.0, 99.5)]
    right = [(k, k % 5 + 0.5, k % 5 + 0.75) for k in range(50)]
    a, b = spark.createDataFrame(left, "i long, a double, b double"), spark.createDataFrame(right, "j long, c double, d double")
    sizes, axes = [], ([("a", "b")], [("c", "d")])

    def meet(x, y, *more):
        sizes.append((x.count(), y.count()))
        return J.box_join(x, y, *more, 4.0)

    got = sorted((r["i"], r["n"], r["least"], r["most"]) for r in J.met(a, b, *axes, "j", meet).collect())
    pairs = sorted((i, j) for i, p, q in left for j, c, d in right if p is not None and q >= c and p <= d)
    of = {i: [j for k, j in pairs if k == i] for i, _ in pairs}
    assert got == sorted((i, len(js), min(js), max(js)) for i, js in of.items()) and sizes == [(5, 5)]
    monkeypatch.setattr(J, "LISTED", 4)
    lists = [J.listed(a, axes[0], "i"), J.listed(b, axes[1], "j")]
    assert max(len(r["i"]) for r in lists[0].collect()) < 20
    met = J.box_join(*lists, *axes, 4.0).select(F.explode("i").alias("i"), "j").select("i", F.explode("j").alias("j"))
    assert sorted(map(tuple, met.collect())) == pairs
