"""Boxes that are met, counted without pairs, against an independent engine."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lineweave import catalogue
from lineweave.operators import joins as J
from lineweave.operators.overlaps import overlapped


def odd_boxes(spark, path, n, names, seed, wide):
    """Boxes on two axes, whole and halves: points, equal ones, some turned, endless, unknown or not a number, keys that are shared or null."""
    r, inf = np.random.default_rng(seed), float("inf")
    rows = []
    for k in range(n):
        key = None if k % 41 == 0 else int(k % (n // 2)) - 7
        box = []
        for _ in range(2):
            a = float(r.integers(-40, 120)) / 2
            b = a + (0.0 if k % 7 == 0 else float(r.integers(0, wide)) / 2) - (9.0 if k % 29 == 0 else 0.0)
            box += [a, b]
        if k % 37 == 0:
            box[k % 4] = None
        if k % 53 == 0:
            box[1], box[2] = float("nan"), -inf
        rows.append((key, *box))
    spark.createDataFrame(rows, f"{names[0]} long, " + ", ".join(f"{c} double" for c in names[1:])).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("axes", [1, 2])
@pytest.mark.parametrize("rows, crowd", [(200_000, 1_000_000), (60, 1_000_000), (90, 13)])
def test_counts_as_sql_in_tiles_and_parts(spark, tmp_path, axes, rows, crowd):
    a = odd_boxes(spark, f"{tmp_path}/a", 400, ["i", "x0", "x1", "y0", "y1"], 1, 12)
    b = odd_boxes(spark, f"{tmp_path}/b", 500, ["j", "u0", "u1", "v0", "v1"], 2, 150)
    mine, theirs = [("x0", "x1"), ("y0", "y1")][:axes], [("u0", "u1"), ("v0", "v1")][:axes]

    def pairs(x, y, p, q):  # of turned boxes alone
        return x.join(y, [F.col(p[k][1]) >= F.col(q[k][0]) for k in range(axes)] + [F.col(p[k][0]) <= F.col(q[k][1]) for k in range(axes)])

    got = overlapped(a, b, "i", mine, theirs, "j", pairs, rows, crowd)
    assert got.columns == ["i", "n", "least", "most"]
    meet = " and ".join(f"{p} >= {c} and {o} <= {d}" for (o, p), (c, d) in zip(mine, theirs))
    sql = f"select i, count(*), min(j), max(j) from '{tmp_path}/a/*.parquet' join '{tmp_path}/b/*.parquet' on {meet} group by i"
    wanted = duckdb.sql(sql).fetchall()
    known = lambda found: sorted(map(str, map(tuple, found)))
    assert len(wanted) > 150 and known(got.collect()) == known(wanted)


def test_turned_boxes_meet_by_cells_too(spark):
    a = spark.createDataFrame([(1, 0.0, 40.0), (2, 35.0, 75.0), (3, 100.0, 90.0)], "i long, a double, b double")
    b = spark.createDataFrame([(7, 38.0, 10.0), (8, 60.0, 80.0), (9, 80.0, 110.0)], "j long, c double, d double")
    got = overlapped(a, b, "i", [("a", "b")], [("c", "d")], "j", lambda *sides: J.box_join(*sides, 30.0)).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 7, 7), (2, 1, 8, 8), (3, 1, 9, 9)]


@pytest.mark.parametrize("name", ["tile_bbox_join", "mixed_boxes_join"])
def test_boxes_are_counted_without_pairs(spark, capsys, name):
    catalogue.QUERIES[name](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "FlatMapCoGroupsInArrow" in plan


@pytest.mark.parametrize("name, tables", [("tile_bbox_join", "orders lineitem"), ("mixed_boxes_join", "orders part")])
def test_all_boxes_in_one_place(spark, tmp_path, name, tables):
    """Every box in one place or near it: as many pairs as there are, a hundred million or more."""
    n = 20_000
    spark.range(n).selectExpr("id as o_orderkey", "1000.0D + id % 500 / 100 as o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(n).selectExpr("id as l_partkey", "1 as l_linenumber", "250.0D + id % 997 / 800 as l_extendedprice", "50.0D as l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1, n + 1).selectExpr("id as p_partkey", "90000.0D / 97 as p_retailprice", "50 as p_size").write.parquet(f"{tmp_path}/part.parquet")
    found = catalogue.QUERIES[name](spark, str(tmp_path)).agg(F.count("*"), F.sum("n"), F.min("least_part"), F.max("most_part")).first()
    if name == "tile_bbox_join":
        assert tuple(found) == (n, n * n, 0, n - 1)
    else:
        sql = catalogue.ORACLES[name]
        for t in tables.split():
            sql = sql.replace(f"from {t}", f"from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
        assert tuple(found) == duckdb.sql(f"select count(*), sum(n)::bigint, min(least_part), max(most_part) from ({sql})").fetchall()[0]


def test_pairs_by_clusters_and_lists_as_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "LISTED", 9)  # so that cells and boxes come in several lists
    a = odd_boxes(spark, f"{tmp_path}/a", 300, ["i", "x0", "x1", "y0", "y1"], 3, 12).where("x1 = x1 and y0 > double('-inf')")
    b = odd_boxes(spark, f"{tmp_path}/b", 200, ["j", "u0", "u1", "v0", "v1"], 4, 90).where("u1 = u1 and v0 > double('-inf')")
    a, b = (x.unionByName(x.limit(40)).unionByName(x.limit(40)) for x in (a.where("x0 <= x1 and y0 <= y1"), b))
    for name, x in (("c", a), ("d", b)):
        x.write.parquet(f"{tmp_path}/{name}")
    got = J.listed_pairs(spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/d"), [("x0", "x1"), ("y0", "y1")], [("u0", "u1"), ("v0", "v1")], "i", "j", 7.0)
    sql = f"select i, j from '{tmp_path}/c/*.parquet' join '{tmp_path}/d/*.parquet' on x1 >= u0 and x0 <= u1 and y1 >= v0 and y0 <= v1"
    wanted = duckdb.sql(sql).fetchall()
    assert len(wanted) > 3000 and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))


def test_unknown_keys_are_in_pairs(spark, tmp_path):
    spark.range(300).selectExpr("nullif(id % 100, 7) as o_orderkey", "1000.0D + id / 4 as o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(60).selectExpr("nullif(id % 20, 3) as p_partkey", "10 + id % 30 * 0.01D as p_retailprice", "int(40 + id % 5) as p_size").write.parquet(f"{tmp_path}/part.parquet")
    sql = catalogue.ORACLES["tile_bbox_join_2d"]
    for t in ("orders", "part"):
        sql = sql.replace(f"from {t}", f"from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    wanted = duckdb.sql(sql).fetchall()
    found = catalogue.QUERIES["tile_bbox_join_2d"](spark, str(tmp_path)).collect()
    assert any(i is None for i, _ in wanted) and any(j is None for _, j in wanted) and sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
