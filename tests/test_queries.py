"""Every registered query with SQL against an independent engine on the small tables."""

import math
from collections import Counter

import duckdb
import pytest

from lineweave import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if isinstance(v, bool) or v is None or isinstance(v, str):
            return str(v)
        return "None" if isinstance(v, float) and math.isnan(v) else repr(float(v))

    return sorted(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    result = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())


def test_projection_comes_back(spark):
    off = catalogue.QUERIES["lcc_roundtrip"](spark, SF).agg({"off_lon": "max", "off_lat": "max"}).first()
    assert max(off) <= 0.001


def test_simplified_lines_lose_points_with_the_tolerance(spark):
    for r in catalogue.QUERIES["douglas_peucker"](spark, SF).collect():
        assert r["n"] >= r["n_4"] >= r["n_25"] >= r["n_50"] >= min(2, r["n"])


def test_hot_joins_use_no_nested_loop(spark, capsys):
    for name in ("tile_bbox_join", "tile_bbox_join_2d", "nearest_match", "within_distance_flag", "interval_overlay_full"):
        catalogue.QUERIES[name](spark, SF).explain()
        plan = capsys.readouterr().out
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_distance_to_a_set_looks_at_every_part(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["p_partkey"]: r["d"] for r in catalogue.QUERIES["min_distance_to_set_full"](spark, sf).collect()}
    balances = [r[0] for r in spark.read.parquet(f"{sf}/supplier.parquet").select("s_acctbal").collect()]
    least = {r["p_partkey"]: min(abs(r["p_retailprice"] * 3 - b) for b in balances) for r in spark.read.parquet(f"{sf}/part.parquet").collect()}
    assert len(least) == 2000 and got == pytest.approx({k: d for k, d in least.items() if d <= 200}, abs=1e-6) and len(got) > 400


def test_points_on_notched_corners_count_as_in_sql(spark, duck, tmp_path):
    """Keys of many residues, by which points lie on edges and corners of their polygons."""
    orders = spark.range(101 * 830).selectExpr("id as o_orderkey", "id div 101 * 12 as o_custkey")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    sql = catalogue.ORACLES["pip_parity"].replace("from orders", f"from read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    wanted = duck.execute(sql).fetchall()
    found = catalogue.QUERIES["pip_parity"](spark, str(tmp_path)).collect()
    assert len(wanted) == 101 * 830 and sorted(map(tuple, found)) == sorted(wanted)


@pytest.mark.parametrize("name", ["pip_parity", "line_near_polygon"])
def test_points_at_keys_below_0_or_unknown_count_as_in_sql(spark, duck, tmp_path, name):
    """By keys below 0 sizes and places are below 0 too; by unknown ones either or both are unknown."""
    orders = spark.range(202 * 401).selectExpr("nullif(id % 202 - 100, 101) + 101 * (id div 202) * if(id % 202 < 100, -1, 1) as o_orderkey", "nullif(id div 202 - 200, 200) * 29 as o_custkey")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    sql = catalogue.ORACLES[name].replace("from orders", f"from read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    wanted = duck.execute(sql).fetchall()
    found = catalogue.QUERIES[name](spark, str(tmp_path)).collect()
    assert len(wanted) == 202 * 401 and Counter(map(tuple, found)) == Counter(wanted)
