"""The whole city on a layout small enough to know every answer."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.functions import geometry as G
from lineweave.functions.projection import project
from lineweave.operators import aggregates as A
from lineweave.operators import graph
from lineweave.plans import city, report, runner, streets
from lineweave.sources import geojson
from lineweave.sources import layers as source_layers


def line(*points):
    return [[{"x": float(x), "y": float(y)} for x, y in points]]


def box(x0, x1, y0, y1):
    return line((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))


@pytest.fixture(scope="module")
def layers(spark):
    g = f"g {G.PARTS}"
    return {
        # Two segments through a degree-2 node make one block; the third is apart and outside the city.
        "streets": spark.createDataFrame(
            [(1, 11, "Main St", 1, 1, 100, 101, line((0, 0), (300, 0))), (2, 12, "Main St", 1, 1, 101, 102, line((300, 0), (600, 0))), (3, 13, " ", 1, 2, 200, 201, line((9000, 0), (9300, 0)))],
            f"seg int, localid int, full_name string, type_code int, direction int, f_node int, t_node int, {g}",
        ),
        "pms": spark.createDataFrame(
            [(11, 16, 16, 2.0, "Y", "AC", "UL", "C", "C", 80.0, 2020, line((0, 0), (300, 0))), (12, 18, 18, 2.0, "N", "AC", "UL", "C", "C", 60.0, 2021, line((300, 0), (450, 0))), (12, None, 18, 1.0, None, "PC", "UL", "C", "C", None, 2019, line((450, 0), (600, 0)))],
            f"localid int, road_ft int, pave_ft int, lanes double, curb string, surface_type string, functional_class string, owner string, maint_resp string, pci double, inspection_year int, {g}",
        ),
        "lots": spark.createDataFrame([(1, box(-50, 650, 25, 125)), (2, box(-50, 650, -125, -25))], f"lot int, {g}"),
        "zoning": spark.createDataFrame([(True, box(0, 300, 55, 500)), (False, box(300, 600, 0, 500))], f"is_residential boolean, {g}"),
        "boundary": spark.createDataFrame([(box(-1000, 1000, -1000, 1000),)], g),
        "curbs": spark.createDataFrame([(1, 3110, line((-20, 8), (620, 8))), (2, 3110, line((-20, -8), (620, -8))), (3, 3110, line((100.5, 5), (121, 5)))], f"curb int, kind int, {g}"),
        "unimproved": spark.createDataFrame([(12,)], "localid int"),
    }


def test_city(spark, layers):
    seg = city.city_segments(layers["streets"], layers["boundary"])
    assert sorted(r["seg"] for r in seg.collect()) == [1, 2]
    pms = city.city_sections(layers["pms"], layers["boundary"])
    sections = city.sections_by_street(pms)
    two = sections.where("localid = 12").first()
    assert (two["road_ft"], two["has_curb"], two["surface_type"], two["n_sections"]) == (18.0, False, "AC", 2)
    rolled = A.rollup_stations(streets.row_widths(seg, layers["lots"]), "seg")
    segments = city.street_segments(seg, sections, rolled, layers["unimproved"]).cache()
    rows = {r["seg"]: r for r in segments.collect()}
    assert all(r["row_width_ft"] == 50.0 and r["confidence"] == "high" for r in rows.values())
    assert rows[1]["leftover_ft"] == 34.0 and not rows[1]["is_unimproved"] and rows[2]["is_unimproved"]
    summary = city.street_summary(segments).first()
    assert (summary["full_name"], summary["len_ft"], summary["road_ft"], summary["functional_class"]) == ("Main St", 600.0, 17.0, "UL")

    members = city.block_members(layers["streets"])
    block = city.blocks(members, segments, city.block_attributes(members, segments, pms)).cache()
    only = block.collect()
    assert [(b["block_id"], b["n_segments"], b["road_max_ft"], b["full_name"]) for b in only] == [(1, 2, 18, "Main St")]
    assert city.narrow_blocks(block).count() == 1
    residential = city.residential_segments(seg, layers["zoning"])
    assert {r["seg"]: r["is_residential"] for r in residential.collect()} == {1: True, 2: True}
    narrow = city.narrow_residential(members, seg, pms, residential, block).cache()
    n = narrow.first()
    assert n["cond_width"] and n["cond_two_way"] and n["cond_residence"] and n["pave_max_ft"] == 18
    candidates = city.convertible(narrow)
    assert [(c["each_side_ft"], c["one_side_ft"], c["already"]) for c in candidates.collect()] == [(0.0, 0, True)]

    ends = graph.end_classes(layers["streets"], "seg", "f_node", "t_node")
    gaps = streets.curb_gaps(streets.curb_stations(seg.withColumns({"road_ft": F.lit(16), "pave_ft": F.lit(16)}), ends), layers["curbs"]).cache()
    profile = streets.curb_profile(gaps.join(members, "seg"), ["block_id"]).join(block.select("block_id", "len_ft"), "block_id")
    p = profile.first()
    assert (p["curb_min_ft"], p["curb_max_ft"], p["edge_quality"], p["testable"]) == (13.0, 16.0, "street curb", True)
    assert city.edge_lines(profile).first()["confident"]
    pinches = streets.narrowings(gaps)
    assert [(r["seg"], r["start_ft"], r["end_ft"], r["run_ft"], r["least_ft"], r["narrowing_ft"]) for r in pinches.collect()] == [(1, 105.0, 120.0, 20.0, 13.0, 3.0)]
    site = city.site_blocks(candidates, narrow, block, profile).collect()
    assert [(s["block_id"], s["wn"], s["wx"], s["src"], s["nsrc"], s["nrr"]) for s in site] == [(1, 13.0, 18.0, "pms", "curb", True)]
    assert city.block_lines(members, segments).where("block_id = 1").first()["g"] == [[tuple(p.values()) for p in part] for part in [*line((0, 0), (300, 0)), *line((300, 0), (600, 0))]]
    t = city.totals(candidates, narrow, pinches, block).first()
    assert (t["eligible_blocks"], t["strict_blocks"], t["narrowings"], t["narrowings_under_18"], t["untestable_blocks"]) == (1, 1, 1, 1, 0)
    text = report.render(city.validation(segments))
    assert "confidence" in text and "outliers" in text


def test_checks(spark, layers):
    stations = spark.createDataFrame([(1, 25.0, 25.0)], "station int, left_ft double, right_ft double")
    crossings = spark.createDataFrame([(1, 10.0, 16.0), (1, 30.0, 35.0), (1, -27.0, -20.0)], "station int, s_lo double, s_hi double")
    found = {r["side"]: (r["spare_ft"], r["inside"]) for r in city.sidewalk_check(stations, None, crossings).collect()}
    assert found == {"right": (9.0, True), "left": (-2.0, False)}
    ext = spark.createDataFrame([(7, 18.0, line((100, 10), (110, 10)))], f"ext int, road_ft double, g {G.PARTS}")
    seg = layers["streets"].withColumn("road_ft", F.lit(16.0))
    assert [tuple(r) for r in city.extension_check(ext, seg).collect()] == [(7, 1, 10.0, -2.0, False, True)]


def test_runner_writes_tables_maps_and_report(spark, layers, tmp_path):
    t = runner.measure(spark, layers, str(tmp_path))
    runner.export(t, layers["boundary"], str(tmp_path))
    assert [(r["seg"], r["row_width_ft"]) for r in t["segment"].orderBy("seg").collect()] == [(1, 50.0), (2, 50.0)]
    one = t["site"].collect()
    assert [(s["block_id"], s["wn"], s["wx"], s["src"], s["nsrc"], s["sh"], s["nrr"]) for s in one] == [(1, 13.0, 18.0, "pms", "curb", 0.0, True)]
    site = geojson.read_layer(spark, f"{tmp_path}/maps/blocks/part-*", T.StructType.fromDDL("block_id int, street string, bl double, nseg int, rw double, nrr boolean")).collect()
    assert [(r["block_id"], r["street"], r["bl"], r["nseg"], r["rw"], r["nrr"]) for r in site] == [(1, "Main St", 600.0, 2, 50.0, True)] * 2
    for name in ("convertible_blocks", "convertible_streets"):
        found = json.loads("".join(r["value"] for r in spark.read.text(f"{tmp_path}/maps/{name}/part-*").collect()))
        (f,) = found["features"]
        assert f["properties"]["stroke-width"] == 4 and f["properties"]["status"] == "qualifies today" and len(f["geometry"]["coordinates"]) == 2
    (pinch,) = json.loads("".join(r["value"] for r in spark.read.text(f"{tmp_path}/maps/narrowings/part-*").collect()))["features"]
    assert (pinch["properties"]["lkind"], pinch["properties"]["rkind"], pinch["properties"]["w"]) == (3110, 3110, 13.0)
    csv = spark.read.option("header", True).csv(f"{tmp_path}/csv/segment").collect()
    assert [r["seg"] for r in csv] == ["1", "2"]
    assert spark.read.json(f"{tmp_path}/totals").first()["eligible_blocks"] == 1
    text = "\n".join(r["value"] for r in spark.read.text(f"{tmp_path}/report").collect())
    assert all(f"== {title} ==" in text for title in ("confidence", "conditions one by one", "edge lines", "narrowings", "curb kinds by offset"))
    offsets = {r["curb"]: r["offset_ft"] for r in t["curb_offset"].collect()}
    assert offsets == {1: 8.0, 2: 8.0, 3: 5.0}


def test_two_boundaries_are_refused(spark, layers):
    two = layers["boundary"].unionByName(layers["boundary"])
    with pytest.raises(Exception, match="the boundary must be one row"):
        city.city_segments(layers["streets"], two).collect()


def test_layers_are_read_in_degrees(spark, layers, tmp_path):
    streets_ = layers["streets"].select(F.col("seg").alias("OBJECTID"), F.col("localid").alias("LOCALID"), F.col("full_name").alias("FULL_NAME"), F.col("f_node").alias("F_NODE"), F.col("t_node").alias("T_NODE"), project(F.col("g"), inverse=True).alias("g"))
    geojson.write_collection(streets_, f"{tmp_path}/page1", F.lit("LineString"), "g", ["OBJECTID", "LOCALID", "FULL_NAME", "F_NODE", "T_NODE"], ["OBJECTID"])
    geojson.write_collection(streets_.withColumn("OBJECTID", F.col("OBJECTID") + 10), f"{tmp_path}/page2", F.lit("LineString"), "g", ["OBJECTID", "LOCALID", "FULL_NAME", "F_NODE", "T_NODE"], ["OBJECTID"])
    (tmp_path / "page3").mkdir()
    (tmp_path / "page3" / "part-0").write_text('{"error": "busy"}')
    for place in (f"{tmp_path}/page*/part-*", [f"{tmp_path}/page1/part-*", f"{tmp_path}/page2/part-*"]):
        back = {r["seg"]: r for r in source_layers.read(spark, "streets", place).collect()}
        assert sorted(back) == [1, 2, 3, 11, 12, 13]
        assert abs(back[1]["g"][0][1]["x"] - 300) < 1e-3 and abs(back[12]["g"][0][0]["x"] - 300) < 1e-3 and back[3]["full_name"] == " "


def test_edges_are_built_once_for_a_row(spark, layers):
    """Each use of an expression would build them again."""
    built = lambda df: df._jdf.queryExecution().analyzed().toString().upper().count("SQRT(")
    once = built(layers["streets"].select(G.edges(F.col("g")).alias("e")))
    assert once > 0 and built(layers["streets"].select(G.line_centroid(G.edges(F.col("g"))).alias("p"))) == once
    assert built(city.city_segments(layers["streets"], layers["boundary"])) == once
