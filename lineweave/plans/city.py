"""From layers to findings: segments with their attributes, streets, blocks, classes of block and the map's tables.

Layers, as ``lineweave.sources.layers`` reads them: ``streets`` (seg, localid, full_name, type_code, direction, f_node,
t_node, g), ``pms`` (localid, road_ft, pave_ft, lanes, curb, surface_type, functional_class, owner, maint_resp, pci,
inspection_year, g), ``unimproved`` (localid), ``zoning`` (is_residential, g), ``boundary`` (one row, g).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.functions import geometry as G
from lineweave.functions.nearness import within
from lineweave.functions.semantics import any_known, count_where, known, miles, rnd, tier, where
from lineweave.functions.simplify import simplify
from lineweave.operators import aggregates as A
from lineweave.operators import graph, tables
from lineweave.operators.joins import box_join, mixed_box_join, nearest
from lineweave.operators.polygons import points_in
from lineweave.plans.streets import BOX

LOCAL = "UL"  #: Fixed value: the functional class of local streets
NARROW = 18


def _inside(df: DataFrame, boundary: DataFrame, point: Column) -> DataFrame:
    """Rows whose point is inside the one polygon, which may have any number of corners."""
    rows = boundary.limit(2).count()
    if rows > 1:
        raise ValueError("the boundary must be one row")
    asked = df.withColumns({"_polygon": F.lit(1), "_p": point}).withColumns({"_x": F.col("_p.x"), "_y": F.col("_p.y")}).drop("_p")
    return points_in(asked, boundary.select(F.lit(1).alias("_polygon"), "g"), "_polygon", "_x", "_y").select(*df.columns)


def city_segments(streets: DataFrame, boundary: DataFrame) -> DataFrame:
    """Segments whose middle is in the city."""
    # Edges are built once for a row; each use of an expression would build them again.
    middle = G.bind(G.edges(F.col("g")), lambda e: G.bind(G.length(e), lambda n: F.struct(n.alias("len"), G.along(e, n / 2).alias("p"))))
    found = streets.withColumn("_m", middle).withColumn("len_ft", F.col("_m.len"))
    return _inside(found, boundary, F.col("_m.p")).drop("_m")


def city_sections(pms: DataFrame, boundary: DataFrame) -> DataFrame:
    """Pavement sections, also of several parts, whose centre is in the city."""
    e = G.edges(F.col("g"))
    return _inside(pms.withColumn("geom_len_ft", G.length(e)), boundary, G.line_centroid(e))


def sections_by_street(pms: DataFrame) -> DataFrame:
    """One row per localid: length-weighted widths, most frequent attributes (ties to the smaller value)."""
    pms, w = pms.where("localid is not null"), F.col("geom_len_ft")
    out = pms.groupBy("localid").agg(
        F.count(F.lit(1)).alias("n_sections"), F.sum(w).alias("pms_len_ft"), rnd(A.weighted_mean(F.col("road_ft"), w), 1).alias("road_ft"), F.min("road_ft").alias("road_min_ft"),
        F.max("road_ft").alias("road_max_ft"), rnd(A.weighted_mean(F.col("pave_ft"), w), 1).alias("pave_ft"), F.max("lanes").alias("lanes"), F.bool_or(F.col("curb") == "Y").alias("has_curb"),
        rnd(F.avg("pci"), 1).alias("pci"), F.max("inspection_year").alias("inspection_year"),
    )
    for c in ("surface_type", "functional_class", "owner", "maint_resp"):
        out = out.join(A.mode_by_count(pms, ["localid"], c, c), "localid", "left")
    return out


def street_segments(seg: DataFrame, sections: DataFrame, rolled: DataFrame, unimproved: DataFrame) -> DataFrame:
    """The product table: each segment with its right of way, confidence, pavement and flags."""
    none = unimproved.select("localid").distinct().withColumn("is_unimproved", F.lit(True))
    s = seg.join(sections, "localid", "left").join(rolled, "seg", "left").join(none, "localid", "left")
    both = F.col("row_width_ft").isNotNull() & F.col("road_ft").isNotNull()
    return s.withColumns(
        {
            "short": F.col("len_ft") < 60.0, "len_ft": rnd(F.col("len_ft"), 1), "confidence": A.confidence(F.col("n_measured"), F.col("row_width_spread_ft"), F.col("n_any")),
            "leftover_ft": F.when(both, rnd(F.col("row_width_ft") - F.col("road_ft"), 1)), "is_unimproved": known(F.col("is_unimproved")), "in_lot": F.col("n_in_taxlot") > 0,
            "missing_lots": F.col("n_no_lots") + F.col("n_one_side") > 0, "at_cap": F.col("n_at_cap") > 0,
        }
    )


def street_summary(segments: DataFrame) -> DataFrame:
    """One row per named street."""
    s = segments.where(F.trim("full_name") != "")
    w = F.col("len_ft")
    out = s.groupBy("full_name").agg(
        F.count(F.lit(1)).alias("n_segments"), rnd(F.sum(w.cast("decimal(18,4)")).cast("double"), 1).alias("len_ft"), rnd(A.weighted_mean(F.col("row_width_ft"), w), 1).alias("row_width_ft"),
        F.min("row_width_min_ft").alias("row_width_min_ft"), F.max("row_width_max_ft").alias("row_width_max_ft"), rnd(A.weighted_mean(F.col("road_ft"), w), 1).alias("road_ft"),
        count_where(F.col("confidence").isin("high", "medium")).alias("n_confident"),
    )
    for c in ("row_width_mode_ft", "functional_class", "maint_resp"):
        out = out.join(A.mode_by_count(s, ["full_name"], c, c), "full_name", "left")
    return out


# ---- blocks -----------------------------------------------------------------------------------------------------


def block_members(streets: DataFrame) -> DataFrame:
    """(seg, block_id) over the whole network, so that a block doesn't end at the city's edge."""
    return graph.blocks(streets, "seg", "f_node", "t_node")


def block_attributes(members: DataFrame, segments: DataFrame, sections: DataFrame) -> DataFrame:
    """Name, type and class that cover most length of each block; a segment's length counts for each of its sections."""
    s = members.join(segments.select("seg", "localid", "full_name", "type_code", "len_ft"), "seg")
    out = members.select("block_id").distinct()
    classes = s.join(sections.select("localid", "functional_class"), "localid")
    for rows, c in ((s, "full_name"), (s, "type_code"), (classes, "functional_class")):
        out = out.join(A.dominant_by_weight(rows, ["block_id"], c, "len_ft", c), "block_id", "left")
    return out


def blocks(members: DataFrame, segments: DataFrame, attributes: DataFrame) -> DataFrame:
    """Worst cases along each block that has a segment in the city."""
    s = members.join(segments.withColumn("_in", F.lit(True)), "seg", "left")
    feet = F.sum(F.col("len_ft").cast("decimal(18,4)")).cast("double")
    out = s.groupBy("block_id").agg(
        F.count(F.lit(1)).alias("n_segments"), F.count("_in").alias("n_city_segments"), rnd(feet, 1).alias("len_ft"), rnd(feet / 5280.0, 4).alias("len_mi"),
        F.max("road_max_ft").alias("road_max_ft"), F.min("road_min_ft").alias("road_min_ft"), count_where(F.col("road_max_ft").isNull()).alias("n_missing_road"),
        F.max("row_width_max_ft").alias("row_max_ft"), F.min("row_width_min_ft").alias("row_min_ft"), count_where(F.col("row_width_ft").isNull()).alias("n_missing_row"),
        count_where(~F.col("confidence").isin("high", "medium")).alias("n_not_confident"), F.bool_or("at_cap").alias("any_at_cap"),
    )
    return out.where("n_city_segments > 0").join(attributes, "block_id")


def narrow_blocks(block: DataFrame) -> DataFrame:
    return block.where((F.col("n_missing_road") == 0) & (F.col("road_max_ft") <= NARROW))


def residential_segments(seg: DataFrame, zoning: DataFrame, reach: float = 60.0, tile: float = 300.0) -> DataFrame:
    """(seg, is_residential): whether a residential zone lies within reach of the segment."""
    # Boxes and edges are made once for a row; the join's levels and cells name them many times.
    boxes = G.bounds(F.col("g"))
    out = {f"l{k}": v + (reach if k.endswith("max") else -reach) for k, v in boxes.items()}
    lines = tables.once(seg.select("seg", "g"), {"e": G.sides(F.col("g")), **out}).drop("g")
    zones = tables.once(zoning.where("is_residential").select("g"), {"z": G.sides(F.col("g")), **boxes}).drop("g")
    near = mixed_box_join(lines, zones, [("lxmin", "lxmax"), ("lymin", "lymax")], BOX, tile).where(within(F.col("e"), F.col("z"), reach))
    near = near.select("seg").distinct().withColumn("is_residential", F.lit(True))
    return seg.select("seg").join(near, "seg", "left").withColumn("is_residential", known(F.col("is_residential")))


def narrow_residential(members: DataFrame, seg: DataFrame, sections: DataFrame, residential: DataFrame, block: DataFrame) -> DataFrame:
    """Per block the three conditions: pavement no wider than 18 ft on record throughout, two-way throughout, some residence."""
    pave = sections.groupBy("localid").agg(F.max("pave_ft").alias("pave_max"), F.min("pave_ft").alias("pave_min"), F.max("road_ft").alias("road_max"))
    s = members.join(seg.select("seg", "localid", "direction"), "seg").join(pave, "localid", "left").join(residential, "seg", "left")
    out = s.groupBy("block_id").agg(
        F.max("pave_max").alias("pave_max_ft"), F.min("pave_min").alias("pave_min_ft"), F.max("road_max").alias("road_record_max_ft"), count_where(F.col("pave_max").isNull()).alias("n_missing_pave"),
        F.bool_and(F.col("direction") == 1).alias("cond_two_way"), F.bool_or(F.col("direction") == 1).alias("any_two_way"), F.bool_or("is_residential").alias("cond_residence"), F.bool_and("is_residential").alias("all_residential"),
    )
    out = out.withColumn("cond_width", (F.col("n_missing_pave") == 0) & (F.col("pave_max_ft") <= NARROW))
    return out.join(block.select("block_id", "full_name", "functional_class", "len_ft", "n_segments"), "block_id")


def convertible(narrow: DataFrame) -> DataFrame:
    """Eligible blocks and the shoulder each needs; a pavement width of 1 stands for unpaved."""
    ok = (F.col("n_missing_pave") == 0) & F.col("cond_two_way") & F.col("cond_residence") & (F.col("functional_class") == LOCAL) & (F.col("pave_max_ft") > 1)
    over = F.col("pave_max_ft") - NARROW
    return narrow.where(ok).withColumns({"each_side_ft": rnd(over / 2.0, 1), "one_side_ft": over, "already": over <= 0})


def edge_lines(profile: DataFrame, spacing: float = 5.0) -> DataFrame:
    """What an edge line would take on each block measured well enough; needs ``len_ft`` beside the curb profile."""
    over, n = F.col("curb_max_ft") - NARROW, F.col("n_measured")
    return profile.where("testable").withColumns(
        {
            "each_side_ft": rnd(over / 2.0, 1), "one_side_ft": rnd(over, 1), "already_ft": rnd(F.col("n_narrow") * spacing, 1), "needs_line_ft": rnd((n - F.col("n_narrow")) * spacing, 1),
            "unmeasured_ft": rnd(F.col("len_ft") - n * spacing, 1), "width_test": over <= 0, "confident": (over <= 0) & (F.col("edge_quality") == "street curb"),
        }
    )


# ---- the map's tables -------------------------------------------------------------------------------------------


def site_blocks(candidates: DataFrame, narrow: DataFrame, block: DataFrame, profile: DataFrame) -> DataFrame:
    """Eligible blocks by pavement records, and by curbs where records are missing; a block can be in both.

    A row per block and ``src`` that speaks for it: which sources do is an array, which is taken apart.
    """
    curbs = profile.where("testable").select("block_id", F.struct("curb_min_outer_ft", "curb_min_ft", "curb_max_ft").alias("c"))
    records = candidates.select("block_id", F.struct("pave_min_ft", "pave_max_ft", "each_side_ft").alias("p"))
    facts = narrow.select("block_id", (F.col("cond_width") & F.col("cond_two_way") & F.col("cond_residence")).alias("strict"), (F.col("any_two_way") & F.col("cond_residence")).alias("lived"))
    b = block.join(records, "block_id", "left").join(curbs, "block_id", "left").join(facts, "block_id", "left")
    unrecorded = (F.col("n_missing_road") > 0) & (F.col("functional_class") == LOCAL) & F.col("c").isNotNull() & F.col("lived")
    sources = F.filter(F.array(F.when(F.col("p").isNotNull(), "pms"), F.when(unrecorded, "curb")), lambda s: s.isNotNull())
    b = b.withColumn("src", F.explode(sources))
    by_record, narrowest, widest = F.col("src") == "pms", F.col("c.curb_min_outer_ft"), F.col("c.curb_max_ft")
    return b.select(
        "block_id", F.coalesce("full_name", F.lit("(unnamed)")).alias("full_name"), rnd(F.col("len_ft")).alias("len_ft"), "n_segments", "src",
        F.when(by_record, F.least("p.pave_min_ft", narrowest)).otherwise(F.coalesce(narrowest, "c.curb_min_ft")).alias("wn"), F.when(by_record, F.col("p.pave_max_ft")).otherwise(widest).alias("wx"),
        F.when(by_record & ~known(narrowest < F.col("p.pave_min_ft")), "pms").otherwise("curb").alias("nsrc"),
        F.when(by_record, F.col("p.each_side_ft")).otherwise(rnd((widest - NARROW) / 2.0, 1)).alias("sh"), F.when(by_record, F.col("strict")).otherwise(widest <= NARROW).alias("nrr"),
    )


def block_lines(members: DataFrame, segments: DataFrame, tolerance: float = 25.0) -> DataFrame:
    """(block_id, g): the simplified lines of a block's segments, in the order of their ids, as one geometry."""
    lines = segments.select("seg", simplify(F.col("g"), tolerance).alias("g"))
    parts = F.array_sort(F.collect_list(F.struct("seg", "g")))
    return members.join(lines, "seg").groupBy("block_id").agg(parts.alias("_p")).select("block_id", F.flatten(F.transform("_p", lambda s: s["g"])).alias("g"))


def totals(candidates: DataFrame, narrow: DataFrame, pinches: DataFrame, block: DataFrame) -> DataFrame:
    """One row of the figures quoted with the map."""
    strict = narrow.where("n_missing_pave = 0 and cond_width and cond_two_way and cond_residence")
    parts = [
        candidates.agg(F.count(F.lit(1)).alias("eligible_blocks"), miles(F.col("len_ft")).alias("eligible_miles")),
        strict.agg(F.count(F.lit(1)).alias("strict_blocks"), miles(F.col("len_ft")).alias("strict_miles")),
        pinches.agg(F.count(F.lit(1)).alias("narrowings"), count_where(F.col("least_ft") <= NARROW).alias("narrowings_under_18")),
        block.agg(count_where(F.col("n_missing_road") > 0).alias("untestable_blocks"), rnd(F.sum(where(F.col("n_missing_road") > 0, F.col("len_ft").cast("decimal(18,4)"))).cast("double") / 5280.0, 1).alias("untestable_miles")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


# ---- checks -----------------------------------------------------------------------------------------------------


def validation(segments: DataFrame) -> list[tuple[str, DataFrame]]:
    """Titled tables on coverage, shape and outliers of the measured widths, for ``lineweave.plans.report``."""
    w, road, left = F.col("row_width_ft"), F.col("road_ft"), F.col("leftover_ft")
    share = lambda c: segments.groupBy(c).agg(F.count(F.lit(1)).alias("segments"), miles(F.col("len_ft")).alias("miles"))
    outliers = {"at cap": F.col("at_cap"), "row under 20": w < 20, "row over 200": w > 200, "leftover below 0": left < 0, "roadway over 100": road > 100, "roadway under 8": road < 8}
    one = segments.agg(*(count_where(p).alias(f"n{k}") for k, p in enumerate(outliers.values())))
    found = one.select(F.explode(F.array(*(F.struct(F.lit(name).alias("check"), F.col(f"n{k}").alias("n")) for k, name in enumerate(outliers)))).alias("r")).select("r.*")
    steps = lambda x, s: tier(x, s, "above")
    return [
        ("confidence", share(F.col("confidence"))),
        ("row width, 2 ft", segments.where(w.isNotNull()).groupBy((2 * F.rint(w / 2)).alias("row_ft")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "row_ft").limit(15)),
        ("modal width", segments.where("row_width_mode_ft is not null").groupBy("row_width_mode_ft").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "row_width_mode_ft").limit(12)),
        ("off centre", segments.where("row_offcenter_ft is not null").groupBy(steps(F.abs("row_offcenter_ft"), [(1, "a. 1"), (3, "b. 3"), (10, "c. 10")]).alias("off")).agg(F.count(F.lit(1)).alias("n"))),
        ("leftover", segments.where(left.isNotNull()).groupBy(F.when(left < 0, "a. below 0").otherwise(steps(left, [(6, "b. 6"), (16, "c. 16"), (30, "d. 30")])).alias("leftover")).agg(F.count(F.lit(1)).alias("n"))),
        ("outliers", found),
        ("no pavement record", segments.where("n_sections is null").agg(F.count(F.lit(1)).alias("segments"), F.count_distinct("full_name").alias("streets"), any_known(F.col("full_name")).alias("such_as"))),
    ]


def sidewalk_check(stations: DataFrame, sidewalks: DataFrame, crossings: DataFrame) -> DataFrame:
    """Whether the nearest sidewalk on each side lies inside the right of way, a foot allowed.

    ``stations`` (station, left_ft, right_ft), ``crossings`` (station, s_lo, s_hi) of transects with ``sidewalks``,
    which only names what was crossed.
    """
    right = crossings.where("s_lo >= 0").groupBy("station").agg(F.min(F.struct("s_lo", "s_hi")).alias("r"))
    left = crossings.where("s_hi <= 0").groupBy("station").agg(F.max(F.struct("s_hi", "s_lo")).alias("l"))
    far = stations.join(right, "station", "left").join(left, "station", "left")
    side = lambda far_edge, edge, name: far.where(far_edge.isNotNull()).select("station", F.lit(name).alias("side"), (edge - far_edge).alias("spare_ft"), (far_edge <= edge + 1).alias("inside"))
    return side(F.col("r.s_hi"), F.col("right_ft"), "right").unionByName(side(-F.col("l.s_lo"), F.col("left_ft"), "left"))


def nearest_line(dots: DataFrame, lines: DataFrame, dot: str, line: str, reach: float, tile: float = 300.0) -> DataFrame:
    """(dot, line, d): of each dot (p) the nearest line (g) no further than ``reach``; the smaller of two as near."""
    dots = dots.select(dot, *(F.col(f"p.{k}").alias(n) for k, n in (("x", "px"), ("y", "py"), ("x", "qx"), ("y", "qy"))))
    low = [(F.col(k) - reach).alias(k) for k in ("xmin", "ymin")]
    high = [(F.col(k) + reach).alias(k) for k in ("xmax", "ymax")]
    lines = lines.withColumns(G.bounds(F.col("g"))).select(line, G.edges(F.col("g")).alias("e"), *low, *high)
    pairs = box_join(dots, lines, [("px", "qx"), ("py", "qy")], BOX, tile)
    pairs = pairs.withColumn("d", G.point_distance(F.col("e"), F.col("px"), F.col("py"))).where(F.col("d") <= reach)
    return nearest(pairs, dot, line)


def extension_check(extensions: DataFrame, seg: DataFrame, tile: float = 300.0, reach: float = 30.0) -> DataFrame:
    """Each curb extension with the nearest segment less than ``reach`` away, and how far their widths differ."""
    dots = extensions.select("ext", G.line_centroid(G.edges(F.col("g"))).alias("p"))
    best = nearest_line(dots, seg, "ext", "seg", reach, tile).where(F.col("d") < reach)
    off = F.col("road_ft") - F.col("ext_ft")
    best = best.join(extensions.select("ext", F.col("road_ft").alias("ext_ft")), "ext").join(seg.select("seg", "road_ft"), "seg")
    return best.select("ext", "seg", rnd(F.col("d"), 2).alias("d"), off.alias("off_ft"), known(off == 0).alias("exact"), known(F.abs(off) <= 2).alias("close"))


def curb_offsets(curbs: DataFrame, seg: DataFrame, reach: float = 200.0, tile: float = 300.0) -> DataFrame:
    """(curb, kind, offset_ft): how far the middle of each curb is from the nearest centre line, which tells what kinds are."""
    middles = curbs.select("curb", G.line_centroid(G.edges(F.col("g"))).alias("p"))
    found = nearest_line(middles, seg, "curb", "seg", reach, tile)
    return curbs.select("curb", "kind").join(found.select("curb", F.col("d").alias("offset_ft")), "curb")
