"""From layers to outputs: everything measured of a city, as tables, map layers and a report below one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.functions.projection import project
from lineweave.functions.semantics import any_known, count_where, rnd, tier
from lineweave.functions.simplify import simplify
from lineweave.operators import aggregates as A
from lineweave.operators import graph
from lineweave.operators.quantiles import quantiles
from lineweave.operators.stages import Stages, Table
from lineweave.plans import city, report, streets
from lineweave.sources import files, geojson, layers


def measure(spark: SparkSession, layer: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Runs all stages over the layers. Each table is written once and read by the stages behind it; a second run over the same
    folder makes only those tables again whose layers have changed."""
    stages = Stages(spark, f"{folder}/tables")
    of = {name: stages.source(df) for name, df in layer.items()}
    t: dict[str, Table] = {}

    def keep(name: str, make: Callable[..., DataFrame], *inputs: Table) -> Table:
        t[name] = stages.table(name, make, *inputs)
        return t[name]

    seg = keep("seg", city.city_segments, of["streets"], of["boundary"])
    pms = keep("sections", city.city_sections, of["pms"], of["boundary"])
    widths = keep("row_width", streets.row_widths, seg, of["lots"])
    segment = keep("segment", lambda s, p, w, u: city.street_segments(s, city.sections_by_street(p), A.rollup_stations(w, "seg"), u), seg, pms, widths, of["unimproved"])
    keep("street", city.street_summary, segment)
    members = keep("block_member", city.block_members, of["streets"])
    block = keep("block", lambda m, s, p: city.blocks(m, s, city.block_attributes(m, s, p)), members, segment, pms)
    keep("narrow_block", city.narrow_blocks, block)
    narrow = keep("narrow_residential", lambda m, s, p, z, b: city.narrow_residential(m, s, p, city.residential_segments(s, z), b), members, seg, pms, of["zoning"], block)
    convertible = keep("convertible", city.convertible, narrow)

    def gaps_of(s: DataFrame, p: DataFrame, all_streets: DataFrame, curbs: DataFrame) -> DataFrame:
        widest = city.sections_by_street(p).select("localid", F.col("road_max_ft").alias("road_ft"), F.col("pave_ft"))
        ends = graph.end_classes(all_streets, "seg", "f_node", "t_node")
        return streets.curb_gaps(streets.curb_stations(s.join(widest, "localid", "left"), ends), curbs)

    gaps = keep("curb_gap", gaps_of, seg, pms, of["streets"], of["curbs"])
    keep("segment_curb", lambda g: streets.curb_profile(g, ["seg"]), gaps)
    by_block = lambda g, m, b: streets.curb_profile(g.join(m, "seg"), ["block_id"]).join(b.select("block_id", "len_ft"), "block_id")
    curb = keep("block_curb", by_block, gaps, members, block)
    keep("edge_line", city.edge_lines, curb)
    named = lambda b: b.select("block_id", "full_name", "functional_class")
    narrowing = keep("narrowing", lambda g, m, b: streets.narrowings(g).join(m, "seg", "left").join(named(b), "block_id", "left"), gaps, members, block)
    keep("curb_offset", lambda c, s: city.curb_offsets(c.dropDuplicates(["curb"]), s), of["curbs"], seg)
    keep("site", city.site_blocks, convertible, narrow, block, curb)
    found = {name: table.df for name, table in t.items()}
    found["totals"] = city.totals(*(x.df for x in (convertible, narrow, narrowing, block)))
    return found


# ---- map layers -------------------------------------------------------------------------------------------------

#: The shoulder, in feet each side, up to which a block has a status.
STEPS = [(0.0, "qualifies today"), (1.0, "1 ft"), (3.0, "3 ft"), (5.0, "5 ft")]


def styled(shoulder: Column) -> dict[str, Column]:
    """Status and line style by the shoulder that is needed; names as map renderers ask for them, with hyphens."""
    return {"status": tier(shoulder, STEPS, "more"), "stroke-width": F.when(shoulder <= 0, 4).otherwise(3), "stroke-opacity": F.lit(0.9)}


def site_lines(t: dict[str, DataFrame], tolerance: float = 4.0) -> DataFrame:
    """A line for each segment of the blocks of the site, with the block's figures and the segment's right of way."""
    lines = t["segment"].select("seg", rnd(F.col("row_width_ft"), 1).alias("rw"), simplify(F.col("g"), tolerance).alias("g"))
    rows = t["site"].join(t["block_member"], "block_id").join(lines, "seg")
    return rows.select("block_id", "seg", F.col("full_name").alias("street"), "wn", "wx", "src", "nsrc", "sh", "nrr", F.col("len_ft").alias("bl"), F.col("n_segments").alias("nseg"), "rw", "g")


def narrowing_lines(t: dict[str, DataFrame]) -> DataFrame:
    return t["narrowing"].select(
        "seg", "start_ft", F.coalesce("full_name", F.lit("(unnamed)")).alias("street"), "block_id", F.col("functional_class").alias("fclass"), F.col("least_ft").alias("w"), F.col("usual_ft").alias("s"),
        F.col("narrowing_ft").alias("d"), F.col("run_ft").alias("l"), F.col("left_kind").alias("lkind"), F.col("right_kind").alias("rkind"), "g",
    )


def block_features(t: dict[str, DataFrame], most: float = 3.0) -> DataFrame:
    """Blocks that qualify or nearly do, one line of several parts each."""
    c = t["convertible"].where(F.col("each_side_ft") <= most).join(city.block_lines(t["block_member"], t["segment"]), "block_id")
    c = c.withColumns(styled(F.col("each_side_ft")))
    return c.select(
        "block_id", F.coalesce("full_name", F.lit("(unnamed)")).alias("street"), "status", F.col("each_side_ft").alias("shoulder_ft"), F.col("pave_max_ft").alias("pavement_ft"),
        rnd(F.col("len_ft")).cast("int").alias("length_ft"), "stroke-width", "stroke-opacity", "g",
    )


def street_features(t: dict[str, DataFrame]) -> DataFrame:
    """Named streets with the widest shoulder that any of their blocks needs."""
    c = t["convertible"].where(F.trim("full_name") != "").join(city.block_lines(t["block_member"], t["segment"]), "block_id")
    parts = F.array_sort(F.collect_list(F.struct("block_id", "g")))
    miles = rnd(F.sum(F.col("len_ft").cast("decimal(18,4)")).cast("double") / 5280.0, 3)
    s = c.groupBy(F.col("full_name").alias("street")).agg(
        F.max("each_side_ft").alias("shoulder_each_side_ft_worst"), F.min("pave_max_ft").alias("pavement_min_ft"), F.max("pave_max_ft").alias("pavement_max_ft"), F.count(F.lit(1)).alias("blocks"),
        miles.alias("miles"), count_where(F.col("already")).alias("blocks_already_nrr"), F.flatten(F.transform(parts, lambda p: p["g"])).alias("g"),
    )
    return s.withColumns(styled(F.col("shoulder_each_side_ft_worst")))


def reports(t: dict[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    """Titled tables of all stages, for ``lineweave.plans.report``."""
    c, n, e, b, p = t["convertible"], t["narrow_residential"], t["edge_line"], t["block"], t["narrowing"]
    length = lambda df: rnd(F.sum("len_ft") / 5280.0, 1).alias("miles")
    each = F.col("each_side_ft")
    funnel = [("pavement on record", F.col("n_missing_pave") == 0), ("18 ft or less", F.col("pave_max_ft") <= city.NARROW), ("two-way", F.col("cond_two_way")), ("residence", F.col("cond_residence"))]
    share = lambda df, by: df.groupBy(by).agg(F.count(F.lit(1)).alias("blocks"), length(df)).orderBy(F.desc("blocks"))
    places = {f"p{int(100 * q)}": q for q in (0.05, 0.5, 0.95)}
    offsets = quantiles(t["curb_offset"], ["kind"], "offset_ft", places).select("kind", F.col("n").alias("curbs"), *(rnd(F.col(c), 1).alias(c) for c in places))
    return city.validation(t["segment"]) + [
        ("blocks", b.agg(F.count(F.lit(1)).alias("blocks"), length(b), count_where(F.col("n_missing_road") > 0).alias("untestable"), F.max("n_segments").alias("most_segments"))),
        ("narrow blocks by class", share(t["narrow_block"], F.coalesce("functional_class", F.lit("?")).alias("class"))),
        ("conditions one by one", A.funnel(n, funnel)),
        ("shoulder needed", share(c, tier(each, STEPS, "more").alias("each_side"))),
        ("at shoulders up to", A.at_thresholds(c, "each_side_ft", [0, 1, 2, 3, 5], "len_ft")),
        ("curb profile of blocks", t["block_curb"].groupBy("edge_quality").agg(F.count(F.lit(1)).alias("blocks"), count_where(F.col("testable")).alias("testable"), F.sum("n_measured").alias("measured"))),
        ("edge lines", e.agg(count_where(F.col("width_test")).alias("narrow"), count_where(F.col("confident")).alias("confident"), rnd(F.sum("needs_line_ft") / 5280.0, 1).alias("line_miles"))),
        ("narrowings", p.groupBy("left_kind", "right_kind").agg(F.count(F.lit(1)).alias("n"), F.min("least_ft").alias("least_ft"), any_known(F.col("full_name")).alias("such_as"))),
        ("curb kinds by offset", offsets.orderBy("kind")),
    ]


def export(t: dict[str, DataFrame], boundary: DataFrame, folder: str) -> None:
    """Map layers in degrees, ordered CSV, the totals and the report."""
    lon_lat = lambda df: df.withColumn("g", project(F.col("g"), inverse=True))
    many, one = F.lit("MultiLineString"), F.lit("LineString")
    put = lambda df, name, kind, order: geojson.write_collection(
        lon_lat(df), f"{folder}/maps/{name}", kind, "g", [c for c in df.columns if c not in ("g", *{"seg", "start_ft", "_o"})], order, 5
    )
    put(site_lines(t), "blocks", many, ["block_id", "seg", "src"])
    put(narrowing_lines(t), "narrowings", one, ["seg", "start_ft"])
    put(block_features(t).withColumn("_o", -F.col("shoulder_ft")), "convertible_blocks", many, ["_o", "block_id"])
    put(street_features(t).withColumn("_o", -F.col("shoulder_each_side_ft_worst")), "convertible_streets", many, ["_o", "street"])
    put(boundary.select(F.lit(1).alias("boundary"), simplify(F.col("g"), 50.0).alias("g")), "boundary", F.lit("Polygon"), ["boundary"])
    for name, order in (("segment", ["seg"]), ("street", ["full_name"]), ("narrow_block", ["block_id"]), ("convertible", ["block_id"])):
        rows = t[name].drop("g")
        files.write_csv(rows, f"{folder}/csv/{name}", order)
    files.write_object(t["totals"], f"{folder}/totals")
    text = report.render(reports(t))
    boundary.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/report")


def run(spark: SparkSession, paths: dict[str, str | list[str]], folder: str) -> dict[str, DataFrame]:
    """Reads the layers, one path or glob each, measures them and writes all outputs below the folder."""
    layer = {name: layers.read(spark, name, path) for name, path in paths.items()}
    for name in ("streets", "lots", "curbs", "boundary"):
        geojson.require_rows(layer[name], name)
    t = measure(spark, layer, folder)
    export(t, layer["boundary"], folder)
    return t
