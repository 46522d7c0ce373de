"""Queries of the sources, sinks and layer operators: tables go out to files of each kind and come back.

Streets are the lines of ``street_grid``, line items the lots, dots and curbs beside them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.functions import geometry as G
from lineweave.functions.semantics import rnd
from lineweave.operators.tables import shared_dir
from lineweave.plans import city
from lineweave.plans.registry import query, table
from lineweave.plans.streets import SIDE, street_grid
from lineweave.sources import files, geojson
from lineweave.sources.split import read_split


def place(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


STREET = "o_orderkey as seg, (o_orderkey % 100) * 1000 + 100.0::double as x1, floor(o_orderkey / 100) * 1000 + 500.0::double as y1"
PROPERTIES = T.StructType([T.StructField("seg", T.LongType()), T.StructField("road_ft", T.DoubleType())])


def line_ends(rows: DataFrame) -> DataFrame:
    p = lambda k: F.get(F.get("g", F.lit(0)), F.lit(k))
    return rows.select("kind", "seg", "road_ft", p(0)["x"].alias("x1"), p(0)["y"].alias("y1"), p(1)["x"].alias("x2"), p(1)["y"].alias("y2"))


ENDS = f"""select 'LineString' as kind, seg, case when o_custkey % 3 > 0 then 20.0::double + o_custkey % 37 end as road_ft, x1, y1, x1 + o_totalprice / 1000 as x2, y1 + (o_custkey % 21 - 10.0::double) as y2
from (select *, {STREET} from orders)"""


@query(ENDS)
def geojson_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets written as features on lines, nulls kept, and read back."""
    path = place(spark, "lines")
    geojson.write_lines(street_grid(spark, sf_dir, True), path, F.lit("LineString"), "g", ["seg", "road_ft"])
    return line_ends(geojson.read_lines(spark, path, PROPERTIES))


@query(ENDS)
def geojson_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets written as one collection in order and read back."""
    path = place(spark, "collection")
    geojson.write_collection(street_grid(spark, sf_dir, True), path, F.lit("LineString"), "g", ["seg", "road_ft"], ["seg"])
    return line_ends(read_split(spark, path, PROPERTIES))


@query("select n_name, n_regionkey, case when n_nationkey % 5 > 0 then n_nationkey / 8 end as part, row_number() over (order by n_regionkey, n_name desc) as line from nation")
def csv_ordered_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations in one ordered file with a header, read back with the number of each line."""
    path = place(spark, "csv")
    part = F.when(F.col("n_nationkey") % 5 > 0, F.col("n_nationkey") / 8)
    files.write_csv(table(spark, sf_dir, "nation").select("n_name", "n_regionkey", part.alias("part")), path, [F.asc("n_regionkey"), F.desc("n_name")])
    back = spark.read.schema("n_name string, n_regionkey long, part double").option("header", True).csv(path)
    return back.withColumn("line", F.monotonically_increasing_id() + 1)  # of one file in one task


@query(
    """with f as (select 'r=' || n_regionkey as name, n_regionkey as k, string_agg(n_name || chr(10), '' order by n_name) as t from nation group by 1, 2)
    select name, strlen(t)::bigint as size, sha256(t) as sha256 from f"""
)
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and digest of each of the files that the nations of a region are written to."""
    path = place(spark, "prints")
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("r"), "n_name").repartition(1, "r").sortWithinPartitions("r", "n_name")
    rows.write.partitionBy("r").text(path)
    return files.fingerprints(spark, path, -2).where("name like 'r=%'")


@query(
    """select 'r=' || n_regionkey as name, case n_regionkey when 0 then 'extra' else 'changed' end as state from nation where n_regionkey < 2 group by 1, 2
    union all select 'r=x', 'missing'"""
)
def fingerprint_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What differs from a list of fingerprints that has one file less, one changed and one more."""
    found = fingerprints(spark, sf_dir)
    wrong = F.when(F.col("name") == "r=1", F.lit("0")).otherwise(F.col("sha256"))
    more = spark.createDataFrame([("r=x", 1, "0")], "name string, size long, sha256 string")
    return files.fingerprint_diff(found, found.where("name <> 'r=0'").withColumn("sha256", wrong).unionByName(more))


@query(
    f"""with s as (select *, {STREET} from orders), m as (select seg, x1 + o_totalprice / 2000 as x, y1 as y, o_totalprice / 1000 as len from s)
    select seg, round(len, 6) as len_ft from m where x > 20010.5 and x < 70010.5 and y > 3000.5 and y < 30000.5"""
)
def boundary_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streets whose middle is inside the one boundary."""
    ring = F.array(G.box_ring(F.lit(20010.5), F.lit(3000.5), F.lit(70010.5), F.lit(30000.5)))
    inside = city.city_segments(street_grid(spark, sf_dir, False), spark.range(1).select(ring.alias("g")))
    return inside.select("seg", rnd(F.col("len_ft"), 6).alias("len_ft"))


DOT = "l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_orderkey % 100) * 1000 + l_partkey % 700 as px, floor(l_orderkey / 100) * 1000 + 460.0::double + l_suppkey % 80 as py"
# Streets lie apart by more than any reach here, so only the street of a line item's order can be near it.
REACHED = f"""s as (select *, {STREET}, o_totalprice / 1000 as len from orders), t as (select *, {DOT} from lineitem),
d as (select seg, l_orderkey, l_linenumber, l_partkey, l_suppkey, sqrt(greatest(x1 - px, px - x1 - len, 0) ** 2 + (py - y1) ** 2) as d from t join s on seg = l_orderkey)"""


def _dots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_orderkey")
    p = G.point((k % 100) * SIDE + F.col("l_partkey") % 700, F.floor(k / 100) * SIDE + 460.0 + F.col("l_suppkey") % 80)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", p.alias("p"))


@query(f"with {REACHED} select l_orderkey, l_linenumber, seg, round(min(d), 6) as d from d where d <= 30 group by 1, 2, 3")
def nearest_line_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each dot the nearest street within 30 ft."""
    dots = _dots(spark, sf_dir).groupBy("l_orderkey", "l_linenumber", "p").agg(F.struct("l_orderkey", "l_linenumber").alias("dot"))
    found = city.nearest_line(dots, street_grid(spark, sf_dir, False), "dot", "seg", 30.0)
    return found.select("dot.l_orderkey", "dot.l_linenumber", "seg", rnd(F.col("d"), 6).alias("d"))


@query(
    f"""with {REACHED} select l_orderkey, l_linenumber, l_partkey, l_suppkey, [3110, 3110, 3110, 3120, 3130, 3140, 3150][l_linenumber] as kind, round(min(d), 6) as offset_ft
    from d where d <= 200 group by all"""
)
def curb_type_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every curb's middle is from the nearest street, by the curb's kind: of all curbs, not of a sample."""
    kinds = F.element_at(F.array(*(F.lit(n) for n in (3110, 3110, 3110, 3120, 3130, 3140, 3150))), F.col("l_linenumber"))
    stub = G.line(G.point(F.col("p.x") - 4.0, F.col("p.y")), G.point(F.col("p.x") + 4.0, F.col("p.y")))
    curb = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("curb")
    curbs = _dots(spark, sf_dir).select(curb, kinds.alias("kind"), stub.alias("g")).dropDuplicates(["curb"])
    found = city.curb_offsets(curbs, street_grid(spark, sf_dir, False))
    return found.select("curb.*", "kind", rnd(F.col("offset_ft"), 6).alias("offset_ft"))


@query(
    f"""with s as (select *, {STREET}, o_totalprice / 1000 as len from orders),
    z as (select l_orderkey, (l_orderkey % 100) * 1000 + l_partkey % 600 as x, floor(l_orderkey / 100) * 1000 + 530.0::double + l_suppkey % 70 as y from lineitem where l_partkey % 3 = 0),
    n as (select distinct seg from s join z on seg = l_orderkey where sqrt(greatest(x1 - x - 50, x - x1 - len, 0) ** 2 + (y - y1) ** 2) <= 60)
    select o_custkey, bool_or(n.seg is not null) as any_residential, bool_and(n.seg is not null) as all_residential, count(*) as n_segments
    from s left join n using (seg) group by 1"""
)
def residential_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether some or all of a block's streets have a residential zone within 60 ft."""
    k, streets = F.col("l_orderkey"), street_grid(spark, sf_dir, False)
    x, y = ((k % 100) * SIDE + F.col("l_partkey") % 600).cast("double"), F.floor(k / 100) * SIDE + 530.0 + F.col("l_suppkey") % 70
    zones = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 3 == 0).alias("is_residential"), F.array(G.box_ring(x, y, x + 50.0, y + 80.0)).alias("g"))
    flags = city.residential_segments(streets, zones).join(streets.select("seg", "o_custkey"), "seg")
    any_, all_ = F.bool_or("is_residential"), F.bool_and("is_residential")
    return flags.groupBy("o_custkey").agg(any_.alias("any_residential"), all_.alias("all_residential"), F.count(F.lit(1)).alias("n_segments"))
