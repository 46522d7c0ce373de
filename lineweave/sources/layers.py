"""The input layers, by the names and types of their sources, in feet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.functions.projection import project
from lineweave.sources.geojson import read_layer

#: Source columns, types and the names used here.
LAYERS = {
    "streets": "OBJECTID int seg, LOCALID int localid, FULL_NAME string full_name, TYPE int type_code, DIRECTION int direction, F_NODE long f_node, T_NODE long t_node",
    "pms": "OBJECTID int pms_oid, LocationID string location_id, Streetname string street_name, RoadWidth int road_ft, PaveWidth int pave_ft, NumberOfLanes double lanes, Curb string curb, SurfaceType string surface_type, FunctionalClass string functional_class, PCI double pci, InspectionYear int inspection_year, Owner string owner, MaintResp string maint_resp",
    "unimproved": "OBJECTID int oid, LOCALID int localid, FULL_NAME string full_name, TYPE int type_code",
    "curbs": "OBJECTID int curb, CurbType int kind, CurbStyle string style, Owner string owner, MaintResp string maint_resp",
    "sidewalks": "OBJECTID int walk, SidewalkType string sidewalk_type, Owner string owner, MaintResp string maint_resp",
    "curb_extensions": "TSP_ID string ext, StreetName string street_name, RoadWidth double road_ft, Policy string policy",
    "zoning": "ZONE string zone, ZONE_DESC string zone_desc",
    "boundary": "CITYNAME string city_name",
    "lots": "TLID string tlid, COUNTY string county, JURIS_CITY string juris_city",
}
IN_FEET = {"lots"}


def read(spark: SparkSession, layer: str, path: str | list[str]) -> DataFrame:
    """A layer with its columns renamed and its geometry in feet, dealt out to all cores; a glob or list of pages is read like one file."""
    columns = [c.split() for c in LAYERS[layer].split(", ")]
    properties = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind, _ in columns))
    rows = read_layer(spark, path, properties, spark.sparkContext.defaultParallelism)
    rows = rows.select("kind", ("g" if layer in IN_FEET else project(F.col("g")).alias("g")), *(F.col(name).alias(new) for name, _, new in columns)) if layer != "curbs" else rows.select(
        F.col("kind").alias("shape"), project(F.col("g")).alias("g"), *(F.col(name).alias(new) for name, _, new in columns)
    )
    if layer == "pms":
        return rows.withColumn("localid", F.regexp_extract("location_id", r"(\d+)", 1).try_cast("int"))
    if layer == "zoning":
        return rows.withColumn("is_residential", F.col("zone").startswith("R"))
    if layer == "lots":
        return rows.withColumn("lot", F.struct(F.col("tlid"), F.xxhash64("g").alias("h")))
    return rows
