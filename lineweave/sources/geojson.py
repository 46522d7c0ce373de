"""GeoJSON layers: typed scans of one file or a glob of pages, and sinks.

A scan never infers a schema: properties are read with the types given, coordinates as text that is parsed by geometry
type. A collection is one task for each file, as JSON over many lines can't be split, so its rows can be dealt out again
behind the scan; a feature per line is split like any text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.operators.numbering import numbered
from lineweave.operators.tables import shared_dir
from lineweave.sources.files import put_together

_POINT, _LINE, _PARTS, _MANY = "array<double>", "array<array<double>>", "array<array<array<double>>>", "array<array<array<array<double>>>>"


def decode(geometry: Column) -> Column:
    """Parts or rings of a geometry struct (type, coordinates as text); polygons of a multipolygon lie side by side."""
    kind, text = geometry["type"], geometry["coordinates"]
    line = lambda c: F.transform(c, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    parts = lambda c: F.transform(c, line)
    return (
        F.when(kind == "Point", parts(F.array(F.array(F.from_json(text, _POINT)))))
        .when(kind.isin("LineString", "MultiPoint"), parts(F.array(F.from_json(text, _LINE))))
        .when(kind.isin("MultiLineString", "Polygon"), parts(F.from_json(text, _PARTS)))
        .when(kind == "MultiPolygon", parts(F.flatten(F.from_json(text, _MANY))))
    )


def feature_type(properties: T.StructType) -> T.StructType:
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    return T.StructType([T.StructField("properties", properties), T.StructField("geometry", geometry)])


def decoded(features: DataFrame) -> DataFrame:
    return features.select(F.col("f.geometry.type").alias("kind"), decode(F.col("f.geometry")).alias("g"), "f.properties.*")


def read_layer(spark: SparkSession, path: str | list[str], properties: T.StructType, tasks: int | None = None) -> DataFrame:
    """Rows (kind, g, the properties) of a file, a glob or a list of them, dealt out to ``tasks``, or a task for each file.

    A file without ``features``, such as an error page, gives no row.
    """
    shape = T.StructType([T.StructField("features", T.ArrayType(feature_type(properties)))])
    rows = spark.read.schema(shape).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return decoded(rows.repartition(tasks) if tasks else rows)


def read_lines(spark: SparkSession, path: str | list[str], properties: T.StructType) -> DataFrame:
    """Rows (kind, g, the properties) of files with a feature on each line, as ``write_lines`` makes them."""
    rows = spark.read.schema(feature_type(properties)).json(path)
    return decoded(rows.select(F.struct("properties", "geometry").alias("f")))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The same rows; raises if there is none."""
    if df.isEmpty():
        raise ValueError(f"{what} has no features")
    return df


def encode(kind: Column, g: Column, places: int | None = None) -> Column:
    """The GeoJSON text of a geometry, its coordinates rounded to ``places``."""
    fixed = (lambda v: F.round(v * 10.0**places) / 10.0**places) if places is not None else (lambda v: v)
    parts = F.transform(g, lambda part: F.transform(part, lambda p: F.array(fixed(p["x"]), fixed(p["y"]))))
    first = F.get(parts, F.lit(0))
    shaped = (
        F.when(kind == "Point", F.to_json(F.get(first, F.lit(0)))).when(kind.isin("LineString", "MultiPoint"), F.to_json(first)).when(kind == "MultiPolygon", F.to_json(F.array(parts))).otherwise(F.to_json(parts))
    )
    return F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), shaped, F.lit("}"))


def feature(kind: Column, g: Column, properties: list[str], places: int | None = None) -> Column:
    """One feature as a line of text; unknown properties stay as null."""
    known = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"type":"Feature","properties":'), known, F.lit(',"geometry":'), F.coalesce(encode(kind, g, places), F.lit("null")), F.lit("}"))


def write_lines(df: DataFrame, path: str, kind: Column, g: str, properties: list[str], places: int | None = None) -> None:
    """A feature per line, in as many files as there are tasks."""
    df.select(feature(kind, F.col(g), properties, places).alias("value")).write.mode("overwrite").text(path)


def write_collection(df: DataFrame, path: str, kind: Column, g: str, properties: list[str], order: list[str], places: int | None = None, files: int | None = 1) -> None:
    """One FeatureCollection in order: one file, or several parts that are one when put one after another in the order of their names.

    Features are numbered, sorted and written by ranges. What is left to one task for a single file is to copy the ranges' parts
    into it, some bytes at a time. ``files=None`` leaves the number of parts to Spark.
    """
    by = [F.col(c).alias(f"_{k}") for k, c in enumerate(order)]
    rows, _ = numbered(df.select(*by, feature(kind, F.col(g), properties, places).alias("value")), [f"_{k}" for k in range(len(order))], "_line")
    # All features but the first have a comma before them; the first and last lines are rows of their own.
    rows = rows.select("_line", F.concat(F.when(F.col("_line") > 0, ",").otherwise(""), "value").alias("value"))
    ends = df.sparkSession.createDataFrame([(-1, '{"type":"FeatureCollection","features":['), ((1 << 62), "]}")], "_line long, value string")
    lines = rows.unionByName(ends)
    lines = lines.repartitionByRange(files, "_line") if files and files > 1 else lines.repartitionByRange("_line")
    parts = f"{shared_dir(df.sparkSession)}/parts-{uuid.uuid4().hex}" if files == 1 else path
    lines.sortWithinPartitions("_line").select("value").write.mode("overwrite").text(parts)
    if files == 1:
        put_together(df.sparkSession, parts, path, "part-00000.txt")
