"""Tables that are made again only when something that they are made from has changed.

A stage has a name, a version of its rules, tables that it reads, and a function that gives its rows. Its key is a digest of
the name, the version and the contents of what it reads; its table lies in a folder named by that key. So a table is never
overwritten while another reader may hold it, a run that broke goes on behind the last stage that it finished, and a
stage whose inputs were made again with the same rows is left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def content(df: DataFrame) -> str:
    """A digest of the rows in any order, and of the names and types of the columns; one aggregation."""
    digest = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)) if df.columns else F.lit(0)
    n, total, mixed = df.select(digest.alias("h")).agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("h"))).first()
    return hashlib.sha256(f"{df.schema.simpleString()}|{n}|{total}|{mixed}".encode()).hexdigest()


@dataclass
class Table:
    df: DataFrame
    content: str


@dataclass
class Stages:
    """Tables below a folder that all executors share; ``made`` names those made in this run, ``kept`` those found."""

    spark: SparkSession
    folder: str
    made: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)

    def source(self, df: DataFrame) -> Table:
        return Table(df, content(df))

    def table(self, name: str, make: Callable[..., DataFrame], *inputs: Table, version: str = "1") -> Table:
        """The rows of ``make`` of the inputs' rows, as a table."""
        key = hashlib.sha256("|".join((name, version, *(t.content for t in inputs))).encode()).hexdigest()[:32]
        path, said = f"{self.folder}/{name}/{key}", f"{self.folder}/{name}/{key}.content"
        try:
            found = self.spark.read.schema("content string").json(said).first()
        except AnalysisException:
            found = None
        if found is None:  # what a broken run left of it is written over, as no manifest tells of it
            make(*(t.df for t in inputs)).write.mode("overwrite").parquet(path)
            rows = self.spark.read.parquet(path)
            found = [content(rows)]
            self.spark.createDataFrame([(found[0],)], "content string").coalesce(1).write.mode("overwrite").json(said)
            self.made.append(name)
            return Table(rows, found[0])
        self.kept.append(name)
        return Table(self.spark.read.parquet(path), found[0])
