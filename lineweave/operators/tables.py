"""Tables that end a lineage, in the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: dict[str, SparkSession] = {}
SMALL = 100_000  #: rows of a narrow table that is still broadcast


def beside(df: DataFrame) -> DataFrame:
    """A table of few short columns for the side of a join: broadcast if it is counted to be small. Lineage should end at it."""
    return F.broadcast(df) if df.count() <= SMALL else df


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` of costly values: made once for a row, and not again in each expression further on that names them."""
    made = F.explode(F.array(F.struct(*(v.alias(k) for k, v in columns.items())))).alias("_once")
    return df.select("*", made).select(*(c for c in df.columns if c not in columns), *(F.col(f"_once.{k}").alias(k) for k in columns))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``; a temporary one only in local mode, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lineweave-", dir="/tmp"))
    return sc.getCheckpointDir()


def written(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """The same rows from a Parquet table, and its path; it goes when the application ends, or by ``remove`` before.

    For loops rather than a checkpoint: a checkpoint keeps the estimated size of the plan it replaces, and a join's
    estimate is the product of its sides', so the estimates of a loop of joins would grow without bound.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _written:
        atexit.register(lambda: [remove(p) for p in list(_written)])
    _written[path] = spark
    return spark.read.parquet(path), path


def remove(path: str) -> None:
    spark = _written.pop(path, None)
    if spark is not None and spark.sparkContext._jsc is not None:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
