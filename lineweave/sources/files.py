"""Plain sinks, and fingerprints of inputs."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def store(path: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(path) if ":/" in path else (FileSystem.from_uri("file://" + os.path.abspath(path))[0], os.path.abspath(path))


def put_together(spark: SparkSession, parts: str, path: str, name: str) -> None:
    """The files of the folder ``parts`` one after another, in the order of their names, as the one file of the folder ``path``.

    One task copies a megabyte at a time and renames what is whole; the parts are gone then.
    """

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (from_, below), (to, folder) = store(parts), store(path)
            hidden = f"{folder}/_{uuid.uuid4().hex}"
            with to.open_output_stream(hidden) as out:
                for f in sorted(from_.get_file_info(FileSelector(below)), key=lambda f: f.base_name):
                    if f.type == FileType.File and not f.base_name.startswith(("_", ".")):
                        with from_.open_input_stream(f.path) as one:
                            shutil.copyfileobj(one, out, 1 << 20)
            to.move(hidden, f"{folder}/{name}")
            yield batch

    system, folder = store(path)
    system.create_dir(folder, recursive=True)
    system.delete_dir_contents(folder)
    spark.range(0, 1, 1, 1).mapInArrow(copy, "id long").collect()
    system, below = store(parts)
    system.delete_dir(below)


def write_csv(df: DataFrame, path: str, order: list | None = None) -> None:
    """CSV with a header; in one ordered file if an order is given."""
    out = df.coalesce(1).sortWithinPartitions(*order) if order else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_object(df: DataFrame, path: str) -> None:
    """The one row as a JSON object that keeps its null keys."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def fingerprints(spark: SparkSession, path: str, place: int = -1) -> DataFrame:
    """(name, size, sha256) of every file below a path; ``place`` says which part of its path names it, the last if not given."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), place).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def fingerprint_diff(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(name, state): files that are missing, extra or changed; none if all are as expected."""
    both = found.select("name", F.struct("size", "sha256").alias("f")).join(expected.select("name", F.struct("size", "sha256").alias("e")), "name", "full")
    state = F.when(F.col("f").isNull(), "missing").when(F.col("e").isNull(), "extra").when(F.col("f") != F.col("e"), "changed")
    return both.select("name", state.alias("state")).where("state is not null")
