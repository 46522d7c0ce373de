"""Dense numbers over a whole order, and cuts of an order into blocks, without a window over all rows.

Rows are range-partitioned and sorted, a row's place in its partition is taken as it is written, and the counts of the
partitions, a few numbers for each, give what lies before. Ties are dealt out by the place of the row in its input, so a
key that a third of the rows share fills several partitions and not one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineweave.operators import tables

_PLACE, _TIE = "_numbered_at", "_numbered_tie"
_BITS = 33  #: of a place in its partition, in what monotonically_increasing_id gives


def numbered(df: DataFrame, order: Sequence[Column | str], name: str) -> tuple[DataFrame, list[str]]:
    """Adds the number of each row, from 0, in the order; also gives the paths of the tables behind it.

    ``df`` is read twice (once for the bounds of the ranges), so what is dear to compute should be written before. Equal
    rows get their numbers in any order.
    """
    tied = df.withColumn(_TIE, F.xxhash64(F.monotonically_increasing_id()))
    placed = tied.repartitionByRange(*order, F.col(_TIE)).sortWithinPartitions(*order, F.col(_TIE)).drop(_TIE)
    rows, path = tables.written(placed.withColumn(_PLACE, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(_PLACE, _BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition: their number is that of tasks, not of rows.
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    at = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    found = at.withColumn(name, F.col("_before") + F.col(_PLACE).bitwiseAND(F.lit((1 << _BITS) - 1)))
    return found.drop("_part", "_before", _PLACE), [path]


def numbered_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], name: str) -> tuple[DataFrame, list[str]]:
    """Adds the number of each row, from 0, inside its group (null is a group). A group may fill any number of partitions."""
    keys = [F.col(g).asc_nulls_first() for g in groups]
    rows, paths = numbered(df, [*keys, *order], name)
    firsts, path = tables.written(rows.groupBy(*groups).agg(F.min(name).alias("_first")), "firsts")
    firsts = tables.beside(firsts.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)), "_first"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    found = rows.join(firsts, same).withColumn(name, F.col(name) - F.col("_first"))
    return found.select(*df.columns, name), [*paths, path]
