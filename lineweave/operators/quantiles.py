"""Exact quantiles, whatever the size of a group.

Small groups are sorted in one aggregation. Of a large group only counts are shuffled: its range of values is cut into
cells, cells are counted (partial sums first), and the cell that holds the wanted rank is cut again, until all its values
are equal or few enough to be sorted. So no task holds a large group, and a group with most of the rows costs what its
rows cost to read, two or three times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineweave.operators import tables

CELLS, SMALL = 4096, 100_000  #: of a range, and values that are sorted together


def _same(a: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"{prefix}{k}")) for k, c in enumerate(a)]


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{k}" for k, c in enumerate(keys)})


def _between(low: Column, high: Column, share: Column) -> Column:
    """Linear interpolation that gives ``low`` itself where nothing is to be added."""
    return F.when(low == high, low).otherwise(low + (high - low) * share)


def _order_stats(rows: DataFrame, keys: list[str], wanted: DataFrame, small: int, cells: int) -> DataFrame:
    """(keys, rank, v): the values of these ranks, from 0; ``wanted`` has (keys, rank, low, high, before, n) of each, n > small."""
    done = None
    while True:
        # Ranks of a group that lie in one range share it: rows meet each range once.
        ranges = wanted.select(*keys, "low", "high", "before", "n").distinct()
        spans = tables.beside(_renamed(ranges, keys, "_k"))
        inside = rows.join(spans, [*_same(keys, "_k"), F.col("v") >= F.col("low"), F.col("v") <= F.col("high")])
        width = F.col("high") / cells - F.col("low") / cells  # of halves, so that no difference overflows
        cell = F.least(F.floor((F.col("v") / cells - F.col("low") / cells) / width * cells), F.lit(cells - 1)).cast("int")
        counted = inside.groupBy(*keys, "low", "high", "before", F.when(width > 0, cell).otherwise(0).alias("cell"))
        counted = counted.agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("least"), F.max("v").alias("most"))
        upto = Window.partitionBy(*keys, "low", "high").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = counted.withColumn("end", F.col("before") + F.sum("m").over(upto)).withColumn("begin", F.col("end") - F.col("m"))
        parts = _renamed(counted.select(*keys, F.col("low").alias("_low"), F.col("high").alias("_high"), "least", "most", "begin", "m"), keys, "_k")
        at = [*_same(keys, "_k"), F.col("low") == F.col("_low"), F.col("high") == F.col("_high"), F.col("rank") >= F.col("begin"), F.col("rank") < F.col("begin") + F.col("m")]
        found = wanted.select(*keys, "rank", "low", "high").join(parts, at).select(*keys, "rank", F.col("least").alias("low"), F.col("most").alias("high"), F.col("begin").alias("before"), F.col("m").alias("n"))
        found, _ = tables.written(found, "ranges")
        known = found.where("low = high").select(*keys, "rank", F.col("low").alias("v"))
        done = known if done is None else done.unionByName(known)
        few = found.where("low < high and n <= %d" % small)
        wanted = found.where("low < high and n > %d" % small)
        spans = _renamed(few.select(*keys, "low", "high", "before").distinct(), keys, "_k")
        sorted_ = rows.join(tables.beside(spans), [*_same(keys, "_k"), F.col("v") >= F.col("low"), F.col("v") <= F.col("high")])
        sorted_ = sorted_.groupBy(*keys, "low", "high").agg(F.array_sort(F.collect_list("v")).alias("values"))
        sorted_ = _renamed(sorted_.withColumnsRenamed({"low": "_low", "high": "_high"}), keys, "_k")
        picked = few.join(sorted_, [*_same(keys, "_k"), F.col("low") == F.col("_low"), F.col("high") == F.col("_high")])
        done = done.unionByName(picked.select(*keys, "rank", F.get("values", (F.col("rank") - F.col("before")).cast("int")).alias("v")))
        if wanted.isEmpty():
            return done


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], small: int = SMALL, cells: int = CELLS) -> DataFrame:
    """(keys, n, a column for each name in ``probabilities``): quantiles between neighbouring values, of each group.

    Null and NaN are not counted; a group without values has nulls; null is a group. ``df`` is read a few times if it has
    groups of more than ``small`` values.
    """
    if not keys:
        return quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probabilities, small, cells).drop("_all")
    keys = list(keys)
    v = F.col(value).cast("double")
    rows = df.select(*keys, F.when(~F.isnan(v), v).alias("v"))
    sizes, _ = tables.written(rows.groupBy(*keys).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")), "sizes")
    large = sizes.where(F.col("n") > small)
    names = list(probabilities)
    if large.isEmpty():
        of = {name: F.percentile("v", p).alias(name) for name, p in probabilities.items()}
        return rows.groupBy(*keys).agg(F.count("v").alias("n"), *of.values())
    spans = tables.beside(_renamed(large.select(*keys), keys, "_k"))
    rest = rows.join(spans, _same(keys, "_k"), "left_anti")
    rest = rest.groupBy(*keys).agg(F.count("v").alias("n"), *(F.percentile("v", p).alias(name) for name, p in probabilities.items()))
    place = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probabilities.items()}
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(x), F.ceil(x)) for x in place.values()))))
    wanted = large.withColumn("rank", F.explode(ranks)).select(*keys, "rank", "low", "high", F.lit(0).cast("long").alias("before"), "n")
    stats = _order_stats(rows.where("v is not null"), keys, wanted, small, cells)
    found = stats.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("_v"))
    both = large.select(*keys, "n").join(_renamed(found, keys, "_k"), _same(keys, "_k"))
    at = lambda x: F.element_at("_v", x)
    both = both.select(*keys, "n", *(_between(at(F.floor(x)), at(F.ceil(x)), x - F.floor(x)).alias(name) for name, x in place.items()))
    return both.unionByName(rest.select(*keys, "n", *names))
