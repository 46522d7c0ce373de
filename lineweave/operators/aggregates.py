"""Grouped operators: modes, dominant values, weighted means, interval edges, runs and profiles.

Each is one or two hash aggregations on the group's key, with partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineweave.functions.semantics import count_where, rnd, where


def mode_by_count(df: DataFrame, keys: list[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent known value of each group; the smaller of two as frequent."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_m")).select(*keys, F.col("_m.v").alias(out))


def dominant_by_weight(df: DataFrame, keys: list[str], value: str, weight: str, out: str = "dominant") -> DataFrame:
    """The value, null among them, with the largest summed weight of each group; ties to the smaller value, null last."""
    summed = df.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    pick = F.struct((-F.col("_w")).alias("w"), F.col(value).isNull().alias("none"), F.col(value).alias("v"))
    known = F.struct(F.col("_w").isNull().alias("u"), pick.alias("p"))
    return summed.groupBy(*keys).agg(F.min(known).alias("_m")).select(*keys, F.col("_m.p.v").alias(out))


def weighted_mean(x: Column, weight: Column) -> Column:
    """Sum of weighted values over the weights of known values; null without any."""
    return F.sum(weight * x) / F.nullif(F.sum(where(x.isNotNull(), weight)), F.lit(0.0))


def interval_edges(crossings: DataFrame, *key: str, low: str = "s_lo", high: str = "s_hi") -> DataFrame:
    """Nearest interval end on each side of zero, and how many intervals lie across it; null intervals count as none."""
    return crossings.groupBy(*key).agg(
        F.max(where(F.col(high) <= 0, F.col(high))).alias("left_edge"),
        F.min(where(F.col(low) >= 0, F.col(low))).alias("right_edge"),
        count_where((F.col(low) < 0) & (F.col(high) > 0)).alias("straddling"),
    )


def station_widths(stations: DataFrame, edges: DataFrame, key: str, half: float = 250.0, slack: float = 5.0) -> DataFrame:
    """``with_widths`` of every station, also of those without edges."""
    return with_widths(stations.join(edges, key, "left"), half, slack)


def with_widths(edges: DataFrame, half: float = 250.0, slack: float = 5.0) -> DataFrame:
    """Stations with their two distances, width, doubled width, status and whether an edge is at the reach's end."""
    joined = edges.withColumn("straddling", F.coalesce("straddling", F.lit(0)).cast("long"))
    free = F.col("straddling") == 0
    joined = joined.withColumns({"left_ft": F.when(free, F.abs("left_edge")), "right_ft": F.when(free, F.col("right_edge"))})
    left, right = F.col("left_ft"), F.col("right_ft")
    both = left.isNotNull() & right.isNotNull()
    status = (
        F.when(~free, "centerline_in_taxlot").when(left.isNull() & right.isNull(), "no_lots_either_side").when(left.isNull() | right.isNull(), "no_lot_one_side").otherwise("ok")
    )
    return joined.withColumns(
        {
            "width_ft": F.when(both, left + right),
            "width_any_ft": F.when(both, left + right).when(left.isNotNull(), 2 * left).when(right.isNotNull(), 2 * right),
            "status": status,
            "edge_at_cap": F.coalesce(left >= half - slack, F.lit(False)) | F.coalesce(right >= half - slack, F.lit(False)),
        }
    ).drop("left_edge", "right_edge")


def rollup_stations(widths: DataFrame, key: str) -> DataFrame:
    """One row per segment: medians, mode of whole feet, range, counts by status."""
    median = lambda c: rnd(F.median(c), 1)
    status = F.col("status")
    rolled = widths.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_transects"), F.count("width_ft").alias("n_measured"), F.count("width_any_ft").alias("n_any"),
        median("width_ft").alias("row_width_ft"), rnd(F.min("width_ft"), 1).alias("row_width_min_ft"), rnd(F.max("width_ft"), 1).alias("row_width_max_ft"),
        rnd(F.max("width_ft") - F.min("width_ft"), 1).alias("row_width_spread_ft"), median("width_any_ft").alias("row_width_any_ft"),
        median("left_ft").alias("row_left_ft"), median("right_ft").alias("row_right_ft"), rnd(F.median("right_ft") - F.median("left_ft"), 1).alias("row_offcenter_ft"),
        count_where(status == "centerline_in_taxlot").alias("n_in_taxlot"), count_where(status == "no_lots_either_side").alias("n_no_lots"),
        count_where(status == "no_lot_one_side").alias("n_one_side"), count_where(F.col("edge_at_cap")).alias("n_at_cap"),
    )
    modes = mode_by_count(widths.select(key, rnd(F.col("width_ft")).alias("w")), [key], "w", "row_width_mode_ft")
    return rolled.join(modes, key, "left")


def confidence(n_measured: Column, spread: Column, n_any: Column) -> Column:
    """Tier of a segment's width; unknown counts fail every test."""
    return (
        F.when((n_measured >= 5) & (spread <= 1.0), "high").when((n_measured >= 3) & (spread <= 5.0), "medium").when(n_measured >= 1, "low").when(n_any >= 1, "estimated").otherwise("none")
    )


def islands(df: DataFrame, key: str, order: list[str], flag: str) -> DataFrame:
    """Adds ``run``: rows of a key that follow each other with the same flag share it (with the flag)."""
    every = Window.partitionBy(key).orderBy(*order)
    same = Window.partitionBy(key, flag).orderBy(*order)
    return df.withColumn("run", (F.row_number().over(every) - F.row_number().over(same)).cast("long"))


def nearest_each_side(crossings: DataFrame, key: str | list[str], s: str, tie: str, band: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """The crossing nearest to zero on each side outside the band, by one aggregation; ties to the smaller ``tie``."""
    row = F.struct(F.abs(s).alias("d"), F.col(tie).alias("t"), F.col(s).alias("s"), *(F.col(c).alias(c) for c in carry))
    key = [key] if isinstance(key, str) else key
    picked = crossings.groupBy(*key).agg(F.min(where(F.col(s) > band, row)).alias("_r"), F.min(where(F.col(s) < -band, row)).alias("_l"))
    of = lambda side, name: [F.col(f"{side}.s").alias(f"{name}_ft"), F.col(f"{side}.t").alias(f"{name}_{tie}"), *(F.col(f"{side}.{c}").alias(f"{name}_{c}") for c in carry)]
    return picked.select(*key, *of("_r", "right"), *of("_l", "left"))


def funnel(df: DataFrame, conditions: list[tuple[str, Column]]) -> DataFrame:
    """Rows that meet the first condition, the first two, and so on, in one pass."""
    counts, sofar = [], F.lit(True)
    for k, (_, p) in enumerate(conditions):
        sofar = sofar & p
        counts.append(count_where(sofar).alias(f"_{k}"))
    one = df.agg(*counts)
    rows = F.array(*(F.struct(F.lit(k + 1).alias("step"), F.lit(name).alias("condition"), F.col(f"_{k}").alias("n")) for k, (name, _) in enumerate(conditions)))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def at_thresholds(df: DataFrame, x: str, thresholds: list[float], weight: str) -> DataFrame:
    """Count and summed weight of the rows at or below each of a fixed list of thresholds, in one pass over the rows."""
    sums = [a for k, t in enumerate(thresholds) for a in (count_where(F.col(x) <= t).alias(f"n{k}"), F.sum(where(F.col(x) <= t, F.col(weight).cast("decimal(18,4)"))).alias(f"w{k}"))]
    rows = F.array(*(F.struct(F.lit(float(t)).alias("threshold"), F.col(f"n{k}").alias("n"), F.col(f"w{k}").cast("double").alias("w")) for k, t in enumerate(thresholds)))
    return df.agg(*sums).select(F.explode(rows).alias("r")).select("r.*")
