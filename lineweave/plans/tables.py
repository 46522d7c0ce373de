"""Queries of the city's tables, over streets and blocks made from orders and customers by arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.functions.semantics import rnd
from lineweave.plans import city
from lineweave.plans.registry import query, table


def unless(p: Column, x: Column) -> Column:
    return F.when(~p, x)


def pick(of: list[str], k: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in of)), (k % len(of) + 1).cast("int"))


@query(
    """with s as (select 'street ' || o_custkey % 97 as full_name, o_totalprice / 1000 as len, if(o_orderkey % 4 = 0, null, 40.0::double + o_custkey % 30) as w, if(o_custkey % 3 = 0, null, 20.0::double + o_custkey % 37) as r,
        o_orderkey % 3 < 2 as sure, if(o_orderkey % 5 = 0, null, 30.0::double + o_orderkey % 4) as m, if(o_orderkey % 7 = 0, null, o_orderstatus) as c, o_orderpriority as p from orders where o_custkey % 97 > 0),
    l as (select full_name, list({'len': len, 'w': w, 'r': r}) as x, list(m) filter (where m is not null) as ms, list(c) filter (where c is not null) as cs, list(p) as ps, len(list(1) filter (where sure)) as sure from s group by 1)
    select full_name, len(x) as n_segments, round(list_sum([i.len::decimal(18,4) for i in x])::double, 1) as len_ft,
        round(list_sum([i.len * i.w for i in x if i.w is not null]) / list_sum([i.len for i in x if i.w is not null]), 1) as row_width_ft, list_min([i.w - 2 for i in x]) as row_width_min_ft, list_max([i.w + 3 for i in x]) as row_width_max_ft,
        round(list_sum([i.len * i.r for i in x if i.r is not null]) / list_sum([i.len for i in x if i.r is not null]), 1) as road_ft, ifnull(sure, 0) as n_confident,
        list_min([v for v in ms if len([u for u in ms if u = v]) = list_max([len([u for u in ms if u = t]) for t in list_distinct(ms)])]) as row_width_mode_ft,
        list_min([v for v in list_distinct(cs) if len([u for u in cs if u = v]) = list_max([len([u for u in cs if u = t]) for t in list_distinct(cs)])]) as functional_class,
        list_min([v for v in list_distinct(ps) if len([u for u in ps if u = v]) = list_max([len([u for u in ps if u = t]) for t in list_distinct(ps)])]) as maint_resp from l"""
)
def street_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per named street: lengths, weighted widths, most frequent attributes."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    w = unless(k % 4 == 0, 40.0 + c % 30)
    segments = table(spark, sf_dir, "orders").select(
        F.when(c % 97 > 0, F.concat(F.lit("street "), c % 97)).otherwise(" ").alias("full_name"), (F.col("o_totalprice") / 1000).alias("len_ft"), w.alias("row_width_ft"), (w - 2).alias("row_width_min_ft"),
        (w + 3).alias("row_width_max_ft"), unless(c % 3 == 0, 20.0 + c % 37).alias("road_ft"), pick(["high", "medium", "low"], k).alias("confidence"), unless(k % 5 == 0, 30.0 + k % 4).alias("row_width_mode_ft"),
        unless(k % 7 == 0, F.col("o_orderstatus")).alias("functional_class"), F.col("o_orderpriority").alias("maint_resp"),
    )
    return city.street_summary(segments)


PROFILE = """p as (select c_custkey as block_id, c_custkey % 4 > 0 as testable, 14.0::double + c_custkey % 9 as most, 10.0::double + c_custkey % 7 as least, if(c_custkey % 5 = 0, null, 9.0::double + c_custkey % 11) as outer_least,
    20 + c_custkey % 30 as n, c_custkey % 13 as narrow, ['street curb', 'mixed', 'none'][1 + c_custkey % 3] as edge, 300.0::double + c_custkey % 77 as len from customer)"""


def block_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("block_id"), (k % 4 > 0).alias("testable"), (14.0 + k % 9).alias("curb_max_ft"), (10.0 + k % 7).alias("curb_min_ft"), unless(k % 5 == 0, 9.0 + k % 11).alias("curb_min_outer_ft"),
        (20 + k % 30).alias("n_measured"), (k % 13).alias("n_narrow"), pick(["street curb", "mixed", "none"], k).alias("edge_quality"), (300.0 + k % 77).alias("len_ft"),
    )


@query(
    f"""with {PROFILE} select block_id, round(most / 2 - 9, 1) as each_side_ft, round(most - 18, 1) as one_side_ft, narrow * 5.0::double as already_ft, (n - narrow) * 5.0::double as needs_line_ft,
    round(len - n * 5, 1) as unmeasured_ft, most <= 18 as width_test, most <= 18 and edge = 'street curb' as confident from p where testable"""
)
def edge_line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an edge line would take on each block that was measured well enough."""
    found = city.edge_lines(block_profiles(spark, sf_dir))
    return found.select("block_id", "each_side_ft", "one_side_ft", "already_ft", "needs_line_ft", "unmeasured_ft", "width_test", "confident")


@query(
    f"""with {PROFILE}, b as (select *, block_id % 6 < 3 as recorded, block_id % 10 = 0 or block_id % 3 = 1 as unknown_road, block_id % 2 = 1 as local_, block_id % 11 > 2 as strict_, block_id % 7 > 1 as lived_, 8.0::double + block_id % 12 as pmin, 12.0::double + block_id % 10 as pmax from p),
    r as (select block_id, len, 'pms' as src, if(testable, least(pmin, outer_least), pmin) as wn, pmax as wx, if(testable and ifnull(outer_least < pmin, false), 'curb', 'pms') as nsrc, round(greatest(pmax - 18, 0) / 2, 1) as sh, strict_ as nrr from b where recorded
        union all select block_id, len, 'curb', ifnull(outer_least, least), most, 'curb', round((most - 18) / 2, 1), most <= 18 from b where unknown_road and local_ and testable and lived_)
    select block_id, if(block_id % 8 = 0, '(unnamed)', 'block ' || block_id) as full_name, round(len) as len_ft, block_id % 4 + 1 as n_segments, src, wn, wx, nsrc, sh, nrr from r"""
)
def site_block_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map's blocks, by pavement records and by curbs where records are missing."""
    profile, k = block_profiles(spark, sf_dir), F.col("block_id")
    pmin, pmax = 8.0 + k % 12, 12.0 + k % 10
    candidates = profile.where(k % 6 < 3).select("block_id", pmin.alias("pave_min_ft"), pmax.alias("pave_max_ft"), rnd(F.greatest(pmax - 18, F.lit(0.0)) / 2, 1).alias("each_side_ft"))
    strict, lived = k % 11 > 2, k % 7 > 1
    narrow = profile.select("block_id", strict.alias("cond_width"), F.lit(True).alias("cond_two_way"), (strict | lived).alias("cond_residence"), lived.alias("any_two_way"))
    unknown = F.when((k % 10 == 0) | (k % 3 == 1), 2).otherwise(0)
    block = profile.select(
        "block_id", unless(k % 8 == 0, F.concat(F.lit("block "), k)).alias("full_name"), "len_ft", (k % 4 + 1).alias("n_segments"), unknown.alias("n_missing_road"), F.when(k % 2 == 1, city.LOCAL).otherwise("AR").alias("functional_class"),
    )
    return city.site_blocks(candidates, narrow, block, profile)
