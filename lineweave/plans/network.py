"""Queries of the graph operators: degrees, blocks of segments joined through degree-2 nodes, and their roll-up.

Orders are street segments: each leads from a node to the next or the one after; some have an unknown end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.functions.semantics import count_where, rnd
from lineweave.operators import aggregates as A
from lineweave.operators import graph as G
from lineweave.plans.registry import query, table

SEGMENTS = """s as (select o_orderkey as seg, o_orderkey as f_node, case when o_orderkey % 97 = 0 then null else o_orderkey + case when o_custkey % 5 = 0 then 2 else 1 end end as t_node,
    o_orderstatus <> 'P' as in_city, o_totalprice as len, case when o_custkey % 3 = 0 then null else o_orderpriority end as name from orders),
ends as (select seg, f_node as node from s where f_node is not null union all select seg, t_node from s where t_node is not null),
deg as (select node, count(*) as degree from ends group by 1)"""
BLOCKS = SEGMENTS + """,
adj as (select a.seg as x, b.seg as y from ends a join ends b using (node) join deg using (node) where degree = 2 and a.seg <> b.seg),
reach as (select seg, seg as other from s union select r.seg, a.y from reach r join adj a on r.other = a.x),
member as (select seg, min(other) as block_id from reach group by 1)"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    step = F.when(F.col("o_custkey") % 5 == 0, 2).otherwise(1)
    return o.select(
        F.col("o_orderkey").alias("seg"), F.col("o_orderkey").alias("f_node"), F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderkey") + step).alias("t_node"),
        (F.col("o_orderstatus") != "P").alias("in_city"), F.col("o_totalprice").alias("len"), F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderpriority")).alias("name"),
    )


@query(f"with {SEGMENTS} select node, degree from deg")
def node_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.degrees(segments(spark, sf_dir), "seg", "f_node", "t_node")


@query(f"with recursive {BLOCKS} select seg, block_id from member")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.blocks(segments(spark, sf_dir), "seg", "f_node", "t_node")


@query(
    f"""with recursive {BLOCKS},
    city as (select block_id, s.* from member join s using (seg)),
    per as (select block_id, name, sum(len) as w from city where in_city group by 1, 2),
    pick as (select block_id, name from (select *, row_number() over (partition by block_id order by w desc, name) as rn from per) where rn = 1)
    select c.block_id, count(*) as n_segments, count(*) filter (where in_city) as n_city, round((sum(len::decimal(18,4)) filter (where in_city))::double, 1) as len,
        max(len) filter (where in_city) as widest, min(len) filter (where in_city) as narrowest, count(*) filter (where in_city and c.name is null) as n_unnamed, any_value(p.name) as name
    from city c join pick p using (block_id) group by 1 having count(*) filter (where in_city) > 0"""
)
def component_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = segments(spark, sf_dir)
    members = s.join(G.blocks(s, "seg", "f_node", "t_node"), "seg")
    names = A.dominant_by_weight(members.where("in_city"), ["block_id"], "name", "len", "name")
    city = F.col("in_city")
    rolled = members.groupBy("block_id").agg(
        F.count(F.lit(1)).alias("n_segments"), count_where(city).alias("n_city"), rnd(F.sum(F.when(city, F.col("len").cast("decimal(18,4)"))).cast("double"), 1).alias("len"),
        F.max(F.when(city, F.col("len"))).alias("widest"), F.min(F.when(city, F.col("len"))).alias("narrowest"), count_where(city & F.col("name").isNull()).alias("n_unnamed"),
    )
    return rolled.where("n_city > 0").join(names, "block_id")


@query(
    f"""with {SEGMENTS} select seg, coalesce(a.degree, 1) <> 2 as from_end, coalesce(b.degree, 1) <> 2 as to_end
    from s left join deg a on a.node = f_node left join deg b on b.node = t_node"""
)
def end_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.end_classes(segments(spark, sf_dir), "seg", "f_node", "t_node")
