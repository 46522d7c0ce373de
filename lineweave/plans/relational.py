"""Queries of the relational operators, on the test tables.

Orders stand for stations or segments, line items for the intervals and sections along them, customers for streets,
events for the stations of a profile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineweave.functions.semantics import any_known, count_where, counting, known, least_by, miles, ratio, rnd, share_of_total, tier, where, whole
from lineweave.operators import aggregates as A
from lineweave.operators import joins as J
from lineweave.operators.overlaps import overlapped
from lineweave.plans.registry import query, table

# ---- interval edges and station widths (A20, P4, P5, P11, J2) ---------------------------------------------------

STATIONS = """spans as (
    select o_orderkey, o_custkey, list({'a': l_extendedprice % 500 - 250, 'b': l_extendedprice % 500 - 250 + l_quantity}) filter (where l_orderkey is not null) as s
    from orders left join lineitem on l_orderkey = o_orderkey group by all
), near as (
    select o_orderkey, o_custkey, ifnull(len([i for i in s if i.a < 0 and i.b > 0]), 0) as straddling,
        abs(list_max([i.b for i in s if i.b <= 0])) as before_ft, list_min([i.a for i in s if i.a >= 0]) as behind_ft
    from spans
), sides as (
    select o_orderkey, o_custkey, straddling, if(straddling > 0, null, before_ft) as left_ft, if(straddling > 0, null, behind_ft) as right_ft from near
), w as (
    select *, left_ft + right_ft as width_ft, ifnull(left_ft, right_ft) + ifnull(right_ft, left_ft) as width_any_ft,
        if(straddling > 0, 'centerline_in_taxlot', ['ok', 'no_lot_one_side', 'no_lots_either_side'][1 + (left_ft is null)::int + (right_ft is null)::int]) as status,
        greatest(ifnull(left_ft, 0), ifnull(right_ft, 0)) >= 245 as edge_at_cap
    from sides
)"""

ROLLED = f"""{STATIONS}, lists as (
    select o_custkey, list(status) as st, len(list(1) filter (where edge_at_cap)) as capped, list(width_ft) filter (where width_ft is not null) as ws,
        list(width_any_ft) filter (where width_any_ft is not null) as es, list(left_ft) filter (where left_ft is not null) as ls, list(right_ft) filter (where right_ft is not null) as rs
    from w group by o_custkey
), md as (
    select o_custkey, list_min([f for f in feet if len([g for g in feet if g = f]) = list_max([len([g for g in feet if g = h]) for h in feet])]) as row_width_mode_ft
    from (select o_custkey, [round(x) for x in ws] as feet from lists)
), r as (
    select o_custkey, len(st) as n_transects, ifnull(len(ws), 0) as n_measured, ifnull(len(es), 0) as n_any, round(list_median(ws), 1) as row_width_ft,
        round(list_min(ws), 1) as row_width_min_ft, round(list_max(ws), 1) as row_width_max_ft, round(list_max(ws) - list_min(ws), 1) as row_width_spread_ft,
        round(list_median(es), 1) as row_width_any_ft, round(list_median(ls), 1) as row_left_ft, round(list_median(rs), 1) as row_right_ft,
        round(list_median(rs) - list_median(ls), 1) as row_offcenter_ft, len([1 for s in st if s = 'centerline_in_taxlot']) as n_in_taxlot,
        len([1 for s in st if s = 'no_lots_either_side']) as n_no_lots, len([1 for s in st if s = 'no_lot_one_side']) as n_one_side, ifnull(capped, 0) as n_at_cap
    from lists
)"""


def station_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.col("l_extendedprice") % 500 - 250
    crossings = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), low.alias("s_lo"), (low + F.col("l_quantity")).alias("s_hi"))
    stations = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return A.station_widths(stations, A.interval_edges(crossings, "o_orderkey"), "o_orderkey")


@query(f"with {STATIONS} select o_orderkey, straddling, left_ft, right_ft, width_ft, width_any_ft, status, edge_at_cap from w")
def interval_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_widths(spark, sf_dir).drop("o_custkey")


@query(f"with {STATIONS} select status, count(*) as transects, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct from w group by 1")
def edge_status_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = station_widths(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("transects"))
    return counted.withColumn("pct", share_of_total(counted, "transects"))


@query(f"with {ROLLED} select r.*, row_width_mode_ft from r left join md using (o_custkey)")
def station_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rollup_stations(station_widths(spark, sf_dir), "o_custkey")


@query(
    f"""with {ROLLED}, t as (select *, case when n_measured >= 5 and row_width_spread_ft <= 1.0 then 'high' when n_measured >= 3 and row_width_spread_ft <= 5.0 then 'medium'
    when n_measured >= 1 then 'low' when n_any >= 1 then 'estimated' else 'none' end as confidence from r)
    select confidence, count(*) as segments, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct, round(median(row_width_ft), 1) as median_width from t group by 1"""
)
def confidence_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = A.rollup_stations(station_widths(spark, sf_dir), "o_custkey")
    rolled = rolled.withColumn("confidence", A.confidence(F.col("n_measured"), F.col("row_width_spread_ft"), F.col("n_any")))
    counted = rolled.groupBy("confidence").agg(F.count(F.lit(1)).alias("segments"), rnd(F.median("row_width_ft"), 1).alias("median_width"))
    return counted.withColumn("pct", share_of_total(counted, "segments"))


# ---- sampling along a segment (P15, J16) ------------------------------------------------------------------------


@query(
    """with s as (select o_orderkey, o_totalprice / 1000 as len, least(40.0::double, 0.35::double * (o_totalprice / 1000)) as inset from orders where o_totalprice / 1000 > 8),
    z as (select *, len - 2 * inset as usable, least(40, greatest(5, ((len - 2 * inset) / 25.0::double + 1)::bigint)) as n from s)
    select o_orderkey, n, i as sample_no, round((inset + usable * i / (n - 1)) / len, 9) as frac from z, unnest(range(0, n)) as u(i)"""
)
def adaptive_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("len")).where("len > 8")
    s = s.withColumn("inset", F.least(F.lit(40.0), F.lit(0.35) * F.col("len"))).withColumn("usable", F.col("len") - 2 * F.col("inset"))
    s = s.withColumn("n", F.least(F.lit(40), F.greatest(F.lit(5), whole(F.col("usable") / 25.0 + 1))).cast("long"))
    s = s.withColumn("sample_no", F.explode(counting(F.lit(0).cast("long"), F.col("n"))))
    return s.select("o_orderkey", "n", "sample_no", rnd((F.col("inset") + F.col("usable") * F.col("sample_no") / (F.col("n") - 1)) / F.col("len"), 9).alias("frac"))


# ---- modes, dominant values, means, sums (A5, A6, A10-A14, W3, W4) ----------------------------------------------


@query(
    """select l_orderkey, l_linenumber::bigint as mode from (
        select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by count(*) desc, l_linenumber) as rn from lineitem group by 1, 2) where rn = 1"""
)
def deterministic_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.mode_by_count(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")
    return found.select("l_orderkey", F.col("mode").cast("long").alias("mode"))


@query(
    """with p as (select l_orderkey, case when l_returnflag <> 'N' then l_returnflag end as v, sum(l_quantity) as len from lineitem group by 1, 2)
    select l_orderkey, v as dominant from (select *, row_number() over (partition by l_orderkey order by len desc, v) as rn from p) where rn = 1"""
)
def weighted_dominant(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("v"), "l_quantity")
    return A.dominant_by_weight(lines, ["l_orderkey"], "v", "l_quantity")


@query(
    """with p as (select l_suppkey, l_quantity as w, case when l_discount > 0.02 then l_discount end as x, l_returnflag, l_linestatus, l_tax from lineitem)
    select l_suppkey, count(*) as n_sections, round(sum(w * x) / nullif(sum(w) filter (where x is not null), 0), 6) as mean_x, min(x) as min_x, max(x) as max_x,
        bool_or(l_returnflag = 'R') as any_returned, bool_and(l_linestatus = 'F') as all_final, round(avg(l_tax), 6) as avg_tax from p group by 1"""
)
def length_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "lineitem").withColumn("x", F.when(F.col("l_discount") > 0.02, F.col("l_discount")))
    return p.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n_sections"), rnd(A.weighted_mean(F.col("x"), F.col("l_quantity")), 6).alias("mean_x"), F.min("x").alias("min_x"), F.max("x").alias("max_x"),
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"), F.bool_and(F.col("l_linestatus") == "F").alias("all_final"), rnd(F.avg("l_tax"), 6).alias("avg_tax"),
    )


@query("select o_custkey, round(sum(o_totalprice::decimal(18,4))::double / 5280.0::double, 3) as miles, count(distinct o_orderstatus) as n_states from orders group by 1")
def decimal_mileage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(miles(F.col("o_totalprice"), 3).alias("miles"), F.count_distinct("o_orderstatus").alias("n_states"))


@query(
    """with p as (select l_orderkey, l_partkey, case when l_tax > 0.01 then l_tax end as t from lineitem)
    select l_orderkey, min(t) as t, any_value(l_orderkey % 7) filter (where t is not null) as any_known, first(l_partkey order by t, l_partkey) filter (where t is not null) as part_at_least
    from p group by 1"""
)
def value_at_least(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "lineitem").withColumn("t", F.when(F.col("l_tax") > 0.01, F.col("l_tax")))
    return p.groupBy("l_orderkey").agg(
        F.min("t").alias("t"), any_known(F.when(F.col("t").isNotNull(), F.col("l_orderkey") % 7)).alias("any_known"), least_by(F.col("l_partkey"), F.col("t"), F.col("l_partkey")).alias("part_at_least")
    )


# ---- gates, funnels, thresholds, histograms, profiles (A17, A21-A25, J17) ---------------------------------------


@query(
    """with p as (select l_orderkey, case when l_quantity > 2 then l_quantity end as w from lineitem)
    select l_orderkey, count(*) as n, count(*) filter (where w is null) as n_missing, max(w) as w_max from p group by 1 having count(*) filter (where w is null) = 0 and max(w) <= 30"""
)
def completeness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "lineitem").withColumn("w", F.when(F.col("l_quantity") > 2, F.col("l_quantity")))
    gated = p.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), count_where(F.col("w").isNull()).alias("n_missing"), F.max("w").alias("w_max"))
    return gated.where("n_missing = 0 and w_max <= 30")


@query(
    """with p as (select l_orderkey, case when l_discount > 0.01 then l_quantity end as w, l_returnflag = 'A' as outer_ from lineitem),
    g as (select l_orderkey, count(*) as n, count(w) as n_measured, count(w) filter (where outer_) as n_outer from p group by 1)
    select *, round(n_measured / nullif(n, 0), 3) as coverage, n_measured >= 0.8::double * n as testable,
        case when n_measured = 0 then 'none' when n_outer = n_measured then 'street curb' when n_outer > 0 then 'mixed' else 'no street curb' end as edge_quality from g"""
)
def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "lineitem").withColumns({"w": F.when(F.col("l_discount") > 0.01, F.col("l_quantity")), "outer": F.col("l_returnflag") == "A"})
    g = p.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count("w").alias("n_measured"), F.count(where(F.col("outer"), F.col("w"))).alias("n_outer"))
    quality = F.when(F.col("n_measured") == 0, "none").when(F.col("n_outer") == F.col("n_measured"), "street curb").when(F.col("n_outer") > 0, "mixed").otherwise("no street curb")
    return g.withColumns({"coverage": rnd(ratio(F.col("n_measured"), F.col("n")), 3), "testable": F.col("n_measured") >= F.lit(0.8) * F.col("n"), "edge_quality": quality})


@query(
    """select 1 as step, 'complete' as condition, count(*) as n from orders where o_totalprice > 20000
    union all select 2, 'two-way', count(*) from orders where o_totalprice > 20000 and o_orderstatus <> 'P'
    union all select 3, 'residence', count(*) from orders where o_totalprice > 20000 and o_orderstatus <> 'P' and o_orderpriority like '1%'"""
)
def condition_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [("complete", F.col("o_totalprice") > 20000), ("two-way", F.col("o_orderstatus") != "P"), ("residence", F.col("o_orderpriority").startswith("1"))]
    return A.funnel(table(spark, sf_dir, "orders"), steps)


@query(
    """select t::double as threshold, count(*) filter (where l_quantity <= t) as n, (sum(l_extendedprice::decimal(18,4)) filter (where l_quantity <= t))::double as w
    from lineitem, (select unnest([14, 16, 18, 20, 22, 24]) as t) group by 1"""
)
def threshold_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.at_thresholds(table(spark, sf_dir, "lineitem"), "l_quantity", [14, 16, 18, 20, 22, 24], "l_extendedprice")


SHOULDER = "round((l_quantity - 18) / 2.0::double, 1)"


@query(
    f"""with s as (select {SHOULDER} as each_side, l_extendedprice as len from lineitem)
    select w::double as threshold, count(*) filter (where each_side <= w) as n, round((sum(len::decimal(18,4)) filter (where each_side <= w))::double / 5280.0::double, 1) as miles
    from s, (select unnest([0, 1, 2, 3, 4, 5, 6, 7, 9]) as w) group by 1"""
)
def cumulative_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(rnd((F.col("l_quantity") - 18) / 2.0, 1).alias("each_side"), "l_extendedprice")
    curve = A.at_thresholds(lines, "each_side", [0, 1, 2, 3, 4, 5, 6, 7, 9], "l_extendedprice")
    return curve.select("threshold", "n", rnd(F.col("w") / 5280.0, 1).alias("miles"))


TIERS = [(0, "a. none"), (1, "b. 1"), (2, "c. 2"), (3, "d. 3"), (5, "e. 4-5"), (7, "f. 6-7"), (9, "g. 8-9")]


@query(
    f"""with s as (select {SHOULDER} as x, l_extendedprice as len from lineitem)
    select case when x <= 0 then 'a. none' when x <= 1 then 'b. 1' when x <= 2 then 'c. 2' when x <= 3 then 'd. 3' when x <= 5 then 'e. 4-5' when x <= 7 then 'f. 6-7'
        when x <= 9 then 'g. 8-9' else 'h. more' end as shoulder, count(*) as n, round(sum(len::decimal(18,4))::double / 5280.0::double, 1) as miles from s group by 1"""
)
def shoulder_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("x", rnd((F.col("l_quantity") - 18) / 2.0, 1))
    return lines.groupBy(tier(F.col("x"), TIERS, "h. more").alias("shoulder")).agg(F.count(F.lit(1)).alias("n"), miles(F.col("l_extendedprice")).alias("miles"))


@query(
    """select 2 * (l_quantity / 2)::bigint as bucket, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct,
        case when 3 * (l_quantity / 3)::bigint < 10 then '< 10' else '10+' end as band from lineitem group by 1, 4"""
)
def rounded_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    band = F.when(3 * whole(F.col("l_quantity") / 3) < 10, "< 10").otherwise("10+")
    counted = lines.groupBy((2 * whole(F.col("l_quantity") / 2)).alias("bucket"), band.alias("band")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("pct", share_of_total(counted))


@query(
    """with p as (select l_suppkey, case when l_discount > 0.01 then l_extendedprice end as w, l_returnflag = 'A' as o from lineitem)
    select l_suppkey, count(*) as n, count(w) as n_measured, round(min(w), 1) as w_min, round(quantile_cont(w, 0.05), 1) as w_p05, round(median(w), 1) as w_median,
        round(median(w) filter (where o), 1) as w_median_outer, round(quantile_cont(w, 0.95), 1) as w_p95, round(max(w), 1) as w_max,
        round(min(w) filter (where o), 1) as w_min_outer, round(max(w) filter (where o), 1) as w_max_outer, count(*) filter (where o) as n_outer,
        count(*) filter (where w <= 18000) as n_under from p group by 1"""
)
def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "lineitem").select("l_suppkey", F.when(F.col("l_discount") > 0.01, F.col("l_extendedprice")).alias("w"), (F.col("l_returnflag") == "A").alias("o"))
    w, outer = F.col("w"), where(F.col("o"), F.col("w"))
    named = {
        "w_min": F.min(w), "w_p05": F.percentile(w, 0.05), "w_median": F.median(w), "w_median_outer": F.median(outer), "w_p95": F.percentile(w, 0.95), "w_max": F.max(w),
        "w_min_outer": F.min(outer), "w_max_outer": F.max(outer),
    }
    return p.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.count(w).alias("n_measured"), *(rnd(c, 1).alias(k) for k, c in named.items()), count_where(F.col("o")).alias("n_outer"), count_where(w <= 18000).alias("n_under")
    )


# ---- runs along a line (W6, A12, A15, A17) ----------------------------------------------------------------------


@query(
    """with f as (select *, value >= 60 as narrow from events),
    m as (select *, row_number() over (partition by user_id order by ts, event_id) - row_number() over (partition by user_id, narrow order by ts, event_id) as run from f)
    select user_id, run, count(*) as n, min(event_id) as first_event, max(event_id) as last_event, min(value) as least_value,
        first(event_type order by value, event_id) as type_at_least, bool_or(event_type = 'error') as any_error,
        string_agg(event_type, '>' order by ts, event_id) as path
    from m where narrow group by 1, 2 having count(*) >= 2"""
)
def gaps_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = A.islands(table(spark, sf_dir, "events").withColumn("narrow", F.col("value") >= 60), "user_id", ["ts", "event_id"], "narrow").where("narrow")
    path = F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda s: s["event_type"])
    runs = marked.groupBy("user_id", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), F.min("value").alias("least_value"),
        least_by(F.col("event_type"), F.col("value"), F.col("event_id")).alias("type_at_least"), F.bool_or(F.col("event_type") == "error").alias("any_error"), F.array_join(path, ">").alias("path"),
    )
    return runs.where("n >= 2")


CURB = "x as (select l_orderkey, l_extendedprice % 100 - 50 as s, l_partkey, case when l_linenumber < 3 then 3130 when l_linenumber < 6 then 3110 else 3140 end as kind from lineitem)"


@query(
    f"""with {CURB},
    p as (select *, row_number() over (partition by l_orderkey order by s, l_partkey, kind) as rn from x where s > 0.5),
    n as (select *, row_number() over (partition by l_orderkey order by s desc, l_partkey, kind) as rn from x where s < -0.5)
    select o_orderkey, p.s as right_ft, p.kind::int as right_kind, n.s as left_ft, n.kind::int as left_kind, p.s - n.s as gap_ft,
        case when coalesce(p.kind = 3130 and n.kind = 3130, false) then null else p.s - n.s end as roadway_ft,
        p.s is null and n.s is null as none, (p.s is null) <> (n.s is null) as one_side,
        coalesce(p.kind = 3140 or n.kind = 3140, false) as shoulder_edge, coalesce(p.kind in (3110, 3120) and n.kind in (3110, 3120), false) as outer_curb
    from orders left join p on o_orderkey = p.l_orderkey and p.rn = 1 left join n on o_orderkey = n.l_orderkey and n.rn = 1"""
)
def nearest_each_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    x = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice") % 100 - 50).alias("s"), F.struct("l_partkey", F.when(n < 3, 3130).when(n < 6, 3110).otherwise(3140).alias("kind")).alias("curb")
    )
    near = A.nearest_each_side(x, "o_orderkey", "s", "curb")
    g = table(spark, sf_dir, "orders").select("o_orderkey").join(near, "o_orderkey", "left")
    g = g.select("o_orderkey", "right_ft", F.col("right_curb.kind").alias("right_kind"), "left_ft", F.col("left_curb.kind").alias("left_kind"), (F.col("right_ft") - F.col("left_ft")).alias("gap_ft"))
    right, left = F.col("right_kind"), F.col("left_kind")
    return g.withColumns(
        {
            "roadway_ft": F.when(~known((right == 3130) & (left == 3130)), F.col("gap_ft")),
            "none": F.col("right_ft").isNull() & F.col("left_ft").isNull(),
            "one_side": F.col("right_ft").isNull() != F.col("left_ft").isNull(),
            "shoulder_edge": known((right == 3140) | (left == 3140)),
            "outer_curb": known(right.isin(3110, 3120) & left.isin(3110, 3120)),
        }
    )


@query(
    """with p as (select l_orderkey, l_partkey, l_linenumber, case when l_tax > 0.02 then l_tax end as a, case when l_discount > 0.03 then l_discount end as b, l_quantity from lineitem)
    select coalesce(a > 0.05, false) as big_a, (a is null) <> (b is null) as one_known, coalesce(a = 0.04 or b = 0.04, false) as either, a is null and b is null as neither,
        least(a, b) as low, greatest(a, b) as high, a + b as both_, count(*) as n from p where l_linenumber not in (3, 5) and l_quantity between 5 and 40 group by all"""
)
def three_valued_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "lineitem").where(~F.col("l_linenumber").isin(3, 5) & F.col("l_quantity").between(5, 40))
    a, b = F.when(F.col("l_tax") > 0.02, F.col("l_tax")), F.when(F.col("l_discount") > 0.03, F.col("l_discount"))
    return p.groupBy(
        known(a > 0.05).alias("big_a"), (a.isNull() != b.isNull()).alias("one_known"), known((a == 0.04) | (b == 0.04)).alias("either"), (a.isNull() & b.isNull()).alias("neither"),
        F.least(a, b).alias("low"), F.greatest(a, b).alias("high"), (a + b).alias("both_"),
    ).agg(F.count(F.lit(1)).alias("n"))


# ---- joins (J1-J3, J9-J11, J14, J15, J18, P12, U1, U3, S2.8) -----------------------------------------------------


@query(
    """select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)
    and exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')"""
)
def semi_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    found = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for p in ("o_totalprice > 400000", "o_orderstatus = 'P'"):
        found = found.join(orders.where(p).select("c_custkey"), "c_custkey", "left_semi")
    return found


@query("select count(distinct l_partkey) as n from lineitem where not exists (select 1 from part where p_partkey = l_partkey and p_size < 40)")
def anti_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").where("p_size < 40").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, sf_dir, "lineitem").select("l_partkey").join(parts, "l_partkey", "left_anti").agg(F.count_distinct("l_partkey").alias("n"))


@query(
    """select c_custkey, count(o_orderkey) as n_final, round(median(o_totalprice), 1) as median_price from customer
    left join orders on o_custkey = c_custkey and o_orderstatus = 'F' and o_totalprice > 100000 group by 1"""
)
def left_filtered_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    joined = table(spark, sf_dir, "customer").select("c_custkey").join(right, "c_custkey", "left")
    return joined.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_final"), rnd(F.median("o_totalprice"), 1).alias("median_price"))


@query(
    """select (select count(*) from orders) as orders, (select round(sum(o_totalprice::decimal(18,4))::double / 5280.0::double, 1) from orders) as miles,
    (select count(*) from lineitem where l_quantity <= 18) as narrow, (select count(*) from customer where c_acctbal < 0) as untestable"""
)
def scalar_subqueries(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("orders"), miles(F.col("o_totalprice")).alias("miles"))
    two = table(spark, sf_dir, "lineitem").agg(count_where(F.col("l_quantity") <= 18).alias("narrow"))
    three = table(spark, sf_dir, "customer").agg(count_where(F.col("c_acctbal") < 0).alias("untestable"))
    return one.crossJoin(two).crossJoin(three)  # one row each


@query(
    """select o_orderkey as block_id, least(o_totalprice, p.w) as wn, 'pms' as src, case when p.w is not null and p.w < o_totalprice then 'curb' else 'pms' end as nsrc
    from orders left join (select l_orderkey, min(l_extendedprice) as w from lineitem group by 1) p on l_orderkey = o_orderkey and p.w < 5000 where o_orderstatus = 'F'
    union all
    select o_orderkey, coalesce(p.w, p.v), 'curb', 'curb' from orders join (select l_orderkey, min(l_extendedprice) filter (where l_returnflag = 'R') as w, min(l_extendedprice) as v from lineitem group by 1) p
    on l_orderkey = o_orderkey where o_orderstatus <> 'F' and exists (select 1 from lineitem l where l.l_orderkey = o_orderkey and l.l_discount = 0)"""
)
def two_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("block_id"), "o_totalprice", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("block_id")).agg(
        F.min("l_extendedprice").alias("v"), F.min(where(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("w"), F.bool_or(F.col("l_discount") == 0).alias("any_two_way")
    )
    wn, v = F.col("o_totalprice"), F.col("v")
    recorded = orders.where("o_orderstatus = 'F'").join(lines.where("v < 5000"), "block_id", "left")
    recorded = recorded.select("block_id", F.least(wn, v).alias("wn"), F.lit("pms").alias("src"), F.when(known(v < wn), "curb").otherwise("pms").alias("nsrc"))
    measured = orders.where("o_orderstatus <> 'F'").join(lines.where("any_two_way"), "block_id")
    return recorded.unionByName(measured.select("block_id", F.coalesce("w", "v").alias("wn"), F.lit("curb").alias("src"), F.lit("curb").alias("nsrc")))


@query(
    """with c as (select try_cast(regexp_extract(c_name, '#0*([0-9]+)$', 1) as integer) as k, c_nationkey from customer),
    s as (select try_cast(regexp_extract(s_name, '#0*([0-9]+)$', 1) as integer) as k, trim(upper(s_name)) || '!' as name from supplier)
    select k, name, c_nationkey from c join s using (k)"""
)
def regex_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda c: F.regexp_extract(c, "#0*([0-9]+)$", 1).try_cast("int").alias("k")
    left = table(spark, sf_dir, "customer").select(key(F.col("c_name")), "c_nationkey")
    right = table(spark, sf_dir, "supplier").select(key(F.col("s_name")), F.concat(F.trim(F.upper("s_name")), F.lit("!")).alias("name"))
    return left.join(right, "k").select("k", "name", "c_nationkey")


def _priced(df: DataFrame, key: str, value, name: str) -> DataFrame:
    return df.select(F.col(key), value.alias(name))


@query(
    """with e as (select event_id, value * 10 as x from events), o as (select o_orderkey, o_totalprice / 100 as y from orders),
    d as (select event_id, o_orderkey, abs(x - y) as d, row_number() over (partition by event_id order by abs(x - y), o_orderkey) as rn from e join o on abs(x - y) <= 30)
    select event_id, o_orderkey, round(d, 6) as d from d where rn = 1 and d < 30"""
)
def nearest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _priced(table(spark, sf_dir, "events"), "event_id", F.col("value") * 10, "x")
    o = _priced(table(spark, sf_dir, "orders"), "o_orderkey", F.col("o_totalprice") / 100, "y")
    best = J.nearest_1d(e, o, "x", "o_orderkey", "y", 30.0).where("d < 30")
    return best.select("event_id", "o_orderkey", rnd(F.col("d"), 6).alias("d"))


@query("select c_custkey, exists (select 1 from supplier where abs(s_acctbal - c_acctbal) <= 60) as near from customer")
def within_distance_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    near = J.nearest_1d(c, s, "c_acctbal", "s_suppkey", "s_acctbal", 60.0).select("c_custkey", F.lit(True).alias("near"))
    return c.select("c_custkey").join(near, "c_custkey", "left").withColumn("near", known(F.col("near")))


@query("select p_partkey, round(min(abs(p_retailprice * 3 - s_acctbal)), 6) as d from part join supplier on abs(p_retailprice * 3 - s_acctbal) <= 200 group by 1")
def min_distance_to_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distance_to_suppliers(spark, sf_dir, table(spark, sf_dir, "part"))


@query(
    """with a as (select p_partkey, p_retailprice * 3 as x, s_acctbal as y from part asof left join supplier on s_acctbal <= p_retailprice * 3),
    b as (select p_partkey, p_retailprice * 3 as x, s_acctbal as y from part asof left join supplier on s_acctbal >= p_retailprice * 3),
    n as (select p_partkey, list_min([abs(a.x - a.y), abs(b.x - b.y)]) as d from a join b using (p_partkey))
    select p_partkey, round(d, 6) as d from n where d <= 200"""
)
def min_distance_to_set_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return min_distance_to_set(spark, sf_dir)


def _distance_to_suppliers(spark: SparkSession, sf_dir: str, parts: DataFrame) -> DataFrame:
    p = parts.select("p_partkey", (F.col("p_retailprice") * 3).alias("x"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return J.nearest_1d(p, s, "x", "s_suppkey", "s_acctbal", 200.0).select("p_partkey", rnd(F.col("d"), 6).alias("d"))


def sampled(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A fixed sample of n rows: the first by a digest of key and seed."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


@query(
    """with o as (select o_custkey, o_orderkey, o_totalprice as a, o_totalprice + 40 as b from orders), l as (select l_linenumber, l_partkey, l_extendedprice * 4 as c, l_extendedprice * 4 + l_quantity as d from lineitem)
    select o_orderkey, count(*) as n, min(l_partkey) as least_part, max(l_partkey) as most_part from o join l on b >= c and a <= d group by 1"""
)
def tile_bbox_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("a"), (F.col("o_totalprice") + 40).alias("b"))
    l = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_extendedprice") * 4).alias("c"), (F.col("l_extendedprice") * 4 + F.col("l_quantity")).alias("d"))  # noqa: E741
    found = overlapped(o, l, "o_orderkey", [("a", "b")], [("c", "d")], "l_partkey", lambda *sides: J.box_join(*sides, 300.0))
    return found.withColumnsRenamed({"least": "least_part", "most": "most_part"})


@query(
    """with a as (select o_orderkey as i, o_totalprice % 9000 as x0, o_totalprice % 9000 + 30 as x1, o_totalprice % 7001 as y0, o_totalprice % 7001 + 60 as y1 from orders),
    b as (select p_partkey as j, p_retailprice * 97 % 9000 as u0, p_retailprice * 97 % 9000 + p_size * 10 as u1, p_retailprice * 89 % 7001 as v0, p_retailprice * 89 % 7001 + p_size * 5 as v1 from part)
    select i, j from a join b on x1 >= u0 and x0 <= u1 and y1 >= v0 and y0 <= v1"""
)
def tile_bbox_join_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, r, s = F.col("o_totalprice"), F.col("p_retailprice"), F.col("p_size")
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("i"), (t % 9000).alias("x0"), (t % 9000 + 30).alias("x1"), (t % 7001).alias("y0"), (t % 7001 + 60).alias("y1"))
    b = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("j"), (r * 97 % 9000).alias("u0"), (r * 97 % 9000 + s * 10).alias("u1"), (r * 89 % 7001).alias("v0"), (r * 89 % 7001 + s * 5).alias("v1"))
    return J.listed_pairs(a, b, [("x0", "x1"), ("y0", "y1")], [("u0", "u1"), ("v0", "v1")], "i", "j", 300.0)


# ---- sort, top-k, distinct, samples, small dimensions (O1-O4, U3, F1, C1-C5, P2, P13, A9) ------------------------


@query("select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey limit 12")
def topk_total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(12)


@query("select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


@query("select o_orderkey, o_totalprice from orders order by md5(o_orderkey::varchar || '42'), o_orderkey limit 250")
def md5_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled(table(spark, sf_dir, "orders"), "o_orderkey", 250).select("o_orderkey", "o_totalprice")


def nrr_class(each_side):
    """Display class by shoulder width."""
    return F.when(each_side <= 0, "now").when(each_side <= 3, "easy").when(each_side <= 5, "hard").otherwise("no")


@query(
    """select case when x <= 0 then 'now' when x <= 3 then 'easy' when x <= 5 then 'hard' else 'no' end as class, case when x <= 0 then 4 else 3 end as stroke, count(*) as n
    from (select round((l_quantity - 18) / 2.0::double, 1) as x from lineitem) where x <= 9 group by 1, 2"""
)
def macro_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(rnd((F.col("l_quantity") - 18) / 2.0, 1).alias("x")).where("x <= 9")
    return x.groupBy(nrr_class(F.col("x")).alias("class"), F.when(F.col("x") <= 0, 4).otherwise(3).alias("stroke")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """select o_custkey as block_id, first(o_orderkey order by o_orderkey) as first_seg, first(o_totalprice order by o_orderkey) as wn, max(o_totalprice) as rw, count(*) as nseg
    from orders group by 1"""
)
def block_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.min(F.struct("o_orderkey", "o_totalprice"))
    found = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("block_id")).agg(first.alias("f"), F.max("o_totalprice").alias("rw"), F.count(F.lit(1)).alias("nseg"))
    return found.select("block_id", F.col("f.o_orderkey").alias("first_seg"), F.col("f.o_totalprice").alias("wn"), "rw", "nseg")


BINS = [(0, 10), (10, 14), (14, 18), (18, 24), (24, 36), (36, 51)]


@query(
    """select b.lo as low, b.hi as high, count(*) as total, count(*) filter (where l_discount <= 0.05) as n, round((sum(l_extendedprice::decimal(18,4)) filter (where l_discount <= 0.05))::double / 5280.0::double, 1) as miles
    from lineitem join (values (0, 10), (10, 14), (14, 18), (18, 24), (24, 36), (36, 51)) b(lo, hi) on l_quantity > 0 and l_quantity >= b.lo and l_quantity < b.hi group by 1, 2"""
)
def bin_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 0")
    number = F.lit(None).cast("int")
    for k, (low, high) in enumerate(BINS):
        number = F.when((F.col("l_quantity") >= low) & (F.col("l_quantity") < high), k).otherwise(number)
    passes = F.col("l_discount") <= 0.05
    found = lines.groupBy(number.alias("k")).agg(F.count(F.lit(1)).alias("total"), count_where(passes).alias("n"), rnd(F.sum(where(passes, F.col("l_extendedprice").cast("decimal(18,4)"))).cast("double") / 5280.0, 1).alias("miles"))
    of = lambda at: F.element_at(F.array(*(F.lit(b[at]) for b in BINS)), F.col("k") + 1)
    return found.where("k is not null").select(of(0).alias("low"), of(1).alias("high"), "total", "n", "miles")


def reading(narrowest, widest, use: str, most: bool, threshold: float):
    """Whether a block's narrowest or widest width lies on the asked side of a threshold; unknown widths don't."""
    x = narrowest if use == "narrowest" else widest
    return known(x <= threshold if most else x >= threshold)


@query(
    """with b as (select l_orderkey, min(case when l_quantity > 3 then l_quantity end) as wn, max(case when l_quantity > 3 then l_quantity end) as wx from lineitem group by 1)
    select 'narrowest' as use, true as at_most, count(*) as n, max(greatest(0, (wx - 18) / 2)) as most_line from b where wn <= 18 union all
    select 'narrowest', false, count(*), max(greatest(0, (wx - 18) / 2)) from b where wn >= 18 union all
    select 'widest', true, count(*), max(greatest(0, (wx - 18) / 2)) from b where wx <= 18 union all
    select 'widest', false, count(*), max(greatest(0, (wx - 18) / 2)) from b where wx >= 18"""
)
def reading_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.when(F.col("l_quantity") > 3, F.col("l_quantity"))
    b = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(w).alias("wn"), F.max(w).alias("wx"))
    line = F.greatest(F.lit(0.0), (F.col("wx") - 18) / 2)
    ways = [(use, most, reading(F.col("wn"), F.col("wx"), use, most, 18.0)) for use in ("narrowest", "widest") for most in (True, False)]
    one = b.agg(*(c for k, (_, _, p) in enumerate(ways) for c in (count_where(p).alias(f"n{k}"), F.max(where(p, line)).alias(f"m{k}"))))
    rows = F.array(*(F.struct(F.lit(u).alias("use"), F.lit(m).alias("at_most"), F.col(f"n{k}").alias("n"), F.col(f"m{k}").alias("most_line")) for k, (u, m, _) in enumerate(ways)))
    return one.select(F.explode(rows).alias("r")).select("r.*")


@query(
    """select 'customer' as layer, count(*) as n, count(*) filter (where c_acctbal < 0) as flagged from customer union all select 'orders', count(*), count(*) filter (where o_orderstatus = 'P') from orders
    union all select 'lineitem', count(*), count(*) filter (where l_discount = 0) from lineitem union all select 'part', count(*), count(*) filter (where p_type like 'S%') from part"""
)
def load_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"customer": F.col("c_acctbal") < 0, "orders": F.col("o_orderstatus") == "P", "lineitem": F.col("l_discount") == 0, "part": F.col("p_type").startswith("S")}
    one = [table(spark, sf_dir, t).agg(F.lit(t).alias("layer"), F.count(F.lit(1)).alias("n"), count_where(p).alias("flagged")) for t, p in flags.items()]
    out = one[0]
    for more in one[1:]:
        out = out.unionByName(more)
    return out


@query(
    """with b as (select l_orderkey, max(l_quantity) as w, count(*) as n, count(*) filter (where l_quantity <= 18) as under, sum(l_extendedprice::decimal(18,4))::double as len from lineitem group by 1)
    select l_orderkey, round((w - 18) / 2.0::double, 1) as each_side, round(w - 18, 1) as one_side, round(under * 5.0::double, 1) as already, round((n - under) * 5.0::double, 1) as needs,
        round(len - n * 5.0::double, 1) as unmeasured, w <= 18 as narrow from b where n >= 2"""
)
def edge_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    b = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max(q).alias("w"), F.count(F.lit(1)).alias("n"), count_where(q <= 18).alias("under"), F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).cast("double").alias("len"))
    w, n, under = F.col("w"), F.col("n"), F.col("under")
    return b.where("n >= 2").select(
        "l_orderkey", rnd((w - 18) / 2.0, 1).alias("each_side"), rnd(w - 18, 1).alias("one_side"), rnd(under * 5.0, 1).alias("already"), rnd((n - under) * 5.0, 1).alias("needs"),
        rnd(F.col("len") - n * 5.0, 1).alias("unmeasured"), (w <= 18).alias("narrow"),
    )


@query(
    """with s as (select o_orderkey, o_custkey, o_totalprice, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rn from orders),
    d as (select o_custkey, median(o_totalprice) as med, count(*) as n from orders group by 1)
    select o_orderkey, rn, round(o_totalprice - med, 1) as over_median, n from s join d using (o_custkey) where rn <= 2 and n >= 3"""
)
def against_group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    dimension = orders.groupBy("o_custkey").agg(F.median("o_totalprice").alias("med"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    top = orders.withColumn("rn", rank.cast("long")).where("rn <= 2")
    return top.join(dimension, "o_custkey").select("o_orderkey", "rn", rnd(F.col("o_totalprice") - F.col("med"), 1).alias("over_median"), "n")
