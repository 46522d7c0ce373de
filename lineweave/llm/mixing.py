"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame expressions only.

Documents of a source are shuffled (ordered by a digest of their id) and laid end to end; the stream is cut into blocks
of equal token counts. A schedule of slots takes blocks: slot ``i`` maps the point ``frac(i * golden ratio)`` (as exact
integers) through the cumulative weights to a source, the slots of a source are ranked, and the slot of rank ``r`` takes
block ``r`` of its source's stream, which repeats from its start when it is through. A source's slots end when its quota
is full, the last slot in part; the few slots that the points leave it short of follow the others. So the words taken
from a source are its target, rounded, and those taken from a document lie between 0 and ``ceil(cap)`` times its size.

No group is ranked or summed as a whole: offsets come from sums by (source, digest prefix) and by (source, slot chunk).

Defined cases: a null text has size 0 and nothing of it is taken; a null source is one source, sorted last; ids may be
null or repeat, every row gives a row, and rows equal in id and size are interchangeable; an empty table gives no rows;
sources without words have target 0; columns other than those named are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineweave.llm.common import cut

WEIGHTS, SHARE, CAP, BLOCK, SEED = (5, 2, 1), 1.5, 2, 1024, 7
POINTS = 1 << 31
GOLDEN = 1_327_217_885  #: POINTS over the golden ratio, made odd: i * GOLDEN mod POINTS visits every point once
CELLS = 4096
BUCKET = 50_000  #: rows of a source that are put in order together, about
SMALL = 100_000  #: rows of a table that is still broadcast


def words(text: Column) -> Column:
    """Count of the runs of characters other than space and 9 to 13."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def attach(rows: DataFrame, small: DataFrame, on: list[str], salts: int = 64) -> DataFrame:
    """Inner join with a table of few rows for each key: broadcast if it is counted to be small, else salted on both sides."""
    if small.count() <= SMALL:
        return rows.join(F.broadcast(small), on)
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "_salt"]).drop("_salt")


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Rows (source, sid, source_size, weight, target): the share by weight, with what is above the caps shared again.

    By rising size over weight the sources at their cap come first; each row tells whether it would be above its cap if
    all before it are at theirs, and the first that isn't gives the level for itself and all that follow.
    """
    every = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("sid", every)
    sources = sources.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    sources = sources.withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    sources = sources.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.col("limit"))
    sources = sources.withColumn("first", F.row_number().over(order)).withColumn("at", F.min(F.when(F.col("free"), F.struct("first", "level"))).over(whole))
    free = F.coalesce(F.col("first") >= F.col("at.first"), F.lit(False))
    return sources.select("source", "sid", "source_size", "weight", F.when(free, F.col("at.level") * F.col("weight")).otherwise(F.col("limit")).alias("target"))


def with_needs(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds each source's quota, its count of blocks, the slots it needs and the sum of those before it and of all."""
    size = F.greatest(F.col("source_size"), F.lit(1))
    sources = sources.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
    sources = sources.withColumn("blocks", F.ceil(size / F.lit(block)).cast("long"))
    sources = sources.withColumn("need", F.floor(F.col("quota") / size).cast("long") * F.col("blocks") + F.ceil((F.col("quota") % size) / F.lit(block)).cast("long"))
    upto = F.sum("need").over(Window.orderBy("sid"))
    return sources.withColumns({"below": upto - F.col("need"), "needs": F.sum("need").over(Window.partitionBy())})


def schedule(sources: DataFrame, block: int = BLOCK, chunk: int = 1024) -> DataFrame:
    """Rows (slot, sid, rank, block, pass, take): which words of which block each slot takes, in the order of the slots."""
    spark = sources.sparkSession
    slots = sources.agg(F.coalesce(F.max("needs"), F.lit(0))).first()[0]
    low, high = (F.floor(x / F.col("needs") * F.lit(float(POINTS))).cast("long") for x in (F.col("below"), F.col("below") + F.col("need")))
    spans = sources.where("need > 0").select("sid", low.alias("low"), high.alias("high")).where("high > low")
    width = POINTS // CELLS
    spans = spans.withColumn("cell", F.explode(F.sequence((F.col("low") / width).cast("long"), ((F.col("high") - 1) / width).cast("long"))))
    drawn = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") % POINTS * GOLDEN % POINTS).alias("point"))
    drawn = attach(drawn.withColumn("cell", F.floor(F.col("point") / width).cast("long")), spans, ["cell"])
    drawn = drawn.where("point >= low and point < high").select("slot", "sid", F.floor(F.col("slot") / chunk).cast("long").alias("chunk"))
    counts = drawn.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = drawn.join(offsets, ["sid", "chunk"])
    ranked = ranked.withColumn("rank", F.col("offset") + F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    short = sources.join(counts.groupBy("sid").agg(F.sum("n").alias("drawn")), "sid", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    short = short.where("drawn < need").select("sid", F.explode(F.expr("sequence(drawn, need - 1)")).alias("rank"), F.lit(slots).alias("slot"))
    ranked = ranked.select("sid", "rank", "slot").unionByName(short)
    ranked = attach(ranked, sources.select("sid", "need", "blocks", "quota", "source_size"), ["sid"]).where("rank < need")
    ranked = ranked.withColumns({"block": F.col("rank") % F.col("blocks"), "pass": F.floor(F.col("rank") / F.col("blocks")).cast("long")})
    left = F.col("quota") - F.col("pass") * F.col("source_size") - F.col("block") * block
    take = F.least(F.lit(block), F.col("source_size") - F.col("block") * block, left)
    return ranked.select("slot", "sid", "rank", "block", "pass", take.alias("take"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK, seed: int = SEED,
) -> DataFrame:
    """Rows (id, source, size, source_size, target, taken), one for each document."""
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f"|{seed}")))
    sized = cut(docs.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), words(F.col(text)).alias("size"), digest.alias("digest")))
    sources = cut(with_needs(source_targets(sized, weights, share, cap), block))
    # A null source joins by its number, so the join itself is on what is never null.
    named = sources.select(F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("key"), "sid", "source_size", "target")
    rows = sized.withColumn("key", F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")))
    digits = max(3, math.ceil(math.log(max(sized.count(), 1) / BUCKET, 16)))
    rows = attach(rows, named, ["key"]).drop("key").withColumn("bucket", F.substring("digest", 1, digits))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    offsets = sums.select("sid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("sid", "bucket").orderBy("digest", "size")
    placed = rows.join(offsets, ["sid", "bucket"]).withColumns({"no": F.row_number().over(inside), "upto": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))})
    placed = placed.withColumn("start", F.col("offset") + F.col("upto") - F.col("size"))
    whole = ["id", "source", "size", "source_size", "target"]
    parts = placed.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    parts = parts.withColumns(
        {"a": F.greatest(F.col("start") - F.col("block") * block, F.lit(0)), "b": F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))}
    )
    takes = schedule(sources, block).groupBy("sid", "block").agg(F.collect_list("take").alias("takes"))
    got = F.aggregate("takes", F.lit(0).cast("long"), lambda n, t: n + F.greatest(F.least(F.col("b"), t) - F.col("a"), F.lit(0)))
    parts = parts.join(takes, ["sid", "block"], "left").withColumn("taken", F.coalesce(got, F.lit(0)))
    full = parts.groupBy("sid", "bucket", "no").agg(*(F.first(c).alias(c) for c in whole), F.sum("taken").cast("long").alias("taken")).select(*whole, "taken")
    return full.unionByName(placed.where("size = 0").select(*whole, F.lit(0).cast("long").alias("taken")))


def copies(taken: Column, size: Column) -> Column:
    """How often a whole document goes into a mix that takes documents and not words."""
    return F.floor(taken / size + 0.5).cast("int")


# The same rows in closed form: the slots of a source cover its stream up to the quota.
ORACLE = r"""
with d as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents
), s as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as sid from d group by source
), w as (
    select *, [5, 2, 1][((sid - 1) % 3 + 1)::int] as weight, source_size * 2.0::double as lim from s
), l as (
    select *, row_number() over o as pos,
        ((sum(source_size) over ())::double * 1.5::double - coalesce((sum(lim) over (o rows between unbounded preceding and 1 preceding)), 0::double))
            / (sum(weight) over (o rows between current row and unbounded following))::double as level
    from w window o as (order by lim / weight, sid)
), f as (
    select *, min(case when level * weight <= lim then pos end) over () as free from l
), t as (
    select *, case when pos >= free then max(case when pos = free then level end) over () * weight else lim end as target from f
), p as (
    select d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::bigint as quota,
        (sum(d.size) over (partition by t.sid order by md5(coalesce(d.doc_id::varchar, '') || '|7'), d.size rows unbounded preceding))::bigint - d.size as start
    from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
    (greatest(least(start + size, quota) - start, 0) + greatest(least(source_size + start + size, quota) - source_size - start, 0))::bigint as taken
from p
"""
