"""Bottom-k sketches of word shingles, with DataFrame expressions only.

The sketch of a text is the ``k`` least 64-bit hashes of its shingles, in order. Sketches of the parts of a whole merge by
union, so a long text is sketched part by part, and ``merged`` does the same over rows. From two sketches come estimates of
resemblance and containment, and from one the count of distinct shingles; all are exact while the sketches hold every hash.

``neighbours`` gives every row the text that follows in an order over all rows. The keys alone are numbered; every so many
of them begins a block, and a row finds its block by comparing its key with these bounds. A copy of each block's first row
goes to the end of the block before, so each block is a window of its own: whole texts move once.

Defined cases: a null text is empty; a text without words has an empty sketch, and two of these resemble each other wholly,
one of them and another text not at all; with fewer words than a shingle has, the whole sequence is one; null ids come last
in the order, and rows with one id are ordered by a hash of their text; rows equal in both lie in one block; a row alone
follows itself; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineweave.llm.common import cut
from lineweave.operators import numbering, tables

K, N = 256, 5  #: hashes of a sketch and words of a shingle
PART = 4096  #: shingles that are sorted together
BLOCK_BYTES, BLOCK_ROWS, BLOCKS = 4 << 20, 1000, 250_000  #: of texts in a block, rows at most if blocks are few enough, and bounds at most
HASHES = "array<bigint>"


def words(text: Column) -> Column:
    """Runs of characters other than space and 9 to 13."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def least(hashes: Column, k: int = K) -> Column:
    """The k least distinct hashes, in order."""
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return least(F.concat(a, b), k)


def of_words(word: Column, k: int = K, n: int = N) -> Column:
    """The sketch of a column of words, which should be a plain column, as it is read again for each part."""
    shingles = F.greatest(F.size(word) - (n - 1), F.least(F.size(word), F.lit(1)))
    parts = F.sequence(F.lit(0), F.ceil(shingles / PART).cast("int") - 1)
    empty = F.expr(f"cast(array() as {HASHES})")

    def add(sketch: Column, part: Column) -> Column:
        places = F.sequence(part * PART + 1, F.least((part + 1) * PART, shingles))
        return merge(sketch, F.transform(places, lambda i: F.xxhash64(F.slice(word, i, F.lit(n)))), k)

    return F.when(shingles > 0, F.aggregate(parts, empty, add)).otherwise(empty)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, n: int = N) -> DataFrame:
    """Adds the sketch of a text column."""
    return df.withColumn("_words", words(F.coalesce(F.col(text), F.lit("")))).withColumn(name, of_words(F.col("_words"), k, n)).drop("_words")


def merged(df: DataFrame, groups: list[str], sketch: str, k: int = K, salts: int = 64) -> DataFrame:
    """Rows (the groups, sketch) of the unions of all sketches of each group; a hot group is merged in ``salts`` parts first."""
    salt = F.pmod(F.xxhash64(sketch), F.lit(salts)).alias("_salt")
    hashes = df.select(*groups, salt, F.explode(sketch).alias("_hash")).distinct()
    # collect_set of a part is bounded by ranking: only the k least of a part can be in the whole.
    order = Window.partitionBy(*groups, "_salt").orderBy("_hash")
    parts = hashes.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    sums = parts.groupBy(*groups, "_salt").agg(F.collect_list("_hash").alias("_part"))
    union = least(F.flatten(F.collect_list("_part")), k).alias(sketch)
    empty = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    found = empty.join(sums.groupBy(*groups).agg(union), same, "left")
    return found.select(*(F.col(f"_g{i}").alias(g) for i, g in enumerate(groups)), F.coalesce(sketch, F.expr(f"cast(array() as {HASHES})")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of intersection over union, 0 to 1; 1 for two empty sketches. Give it plain columns."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the share of a's shingles that b has, 0 to 1; 1 if a has none."""
    union = merge(a, b, k)
    mine, both = F.size(F.array_intersect(union, a)), F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(a) == 0, 1.0).when(mine == 0, 0.0).otherwise(both / mine)


def distinct(a: Column, k: int = K) -> Column:
    """Estimate of the count of distinct shingles, exact below k."""
    unit = (F.element_at(a, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / unit)


def as_text(a: Column) -> Column:
    """16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def from_text(fingerprint: Column) -> Column:
    """The sketch that ``as_text`` wrote."""
    low = lambda i: F.conv(F.substring(fingerprint, i * 16 + 1, F.lit(16)), 16, -10).cast("bigint")
    size = F.floor(F.length(fingerprint) / 16).cast("int")
    return F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), low)).otherwise(F.expr(f"cast(array() as {HASHES})"))


def _block_of(key: Column, bounds: Column) -> Column:
    """The number of the last bound up to a key, found among every so many bounds and then among those that follow it."""
    coarse = F.size(F.filter(bounds, lambda b: b[0] <= key)) - 1
    fine = F.size(F.filter(F.get(bounds, coarse), lambda b: b <= key)) - 1
    return coarse * F.size(F.get(bounds, F.lit(0))) + fine


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, block, real, key, text) in blocks, dealt out by block: in a block ordered by real, the falsest last, and key, each
    real row is followed by the next one in descending order of id, and the last row of all by the first."""
    mine = F.coalesce(F.col(text), F.lit(""))
    # Rising keys: null ids last, ids descending (the complement of an integer descends and can't overflow).
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.coalesce(F.bitwise_not(F.col(doc_id).cast("long")), F.lit(0)).alias("turned"), F.xxhash64(mine).alias("hash"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), mine.alias("text"), key.alias("key"))
    keys = cut(rows.select("key", F.octet_length("text").alias("bytes")))
    count, size = keys.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    each = max(min(BLOCK_ROWS, BLOCK_BYTES * count // max(size or 1, 1)), -(-count // BLOCKS), 1)
    placed, paths = numbering.numbered(keys.select("key"), ["key"], "place")
    heads = cut(placed.where(F.col("place") % each == 0).select("key").distinct())
    for path in paths:
        tables.remove(path)
    n = heads.count()
    if not n:
        return rows.select("id", F.lit(0).alias("block"), F.lit(True).alias("real"), "key", "text")
    bounds, _ = numbering.numbered(heads, ["key"], "block")
    bounds = cut(bounds)
    width = max(1, int(n**0.5))
    runs = bounds.groupBy(F.floor(F.col("block") / width).alias("run")).agg(F.array_sort(F.collect_list("key")).alias("keys"))
    # One row with all bounds, at most BLOCKS of them: a scalar subquery, so that no join moves texts.
    every = runs.agg(F.transform(F.array_sort(F.collect_list(F.struct("run", "keys"))), lambda r: r["keys"]).alias("bounds")).scalar()
    real = rows.withColumn("bounds", every).select("id", _block_of(F.col("key"), F.col("bounds")).cast("long").alias("block"), F.lit(True).alias("real"), "key", "text")
    firsts = rows.join(F.broadcast(bounds), "key").groupBy("block").agg(F.first("id").alias("id"), F.first("key").alias("key"), F.first("text").alias("text"))
    guests = firsts.select("id", F.pmod(F.col("block") - 1, F.lit(n)).alias("block"), F.lit(False).alias("real"), "key", "text")
    return real.unionByName(guests).repartition("block")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, n: int = N) -> DataFrame:
    """Rows (id, text, sketch, next_text, next_sketch): each document with the next one in descending order of id."""
    order = Window.partitionBy("block").orderBy(F.col("real").desc(), "key")
    rows = with_sketch(neighbours(docs, doc_id, text), "text", "sketch", k, n)
    rows = rows.withColumns({"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)})
    return rows.where("real").select("id", "text", "sketch", "next_text", "next_sketch")


def edited(found: DataFrame, k: int = K, n: int = N) -> DataFrame:
    """The columns of the contract: the last third of each text is replaced by the beginning of the next."""
    size = F.char_length("text")
    third = F.floor(size / 3).cast("int")
    changed = F.concat(F.substring(F.col("text"), F.lit(1), size - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = with_sketch(found.select("id", size.cast("long").alias("n_chars"), "sketch", "next_sketch", changed.alias("edited")), "edited", "edited_sketch", k, n)
    return rows.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"), resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
