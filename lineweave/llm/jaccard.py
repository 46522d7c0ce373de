"""Near duplicates by Jaccard similarity of word shingles: an exact prefix-filter join with adaptive multi-match prefixes.

Two texts are linked when ``100 * intersection >= percent * union`` of their sets of shingles. The join finds every link
between different components (exact copies are one class from the start):

1. Equal texts become one class, named by its smallest id.
2. Texts are dealt into blocks. A block sorts the hashes of its shingles into buckets of hash space; a bucket counts in
   how many texts each of its hashes is and answers every block in the same order, one byte for each. So each block knows
   the document frequency of all its shingles at a few bytes of shuffle for each, with no table of them anywhere.
3. A text orders its shingles from rare to frequent (ties by hash: the same order for all texts). Of n shingles at least
   o = ceil(percent * n / 100) are shared with any partner, so two linked texts share at least k of their first
   n - o + k shingles, for every k. The text takes the k, and with it the prefix, for which the estimated cost (shingles'
   frequencies for probing, those over k for verification) is least. A pair then needs min(k, k') shared prefix shingles.
   Shingles that are in one text only link nothing and go no further.
4. Texts of about one size that share a prefix shingle first meet its leader, the one among them with the fewest shingles
   of its own; each verifies the leader that it meets most. That joins most of a group of near copies to what they are
   copies of, at a cost in proportion to the group. The most typical leader that a text meets, or that leader's own, is its
   home, and what the two don't share is kept.
5. Of texts with one home, those not linked with it are joined with the others by their differences from it, which tell
   similarities exactly (``_by_differences``): texts that are near the same text but not near each other don't meet.
6. Texts with different homes that share enough prefix shingles are verified on the full sets, unless sizes and unshared
   shingles rule them out or one component holds both.
7. The links' connected components give the classes.

Links inside a component that steps 4 to 6 never verify change nothing in the result. No cap drops any candidate.

Defined cases: null and empty texts and texts without words have no shingles and stay alone; texts with fewer words than
a shingle have their whole sequence as one; rows may repeat (each gives a row); if an id comes with several texts, the
one that is longest (then largest by hash) stands for all its rows; rows with a null id give rows with a null component
and link nothing; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm.common import cut, shingle_hashes, slices, small_batches, word_hashes, written
from lineweave.llm.graph import components
from lineweave.operators.tables import SMALL, beside

BLOCK_BYTES, BUCKET = 3 << 20, 1 << 20
VERIFY = 8.0


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(shingle_hashes(word_hashes(np.frombuffer(text, dtype=np.uint8))[2], n))


# ---- document frequencies ---------------------------------------------------------------------------------------


def frequency_class(count: np.ndarray) -> np.ndarray:
    """A byte that never falls as the count rises: exact up to 32, then eight steps to a doubling."""
    return np.minimum(255, np.where(count <= 32, count, 32 + np.ceil(8 * np.log2(np.maximum(count, 1) / 32)))).astype(np.uint8)


_COUNTS = np.array([*range(33), *(32 * 2 ** (np.arange(1, 224) / 8))])


def _block_sets(docs: pa.Table, wanted: set, n: int) -> tuple[list, list[np.ndarray]]:
    """Ids, ascending, and sets of the wanted texts of a block."""
    found = {}
    for i, h, t in zip(docs.column("id").to_pylist(), docs.column("h").to_pylist(), docs.column("text").to_pylist()):
        if (i, h) in wanted and i not in found:
            found[i] = shingle_set((t or "").encode(), n)
    ids = sorted(found)
    return ids, [found[i] for i in ids]


def _buckets(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the buckets of ascending hashes, and where each begins, the end included."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    number = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    at = np.flatnonzero(np.diff(number, prepend=-1))
    return number[at], np.append(at, len(hashes))


def _send(n: int, bits: int):
    def send(key: tuple, docs: pa.Table, reps: pa.Table) -> pa.Table:
        wanted = set(zip(reps.column("id").to_pylist(), reps.column("h").to_pylist()))
        _, sets = _block_sets(docs, wanted, n)
        every = np.sort(np.concatenate([np.zeros(0, np.uint64), *sets]))
        number, at = _buckets(every, bits)
        rest = (every << np.uint64(bits) >> np.uint64(32)).astype("<u4")
        data = [zlib.compress(np.diff(rest[a:b], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes(), 1) for a, b in zip(at, at[1:])]
        return pa.table({"block": pa.array([key[0].as_py()] * len(number), pa.int64()), "bucket": pa.array(number, pa.int64()), "data": pa.array(data, pa.binary())})

    return send


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel(), dtype=np.uint32)


def _count(key: tuple, parts: pa.Table) -> pa.Table:
    lists = [_unpack(x) for x in parts.column("data").to_pylist()]
    _, where, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    classes = frequency_class(count)[where]
    at = np.cumsum([0, *map(len, lists)])
    data = [zlib.compress(classes[a:b].tobytes(), 1) for a, b in zip(at, at[1:])]
    return pa.table({"block": parts.column("block"), "bucket": parts.column("bucket"), "data": pa.array(data, pa.binary())})


# ---- prefixes ---------------------------------------------------------------------------------------------------


def prefix(hashes: np.ndarray, classes: np.ndarray, percent: int) -> tuple[int, np.ndarray]:
    """How many prefix shingles a partner must share, and the prefix's shingles that are in other texts too."""
    n = len(hashes)
    order = np.lexsort((hashes, classes))
    others = _COUNTS[classes[order]] - 1
    need = -(-percent * n // 100)
    sums = np.cumsum(others)[n - need :]
    k = int(np.argmin(sums * (1 + VERIFY / np.arange(1, need + 1)))) + 1
    first = order[: n - need + k]
    return k, hashes[first][classes[first] > 1]


SETS = "id long, n int, k int, rare int, tokens array<long>, shingles binary"
_SETS = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("k", pa.int32()), ("rare", pa.int32()), ("tokens", pa.list_(pa.int64())), ("shingles", pa.binary())])


def _prefixes(n: int, bits: int, percent: int):
    def choose(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        rows = told.to_pylist()
        wanted = {(r["id"], r["h"]) for r in rows if r["id"] is not None}
        ids, sets = _block_sets(docs, wanted, n)
        every = np.concatenate([np.zeros(0, np.uint64), *sets])
        order = np.argsort(every, kind="stable")
        number, at = _buckets(every[order], bits)
        answer = {r["bucket"]: r["data"] for r in rows if r["bucket"] is not None}
        classes = np.empty(len(every), dtype=np.uint8)
        for b, x, y in zip(number.tolist(), at, at[1:]):
            classes[order[x:y]] = np.frombuffer(zlib.decompress(answer[b]), np.uint8)
        out, a = [], 0
        for i, s in zip(ids, sets):
            mine = classes[a : a + len(s)]
            k, tokens = prefix(s, mine, percent) if len(s) else (0, s)
            a += len(s)
            out.append({"id": i, "n": len(s), "k": k, "rare": int((mine == 1).sum()), "tokens": tokens.view(np.int64).tolist(), "shingles": s.astype("<u8").tobytes() if len(tokens) else None})
        return pa.Table.from_pylist(out, schema=_SETS)

    return choose


# ---- the join ---------------------------------------------------------------------------------------------------


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "x"):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = beside(cut(pairs))
    held = sets.where("shingles is not null")
    left = held.select(F.col("id").alias("a"), F.col("shingles").alias("x")).join(pairs, "a")
    right = held.select(F.col("id").alias("b"), F.col("shingles").alias("y")).join(pairs.select("b"), "b", "left_semi")
    return left.join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _near(percent: int) -> str:
    """Whether two set sizes allow a link at all."""
    return f"100 * least(n, m) >= {percent} * greatest(n, m)"


def _possible(percent: int) -> str:
    """Whether two set sizes allow a link when the shingles that no other text has are not shared."""
    most = "least(n - rare, m - r)"
    return f"100 * {most} >= {percent} * (n + m - {most})"


HOMES = "id long, n long, home long, hn long, differ long, differences array<long>, linked boolean"
_HOMES = pa.schema(
    [("id", pa.int64()), ("n", pa.int64()), ("home", pa.int64()), ("hn", pa.int64()), ("differ", pa.int64()), ("differences", pa.list_(pa.int64())), ("linked", pa.bool_())]
)


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For pairs (id, home) what is in one set and not in the other, and whether they link.

    A text that differs from its home in more shingles than it has becomes a home of its own.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "x"):
            rows = []
            for i, home, x, y in zip(*(batch.column(c).to_pylist() for c in ("id", "home", "x", "y"))):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                apart = np.setxor1d(x, y, assume_unique=True)
                linked = (100 + percent) * len(apart) <= (100 - percent) * (len(x) + len(y))
                rows.append((i, len(x), home, len(y), len(apart), apart.view(np.int64).tolist(), linked) if len(apart) <= len(x) else (i, len(x), i, len(x), 0, [], linked))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(_HOMES.types)], schema=_HOMES)

    held = sets.where("shingles is not null")
    counts = cut(pairs.groupBy("home").agg(F.count(F.lit(1)).alias("c")))
    theirs = held.join(beside(counts.select(F.col("home").alias("id"))), "id").select(F.col("id").alias("home"), F.col("shingles").alias("y"))
    full = _joined(held.select("id", F.col("shingles").alias("x")).join(beside(pairs), "id"), theirs, _hot(counts, pairs.count()))
    return full.select("id", "home", "x", "y").mapInArrow(compare, HOMES)


def _hot(counts: DataFrame, total: int) -> DataFrame:
    """The homes, at most 1,000, that hold a thousandth of all rows or more (and 512 at least); ``counts`` has their rows as c."""
    return F.broadcast(counts.where(F.col("c") >= max(512, -(-total // 1000))).select("home", F.lit(True).alias("hot")))


def _joined(rows: DataFrame, values: DataFrame, hot: DataFrame, salts: int = 64) -> DataFrame:
    """Rows with the one row of ``values`` for their home; the rows of hot homes are spread."""
    salted = rows.join(hot, "home", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(salts))).otherwise(0)).drop("hot")
    every = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    copies = values.join(hot, "home", "left").withColumn("salt", every).drop("hot")
    return salted.withColumn("salt", F.col("salt").cast("int")).join(copies, ["home", "salt"]).drop("salt")


def _met(entries: DataFrame, percent: int) -> DataFrame:
    """Rows (id, n, rare, v, leader, m, r, o, c): how many prefix shingles a text shares with each leader that it meets.

    Of a shingle's texts of about one size the leader is the most typical, with the fewest shingles that no other text
    has. Bands of size are laid twice, half a band apart, so that texts of near sizes share at least one.
    """
    band = F.log("n") / float(np.log(100 / min(percent, 99)))
    bands = F.explode(F.array(*(F.struct(F.lit(v).alias("v"), F.floor(band + v / 2).alias("band")) for v in (0, 1)))).alias("at")
    banded = entries.select("token", "id", "n", "rare", bands).select("token", "id", "n", "rare", "at.v", "at.band")
    by = F.struct(F.col("rare").alias("r"), F.xxhash64("id").alias("o"), F.col("id").alias("leader"), F.col("n").alias("m"))
    leaders = banded.groupBy("token", "v", "band").agg(F.min(by).alias("l"), F.count(F.lit(1)).alias("c")).where("c > 1").select("token", "v", "band", "l.*")
    met = banded.join(leaders, ["token", "v", "band"]).where(f"id <> leader and {_near(percent)}")
    return met.groupBy("id", "n", "rare", "v", "leader", "m", "r", "o").agg(F.count(F.lit(1)).alias("c"))


def _homes(met: DataFrame, jumps: int = 2) -> DataFrame:
    """Pairs (id, home): the most typical leader that a text meets, or that one's, and so on for 2 ** jumps steps."""
    own = F.struct(F.col("rare").alias("r"), F.xxhash64("id").alias("o"), F.col("id").alias("leader"))
    first = met.groupBy("id", "rare").agg(F.min(F.struct("r", "o", "leader")).alias("h"))
    homes = cut(first.select("id", F.least("h", own)["leader"].alias("home")).where("id <> home"))
    for _ in range(jumps):
        further = homes.select(F.col("id").alias("home"), F.col("home").alias("further"))
        homes = cut(homes.join(beside(further), "home", "left").select("id", F.coalesce("further", "home").alias("home")))
    return homes


def _by_differences(homes: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) between texts of one home and different components.

    Where D(x) is what x and the home don't share, D(x) and D(y) differ in exactly the shingles in which x and y do. So x
    and y link when D(x) and D(y) share at least ``need`` shingles, which is a join of its own among the differences of a
    home: what all its texts share is in none of them, and only what they changed alike brings two of them together.
    Two texts of a home that both link with it are in one component, so one of a pair is ``open``, not linked with the
    home. That bounds what the other, however close to the home it is, must share: more than half of its differences,
    about. Each is looked for under its rarest differences only, as many as leave less than its bound.
    """
    up, down = 100 + percent, 100 - percent
    named = homes.where("differ > 0").join(beside(found.withColumnRenamed("node", "id")), "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = cut(named.drop("linked"))
    # Homes that have texts of other components than their own.
    busy = named.groupBy("home").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("c"))
    busy = busy.join(beside(found.select(F.col("node").alias("home"), F.col("component").alias("top"))), "home", "left").withColumn("top", F.coalesce("top", "home"))
    busy = cut(busy.where("low <> top or high <> top").select("home", "top", "c"))
    few = busy.count()
    if not few:
        return found.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    of_home = named.join(F.broadcast(busy.drop("c")), "home") if few <= SMALL else _joined(named, busy.drop("c"), _hot(busy, named.count()))
    named = of_home.withColumn("open", F.col("component") != F.col("top")).drop("top")
    named = cut(named)
    tokens = named.select("home", "id", F.explode("differences").alias("token"))
    counts = tokens.groupBy("home", "token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    listed = tokens.join(counts, ["home", "token"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("l"))
    texts = cut(listed.select("id", F.col("l.token").alias("tokens")).join(beside(named.drop("differences")), "id").withColumn("m", F.size("tokens")))
    # A partner has at most 100 / percent times the shingles; what it shares it has among its own differences.
    least = F.ceil((up * F.col("differ") - down * (F.col("n") + F.floor(100 * F.col("n") / percent))) / up)
    partner = F.floor((up * F.col("differ") + down * (F.col("hn") - F.col("n"))) / (2 * up)) + 1

    def prefix(rows: DataFrame, bound, names: dict[str, str]) -> DataFrame:
        first = (F.col("m") - F.greatest(bound, F.lit(1)) + 1).cast("int")
        rows = rows.withColumn("first", first).where("first > 0").withColumn("rest", F.col("m") - F.col("first"))
        kept = ("id", "n", "differ", "m", "rest", "component", "open")
        return rows.select("home", F.explode(F.slice("tokens", F.lit(1), F.col("first"))).alias("token"), *(F.col(c).alias(names.get(c, c)) for c in kept))

    names = {"id": "other", "n": "n2", "differ": "differ2", "m": "m2", "rest": "rest2", "component": "component2", "open": "open2"}
    left, right = prefix(texts.where("open"), least, {}), prefix(texts, partner, names)
    need = F.greatest(F.ceil((up * (F.col("differ") + F.col("differ2")) - down * (F.col("n") + F.col("n2"))) / (2 * up)), F.lit(1)).cast("int")
    once = "(not open2 or struct(differ2, other) < struct(differ, id))"
    pairs = left.join(right, ["home", "token"]).where(f"component <> component2 and {once} and 100 * least(n, n2) >= {percent} * greatest(n, n2)").where(need <= F.least("m", "m2"))
    pairs = pairs.groupBy("id", "other").agg(F.count(F.lit(1)).alias("c"), F.max(need).alias("need"), F.max(F.greatest("rest", "rest2")).alias("rest")).where("c + rest >= need")
    pairs = beside(cut(pairs))
    theirs = texts.select(F.col("id").alias("other"), F.col("tokens").alias("tokens2")).join(pairs.select("other"), "other", "left_semi")
    both = texts.select("id", "tokens").join(pairs, "id").join(theirs, "other")
    return both.where(F.size(F.array_intersect("tokens", "tokens2")) >= F.col("need")).select(F.col("id").alias("a"), F.col("other").alias("b"))


def _across_homes(entries: DataFrame, homes: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (a, b) of texts with different homes and components: they share as many prefix shingles as must be."""
    marked = entries.join(beside(homes.select("id", "home")), "id", "left").join(beside(found.withColumnRenamed("node", "id")), "id", "left")
    marked = marked.withColumns({"home": F.coalesce("home", "id"), "component": F.coalesce("component", "id")})
    several = marked.groupBy("token").agg(*(f(c).alias(f"{n}_{c}") for c in ("home", "component") for n, f in (("low", F.min), ("high", F.max))))
    several = cut(several.where("low_home < high_home and low_component < high_component").select("token"))
    marked = cut(marked.join(beside(several), "token", "left_semi"))
    if marked.isEmpty():
        return marked.select(F.col("id").alias("a"), F.col("id").alias("b"))
    # Homes are paired first, so that texts of one home never meet here.
    at = marked.select("token", "home").distinct()
    sides = at.join(at.withColumnRenamed("home", "home2"), "token").where("home < home2")
    names = {"id": "other", "n": "m", "k": "j", "rare": "r", "component": "beside", "home": "home2"}
    right = marked.select("token", *(F.col(c).alias(d) for c, d in names.items()))
    pairs = marked.join(sides, ["token", "home"]).join(right, ["token", "home2"]).where(f"component <> beside and {_near(percent)} and {_possible(percent)}")
    pairs = pairs.groupBy(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min(F.least("k", "j")).alias("k"))
    return pairs.where("c >= k").select("a", "b")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) whose connected components are those of all links."""
    entries = cut(sets.where("size(tokens) > 0").select("id", F.col("n").cast("long").alias("n"), "k", F.col("rare").cast("long").alias("rare"), F.explode("tokens").alias("token")))
    met = cut(_met(entries, percent))
    best = met.where(_possible(percent)).groupBy("id", "v").agg(F.max_by("leader", F.struct("c", -F.col("r"), "leader")).alias("leader"))
    best = best.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
    homes = cut(_differences(_homes(met), sets, percent))
    # A text that became its own home may still be linked with the one that it met; no link is lost, as the pair has two homes then.
    first = cut(_verified(best, sets, percent).unionByName(homes.where("linked and id <> home").select(F.col("id").alias("a"), F.col("home").alias("b"))))
    found = components(first)
    return first.unionByName(_by_differences(homes, found, percent)).unionByName(_verified(_across_homes(entries, homes, found, percent), sets, percent))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_shingles, component): one for each row of ``docs``; ids are integers."""
    rows = small_batches(docs).select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = F.struct(F.octet_length("text").alias("size"), F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("c"))
    # Equal texts are one class; an id has one text.
    texts = cut(rows.where("id is not null").groupBy("id").agg(F.max(digest).alias("digest"), F.count(F.lit(1)).alias("copies")))
    size, most = texts.agg(F.coalesce(F.sum("digest.size"), F.lit(0)), F.coalesce(F.max("copies"), F.lit(0))).first()
    blocks = -(-size // BLOCK_BYTES) or 1
    bits = max(0, (size // 6 // BUCKET).bit_length())
    block = F.pmod(F.xxhash64("id", "h"), F.lit(blocks)).cast("long").alias("block")
    classes = texts.groupBy("digest").agg(F.min("id").alias("rep"))
    reps = classes.select(F.col("rep").alias("id"), F.col("digest.h").alias("h")).select(block, "id", "h")
    dealt = rows.where("id is not null").select("id", F.xxhash64("text").alias("h"), "text").select(block, "id", "h", "text")
    if most > 1:  # a repeated row must not make its block large
        dealt = dealt.groupBy("block", "id", "h").agg(F.first("text").alias("text"))
    sent = dealt.groupBy("block").cogroup(reps.groupBy("block")).applyInArrow(_send(n, bits), "block long, bucket long, data binary")
    told = sent.groupBy("bucket").applyInArrow(_count, "block long, bucket long, data binary")
    none = lambda t: F.lit(None).cast(t)
    told = reps.select("block", "id", "h", none("long").alias("bucket"), none("binary").alias("data")).unionByName(told.select("block", none("long").alias("id"), none("long").alias("h"), "bucket", "data"))
    sets = written(dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_prefixes(n, bits, percent), SETS), "sets")
    found = components(links(sets, percent)).select(F.col("node").alias("rep"), "component")
    named = classes.join(sets.select(F.col("id").alias("rep"), "n"), "rep").join(found, "rep", "left")
    out = texts.join(named, "digest").select("id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("id")).alias("component"), "copies")
    out = out.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copy", "copies")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes = [len(shingle_set(t.encode(), n)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.nulls(len(sizes), pa.int64())], names=["id", "n_shingles", "component"])

    return out.unionByName(rows.where("id is null").mapInArrow(alone, "id long, n_shingles long, component long"))


# The same rows by comparing all pairs that share a shingle and whose sizes allow a link.
ORACLE = r"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as l from documents
), s as (
    select doc_id, case when len(l) = 0 then [] when len(l) < 3 then [array_to_string(l, ' ')]
        else list_distinct(list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2])) end as x from w
), e as (
    select doc_id, len(x) as n, unnest(x) as x from s
), p as (
    select a.doc_id as a, b.doc_id as b, any_value(a.n + b.n) as n, count(*) as c from e a join e b using (x)
    where a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) group by 1, 2
), k as (
    select a, b from p where 100 * c >= 90 * (n - c) union all select b, a from p where 100 * c >= 90 * (n - c)
), r as (
    select doc_id as a, doc_id as b from s union select r.a, k.b from r join k on k.a = r.b
)
select doc_id, len(any_value(x))::bigint as n_shingles, min(r.b) as component_id from s join r on r.a = doc_id group by 1
"""
