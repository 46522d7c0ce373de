"""Bottom-k sketches and edited texts against plain Python: the same hashes by another library, sets for the likeness."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from lineweave.llm import queries, sketch


def spark_hash(words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def shingles(text, n=sketch.N):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def brute_sketch(text, k=sketch.K, n=sketch.N):
    return sorted(map(spark_hash, shingles(text, n)))[:k]


def brute_resemblance(a, b, k=sketch.K):
    if not a and not b:
        return 1.0
    union = sorted({*a, *b})[:k]
    return len(set(a) & set(b) & set(union)) / len(union)


def hexed(a):
    return "".join(f"{h & (1 << 64) - 1:016x}" for h in a)


def want(rows):
    """rows: (doc_id, text) with distinct ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    found = {}
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        a, b, c = brute_sketch(text), brute_sketch(changed), brute_sketch(after)
        found[doc] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), hexed(a), hexed(b), brute_resemblance(a, b), brute_resemblance(a, c))
    return found


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op11_bottom_k"](spark, sf).collect()}
    assert got == want(rows)


@pytest.mark.parametrize("rows_of_block", [1, 3, 1000])
def test_next_documents_across_blocks(spark, monkeypatch, rows_of_block):
    monkeypatch.setattr(sketch, "BLOCK_ROWS", rows_of_block)
    rng = random.Random(3)
    ids = [*rng.sample(range(-500, 500), 60), -(1 << 63), (1 << 63) - 1, None]
    rows = [(i, " ".join(rng.choice("a bb ccc é 漢字".split()) for _ in range(rng.randint(0, 20)))) for i in ids] + [(777, None)]
    rows = [r for k, r in enumerate(rows) if r[0] not in [x[0] for x in rows[:k]]]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, key int, block int").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in sketch.edited(sketch.fingerprints(docs)).collect()}
    assert got == want(rows)


def test_estimates_are_near_what_they_estimate(spark):
    rng = random.Random(1)
    base = [str(rng.randrange(10**6)) for _ in range(4000)]
    pairs = [(" ".join(base), " ".join(base[: 4000 - cut] + [str(rng.randrange(10**6)) for _ in range(more)])) for cut, more in ((0, 0), (500, 500), (2000, 0), (2000, 2000), (3800, 100))]
    df = spark.createDataFrame(pairs, "a string, b string")
    df = sketch.with_sketch(sketch.with_sketch(df, "a", "sa"), "b", "sb")
    a, b = F.col("sa"), F.col("sb")
    got = df.select("a", "b", sketch.resemblance(a, b).alias("r"), sketch.containment(b, a).alias("c"), sketch.distinct(a).alias("n")).collect()
    for r in got:
        x, y = shingles(r["a"]), shingles(r["b"])
        assert r["r"] == pytest.approx(len(x & y) / len(x | y), abs=0.12)
        assert r["c"] == pytest.approx(len(x & y) / len(y), abs=0.25)
        assert r["n"] == pytest.approx(len(x), rel=0.25)


def test_parts_merge_to_the_whole(spark):
    words = [str(i * i % 10007) for i in range(9500)]
    parts = [" ".join(words[a : a + 1000 + sketch.N - 1]) for a in range(0, 9500, 1000)]
    rows = [("x", p) for p in parts] + [(None, "alone and only"), ("none", "")]
    df = sketch.with_sketch(spark.createDataFrame(rows, "g string, t string"), "t", "s")
    got = {r["g"]: r["s"] for r in sketch.merged(df, ["g"], "s").collect()}
    assert got == {"x": brute_sketch(" ".join(words)), None: brute_sketch("alone and only"), "none": []}
    whole = sketch.with_sketch(spark.createDataFrame([(" ".join(words),)], "t string"), "t", "s").select("s", sketch.from_text(sketch.as_text(F.col("s"))).alias("back")).first()
    assert whole["s"] == got["x"] == whole["back"]


def test_defined_cases(spark):
    one = spark.createDataFrame([(7, "a b c d e f")], "doc_id long, text string")
    row = sketch.edited(sketch.fingerprints(one)).first()
    assert row["n_chars"] == 11 and row["near_next"] == 1.0
    assert row["edited_sha256"] == hashlib.sha256(b"a b c d a b").hexdigest()
    assert sketch.edited(sketch.fingerprints(one.limit(0))).count() == 0
    same = spark.createDataFrame([(1, "x y z"), (1, "x y z"), (1, "x y"), (2, None), (2, "")], "doc_id long, text string")
    got = sketch.edited(sketch.fingerprints(same)).collect()
    assert len(got) == 5 and len({r["fingerprint"] for r in got if r["n_chars"] == 5}) == 1
    assert sum(r["near_next"] == 1.0 for r in got) == 2
    long = spark.createDataFrame([(1, "w " * 300_000), (2, "q" * 1_000_000)], "doc_id long, text string")
    assert sorted((r["n_chars"], r["near_edited"]) for r in sketch.edited(sketch.fingerprints(long)).collect())[0] == (600_000, 0.5)
