"""The similarity join, the search and the pipeline against brute force."""

import collections
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lineweave.llm import ann, graph, jaccard

import corpus_pipeline


def brute(rows, n, percent):
    """(set size, component) of each id, by comparing all pairs that share a shingle."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = frozenset(tuple(w[a : a + n]) for a in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    by, shared, top = collections.defaultdict(list), collections.Counter(), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    for ids in by.values():
        shared.update((b, a) for k, a in enumerate(ids) for b in ids[:k])

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, b), c in shared.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (2, 60)])
def test_join_loses_no_component(spark, n, percent):
    rng = random.Random(n)
    word = lambda: rng.choice("abcdefghij") + rng.choice("xyz")
    base = [[word() for _ in range(rng.randint(0, 60))] for _ in range(30)]
    rows = []
    for i in range(500):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            if w:
                w[rng.randrange(len(w))] = word() + "q"
        rows.append((i * 3 + 1, " ".join(w).upper() if i % 7 == 0 else " ".join(w)))
    rows += [(9000, None), (9001, ""), (9002, " \t"), (9003, "two words"), (9004, "Two  words"), (9005, "word " * 40_000)]
    df = spark.createDataFrame([*rows, rows[3], rows[3], (None, "a b c d")], "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("token", F.lit(0))
    found = jaccard.near_duplicates(df, n, percent).collect()
    assert len(found) == len(rows) + 3
    expected = brute(rows, n, percent)
    for r in found:
        if r["id"] is None:
            assert (r["n_shingles"], r["component"]) == (max(1, 5 - n), None)
        else:
            assert (r["n_shingles"], r["component"]) == expected[r["id"]]


def test_join_of_nothing(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_group_of_near_copies_is_one_component(spark):
    base = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join([*base[: i % 200], f"e{i}", *base[i % 200 + 1 :]]) if i else " ".join(base)) for i in range(300)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    assert {r["component"] for r in found.collect()} == {0}


def dense(rows, n, percent):
    """The components of many texts by a product of their 0/1 vectors of shingles."""
    sets = [{tuple(w[a : a + n]) for a in range(len(w) - n + 1)} for w in (t.split() for _, t in rows)]
    place = {x: k for k, x in enumerate(set().union(*sets))}
    m = np.zeros((len(rows), len(place)), dtype=np.float32)
    for i, s in enumerate(sets):
        m[i, [place[x] for x in s]] = 1
    both, size = m @ m.T, m.sum(axis=1)
    linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    top, left = {}, set(range(len(rows)))
    for i in range(len(rows)):
        if i in left:
            reached = todo = {i}
            while todo:
                todo = set(np.flatnonzero(linked[sorted(todo)].any(axis=0)).tolist()) - reached
                reached = reached | todo
            left -= reached
            top |= {rows[k][0]: rows[min(reached)][0] for k in reached}
    return top, int(linked.sum())


def test_large_group_of_near_copies_that_do_not_all_link(spark):
    """2,000 copies of one text with few to many changes that often recur, so that links run by all kinds of ways."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(2000):
        w = list(base)
        for _ in range(rng.choice([0, 2, 3, 4, 5, 6, 8])):
            k = rng.randrange(24) * 5
            w[k] = f"e{rng.randrange(3)}"
        del w[: rng.choice([0, 0, 0, 4, 9])]
        rows.append((i, " ".join(w)))
    expected, pairs = dense(rows, 5, 80)
    parts = collections.Counter(expected.values())
    assert 50 < len(parts) and max(parts.values()) < 1950 and pairs > 100_000
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert {r["id"]: r["component"] for r in found} == expected


def test_texts_that_share_one_of_two_passages(spark):
    rng = random.Random(12)
    passages = [" ".join(f"p{k}x{j}" for j in range(60)) for k in range(12)]
    rows = [(i, f"{passages[(k := rng.randrange(12))]} {passages[(k + 1 + rng.randrange(3)) % 12]}" + " and more" * rng.randrange(4)) for i in range(600)]
    for percent in (50, 80):
        found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, percent).collect()
        assert {r["id"]: r["component"] for r in found} == dense(rows, 3, percent)[0]


def test_candidates_of_a_group_grow_with_it(spark, monkeypatch):
    """Candidate pairs with different homes, in groups of one and four times the size: no square in it."""
    counts = []
    across = jaccard._across_homes
    monkeypatch.setattr(jaccard, "_across_homes", lambda *a: counts.append(across(*a).count()) or across(*a))
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    for size in (300, 1200):
        rows = []
        for i in range(size):
            w = list(base)
            for k in rng.sample(range(120), 5):
                w[k] = f"e{rng.randrange(10**6)}"
            rows.append((i, " ".join(w)))
        jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).count()
    assert counts[1] <= 4 * counts[0] + 50


def test_frequency_class_never_falls():
    c = np.arange(1, 200_000)
    assert (np.diff(jaccard.frequency_class(c).astype(int)) >= 0).all()


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5, 5), (None, 3)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        if a is not None:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {x: find(x) for x in top}


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(1 << (dims * bits)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    x[50:60] = x[49]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [float("inf")] + [1.0] * 15), (1004, [1.0]), (None, [1.0] * 16), (1005, [None] + [1.0] * 15), (1020, []), (3, x[3].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("v", F.lit(0))
    found = ann.nearest(df, F.col("id") % 20 == 0, k=10, window=0.4, block=64).collect()
    d = x.astype(np.float64)
    hits = 0
    for q in range(0, 900, 20):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and all(m[1] != q for m in mine)
        scores = d @ d[q]
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in mine)
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        best = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:10]
        hits += len({v for _, v, _ in mine} & set(best))
    assert hits >= 0.9 * 450 and {r["query_id"] for r in found} == set(range(0, 900, 20))
    few = ann.nearest(df.where("vec_id < 4"), F.col("id") % 20 == 0, k=10).collect()
    assert [r["rank"] for r in sorted(few)] == [1, 2, 3]
    assert ann.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_pipeline_stages_keep_columns_and_decide(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    copies = docs.where("doc_id < 40").unionByName(docs.where("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 10_000))
    one = stages["n-gram Jaccard join"](spark, copies, sf)
    assert one.columns == docs.columns and one.where("doc_id >= 10000").count() == 0
    rows = [(r["doc_id"], r["text"]) for r in copies.collect()]
    assert {r["doc_id"] for r in one.collect()} == {c for _, c in brute(rows, 5, 80).values()} | {i for i, (n, _) in brute(rows, 5, 80).items() if n == 0}
    mixed = stages["mixing sources to target weights"](spark, docs, sf)
    assert mixed.columns == docs.columns and 0 < mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
    ends = stages["byte-level BPE encoding and decoding"](spark, docs, sf).join(docs, "doc_id")
    assert ends.where("decoded_sha256 <> sha2(cast(text as binary), 256)").count() == 0 and ends.count() == docs.count()
    assert stages["secret scans"](spark, docs, sf).count() == docs.count()


def test_an_id_with_several_texts_loses_near_copies_only(spark):
    words = lambda a: " ".join(f"w{a}x{k}" for k in range(40))
    rows = [(1, words(1), "x"), (1, words(2) + " and more words that make it long", "x"), (2, words(1), "x"), (3, words(3), "x"), (3, words(3), "y"), (3, words(3), "x"), (4, None, "x"), (5, "", "x"), (None, words(1), "z")]
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    seen = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string").repartition(3)
        seen.append(sorted(map(repr, stage(spark, docs, "").collect())))
    assert seen[0] == seen[1]
    left = [(r.split("text=")[0], r.split("text=")[1][:6]) for r in seen[0]]
    assert left == sorted([("Row(doc_id=1, ", "'w1x0 "), ("Row(doc_id=1, ", "'w2x0 "), ("Row(doc_id=3, ", "'w3x0 "), ("Row(doc_id=4, ", "None, "), ("Row(doc_id=5, ", "'', so"), ("Row(doc_id=None, ", "'w1x0 ")])


def test_queries_at_the_ends_of_a_curve_meet_their_full_share(spark):
    x = np.random.default_rng(9).standard_normal((600, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    met = ann.nearest(df, F.col("id") % 5 == 0, k=600, curves=1, window=0.4, block=10).groupBy("query_id").count().collect()
    assert len(met) == 120 and min(r["count"] for r in met) >= 170  # 250 places in all, at most 120 of them of queries, evenly spread


@pytest.mark.parametrize("clusters", [None, 40])
def test_recall_of_the_default_parameters(spark, clusters):
    """20,000 vectors of 64 dimensions, isotropic or in clusters with uneven norms, with the parameters of the query."""
    rng = np.random.default_rng(21)
    x = rng.standard_normal((20_000, 64))
    if clusters:
        x = (rng.standard_normal((clusters, 64))[rng.integers(0, clusters, len(x))] + 0.4 * x) * rng.uniform(0.5, 1.5, len(x))[:, None]
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist()}))
    found = ann.nearest(df, F.col("id") % 20 == 0).toPandas()
    asked = np.arange(0, len(x), 20)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    got = found.groupby("query_id")["vec_id"].agg(set)
    assert len(found) == 20 * len(asked)
    recall = np.mean([len(got[q] & set(b)) / 20 for q, b in zip(asked.tolist(), best.tolist())])
    print(f"recall {recall:.3f}")
    assert recall >= 0.9
