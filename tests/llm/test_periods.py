"""Runs against brute force: every stretch and period looked at one by one."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lineweave.llm import periods, queries


def brute(word, least=2, shortest=2):
    n, found = len(word), {}
    for q in range(1, n // least + 1):
        s = 0
        while s + q < n:
            t = s + q
            while t < n and word[t] == word[t - q]:
                t += 1
            if t - s >= max(least * q, shortest):
                found.setdefault((s, t), q)
            s = t - q + 1
    return sorted(((s, t, q) for (s, t), q in found.items()), key=lambda r: (r[0], r[2]))


def sequences():
    rng = random.Random(5)
    fibonacci = [0]
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(200)]
    yield from ([], [0], [0] * 7, fibonacci, b, thue, [0, 1] * 40, [0, 0, 1] * 5 + [0, 1] * 9, list(range(30)) * 4)
    for k in range(1500):
        size, letters = rng.randint(1, 60), rng.randint(1, 4)
        yield [rng.randrange(letters) for _ in range(size)]
    for k in range(300):  # blocks of blocks
        base = [rng.randrange(3) for _ in range(rng.randint(1, 8))]
        inner = base * rng.randint(1, 5) + [rng.randrange(4) for _ in range(rng.randint(0, 3))]
        yield [rng.randrange(3) for _ in range(rng.randint(0, 6))] + inner * rng.randint(1, 6) + [rng.randrange(3) for _ in range(rng.randint(0, 6))]


@pytest.mark.parametrize("least, shortest", [(2, 2), (3, 4), (4, 6)])
def test_runs_as_by_brute_force(least, shortest):
    for word in sequences():
        assert periods.runs(word, least, shortest) == brute(word, least, shortest), word


def test_factors_are_longest_earlier_stretches():
    for word in list(sequences())[:400]:
        at = 0
        for start, end, earlier in periods.factors(word):
            assert start == at
            longest = max((next((k for k in range(len(word) - start) if word[e + k] != word[start + k]), len(word) - start) for e in range(start)), default=0)
            assert end - start == max(longest, 1)
            assert (earlier < 0) == (longest == 0)
            if earlier >= 0:
                assert earlier < start and word[earlier : earlier + end - start] == word[start:end]
            at = end
        assert at == len(word)


def test_stretches_hold_every_run():
    rng = random.Random(8)
    for _ in range(200):
        batch = []
        for _ in range(rng.randint(0, 6)):
            w = [b"%d" % rng.randrange(6) for _ in range(rng.randint(0, 30))]
            batch.append(w + (w[:3] or [b"x"]) * rng.randint(0, 6) + [b"%d" % rng.randrange(50) for _ in range(rng.randint(0, 9))])
        assert periods.runs_of_texts(batch) == [brute(w, 4, 6) for w in batch]


def test_long_texts_take_time_in_proportion():
    words = [b"%d" % (i * i % 997) for i in range(60_000)]
    assert len(periods.runs_of_texts([words * 4])[0]) >= 1
    assert periods.runs([0] * 200_000, 4, 6) == [(0, 200_000, 1)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words, 4, 6)
    drop = {i for s, t, q in found for i in range(s + q, t)}
    top = min(((s - t, s, q) for s, t, q in found), default=None)
    first = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(found), *first, digest("".join(f"{s},{t - s},{q}\n" for s, t, q in found)), digest(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op12_word_runs"](spark, sf).collect()
    assert len(got) == len(texts) and sum(r["n_runs"] for r in got) > 10
    for r in got:
        if len((texts[r["doc_id"]] or "").split()) < 1500:
            assert tuple(r)[1:] == expected(r["doc_id"], texts[r["doc_id"]]), r["doc_id"]


def test_defined_cases(spark):
    rows = [(None, "a " * 9, 1), (1, None, 1), (2, "", 1), (3, " \t\n", 1), (4, "x y " * 8, 1), (4, "x y " * 8, 1), (5, "    b", 1), (6, "w" * 500_000 + " v" * 7, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r["id"], r["n_words"], [tuple(x) for x in r["runs"]]) for r in periods.find_runs(docs).collect()), key=str)
    assert got == sorted(
        [(None, 9, [(0, 9, 1)]), (1, 0, []), (2, 0, []), (3, 0, []), (4, 16, [(0, 16, 2)]), (4, 16, [(0, 16, 2)]), (5, 3, []), (6, 8, [(1, 7, 1)])], key=str
    )
    assert periods.run_digests(periods.find_runs(docs.limit(0))).count() == 0
    assert np.all([r["collapsed"] == "x y" for r in periods.find_runs(docs).where("id = 4").collect()])
