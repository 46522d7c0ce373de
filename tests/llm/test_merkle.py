"""The manifest against a plain build of the same trees."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lineweave.llm import merkle, queries

H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return H(*(field(row[c]) for c in ("doc_id", "source", "lang", "n_chars")), field(text))


def tree(nodes):
    """The top, and for each node the siblings left and right of it, level by level."""
    proofs, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = nodes[at - at % 3 : at - at % 3 + 3]
            proofs[i].append((run[: at % 3], run[at % 3 + 1 :]))
            where[i] = at // 3
        nodes = [H(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def want(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, above = tree([tops[s][0] for s in order]) if order else (None, [])
    found = []
    for s, more in zip(order, above):
        for (_, _, own, r), proof in zip(sorted(groups[s], key=lambda x: x[:3]), tops[s][1]):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            node = leaf(r, r["text"].replace("\n", "") if tampered and r["text"] is not None else r["text"])
            for left, right in [*proof, *more]:
                node = H(*left, node, *right)
            said = H(*(d for left, right in [*proof, *more] for d in [*left, *right]))
            found.append((r["doc_id"], own, tops[s][0], root, said, node, node == root))
    return sorted(found, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_query_against_a_plain_build(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op13_merkle_manifest"](spark, sf)
    assert found.columns == COLUMNS
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == want(spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 4, 30])
def test_sizes_nulls_ties_and_extra_columns(spark, n):
    rows = [(k % 11 if k % 7 else None, [None, "", "a", "é", "b"][k * k % 5], None if k % 3 else "en", k % 4, [None, "", "x\ny", "z\n"][k % 4], 1, 2, "no") for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, tree int, place int, digest string")
    got = merkle.verdicts(merkle.checked(docs)).collect()
    assert sorted(map(tuple, got), key=str) == want(docs.collect())


def test_each_tampered_digest_breaks_its_own_proof_only(spark):
    docs = spark.createDataFrame([(k, "s", f"t{k}") for k in range(40)], "id long, g string, t string")
    found = merkle.manifest(docs.select("id", "g", F.sha2("t", 256).alias("leaf")), "g", ["id"]).collect()
    assert len({r["root"] for r in found}) == 1 and all(len(r["proof"]) == 4 for r in found)
    df = spark.createDataFrame([(r["id"], r["leaf"], r["root"], r["proof"]) for r in found], f"id long, leaf string, root string, proof {merkle.STEP}")
    ok = df.select("id", (merkle.fold(F.when(F.col("id") == 7, F.lit("0")).otherwise(F.col("leaf")), F.col("proof")) == F.col("root")).alias("ok")).collect()
    assert [r["id"] for r in ok if not r["ok"]] == [7]
