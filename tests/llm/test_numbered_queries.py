"""Every numbered query: its SQL where it has one, the columns and rows of its contract, and that it repeats."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from lineweave.llm import bpe, queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_audio_features": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op2_source_mix": "doc_id size source_size target taken",
    "op3_sstable": "doc_id start n_tokens ids_crc32",
    "op4_jaccard_join": "doc_id n_shingles component_id",
    "op5_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op7_hilbert_search": "query_id rank vec_id score",
    "op8_language_id": "doc_id held_out lang_pred score",
    "op9_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10_quality": "doc_id held_out score predicted",
    "op11_bottom_k": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op12_word_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def results(spark):
    return {name: queries.QUERIES[name](spark, SF).toPandas() for name in COLUMNS}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(results, texts, name):
    found = results[name]
    assert list(found.columns[: len(COLUMNS[name].split())]) == COLUMNS[name].split()
    longest = ["start", "length", "period", "exponent_milli"]  # of a text without runs there is none
    assert not found.drop(columns=longest, errors="ignore").isnull().any().any()
    if name == "op12_word_runs":
        assert (found[longest].isnull().any(axis=1) == (found["n_runs"] == 0)).all()
    if "doc_id" in found:
        assert sorted(found["doc_id"]) == sorted(texts)
    if "score" in found and name != "op7_hilbert_search":
        assert found["score"].between(0, 1).all()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(results, name):
    c = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "labels"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = c.execute(queries.ORACLES[name]).df()
    mine = results[name]
    assert sorted(mine.columns) == sorted(want.columns)
    order = sorted(want.columns)
    key = order[0] if name != "op6_chat_format" else "conv_id"
    key = "doc_id" if "doc_id" in order else key
    a, b = (x[order].sort_values(key).reset_index(drop=True) for x in (mine, want))
    for column in order:
        assert np.allclose(a[column], b[column]) if a[column].dtype.kind == "f" else a[column].tolist() == b[column].tolist()


def test_payloads_are_the_texts(results, texts):
    for r in results["op1_audio_features"].itertuples():
        raw = texts[r.doc_id].encode()
        full = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))


def test_shards_hold_the_library_ids(results, texts):
    t, start = Tokenizer.from_file(P.path("byte_bpe_50k.json")), 0
    for r in results["op3_sstable"].sort_values("doc_id").itertuples():
        ids = np.array([*t.encode(texts[r.doc_id], add_special_tokens=False).ids, 2], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pieces_are_those_of_the_library(results, texts):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe._ranks(bpe.vocabulary()), special_tokens={})
    for r in results["op5_byte_bpe"].itertuples():
        ids = np.array(own.encode_ordinary(texts[r.doc_id]), dtype="<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_folds(results):
    for name, folds, out in (("op8_language_id", 3, 1), ("op10_quality", 5, 0)):
        f = results[name]
        assert [zlib.crc32(str(i).encode()) % folds == out for i in f["doc_id"]] == f["held_out"].tolist()
    q = results["op10_quality"]
    assert ((q["score"] >= 0.3).astype(int) == q["predicted"]).all()
