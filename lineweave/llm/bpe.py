"""Byte-level BPE over overlapping chunks, and decoding.

A text of more than ``chunk`` characters is cut into chunks that overlap. Each chunk is pre-tokenised on its own, in
parallel: the pattern never looks back, so from the first place where the boundaries found from two starts agree, they
agree for good. Neighbouring chunks are stitched there, each then encodes its own pieces, and the ids are joined in
order. Boundaries whose match could reach past a chunk's end are not used. Where two neighbours never agree inside
their overlap (one run of letters longer than it), that text is pre-tokenised as a whole instead.

Ids are those that encoding each match of the pattern with the library gives; decoding concatenates the raw bytes of ids.
``ids`` is binary: little-endian unsigned 32-bit integers.

Defined cases: a null text is empty and has no ids; empty tables give no rows; repeated rows each give a row; ids may be
null; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineweave.llm.common import slices, small_batches, texts

CHUNK, OVERLAP = 32_768, 2_048
CACHED = 65_536


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class _Pieces(dict):
    """Ids, as bytes, of the pieces met so far; emptied when it is full."""

    def __init__(self, path: str):
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(path), special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        ids = np.array(self.encoding.encode_ordinary(piece), dtype="<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _pieces(path: str) -> _Pieces:
    return _Pieces(path)


PATTERN = regex.compile(public_tokenizers.PATTERN)


def encode_text(text: str, path: str) -> bytes:
    """Ids of one text, pre-tokenised from its start."""
    known = _pieces(path)
    return b"".join([known[x] for x in PATTERN.findall(text)])


def encode_stretch(text: str, start: int, end: int, path: str) -> bytes:
    """Ids of the matches that begin from one boundary up to another, seen with the text that follows them."""
    known, out = _pieces(path), []
    for m in PATTERN.finditer(text, start):
        if m.start() >= end:
            break
        out.append(known[m[0]])
    return b"".join(out)


def boundaries(text: str, last: bool) -> list[int]:
    """Starts of the matches that no text after the chunk can move; of the last chunk all, and its end.

    What ends a match is seen at most three characters on (``'re`` is the longest alternative that a single character
    doesn't settle); white space up to the chunk's end is one match whose start is settled by what precedes it.
    """
    found = [m.start() for m in PATTERN.finditer(text)]
    if last:
        return [*found, len(text)]
    while found and found[-1] > len(text) - 4:
        found.pop()
    return found


def chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Rows (key, copies, k, last, start, part) of long texts; equal rows of (id, text) make one key."""
    # The key is the row itself, so that running a lost task again gives the same keys.
    long = docs.groupBy("id", "text").agg(F.count(F.lit(1)).alias("copies"))
    n = F.ceil((F.length("text") - F.lit(overlap)) / F.lit(chunk - overlap)).cast("int")
    long = long.select("id", F.sha2("text", 256).alias("digest"), "copies", F.greatest(n, F.lit(1)).alias("n"), "text")
    return long.select("id", "digest", "copies", "n", F.posexplode(F.expr(f"transform(sequence(0, n - 1), k -> substring(text, k * {chunk - overlap} + 1, {chunk}))")).alias("k", "part"))


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Rows (id, ids): one for each row of ``docs``."""
    path, step = path or vocabulary(), chunk - overlap
    rows = small_batches(docs).select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = pa.array([encode_text(t, path) for t in texts(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids], names=["id", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "part"):
            heads, tails = [], []
            for part, k, n in zip(*(batch.column(c).to_pylist() for c in ("part", "k", "n"))):
                found = np.array(boundaries(part, k == n - 1), dtype=np.int64)
                heads.append((found[found < overlap] if k else found[:1]).tolist())
                tails.append((found[found >= step] - step).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))], names=[*batch.schema.names, "head", "tail"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "part"):
            ids = [encode_stretch(part, a, b, path) for part, a, b in zip(*(batch.column(c).to_pylist() for c in ("part", "from", "to")))]
            keep = [batch.column(c) for c in ("id", "digest", "copies", "k")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(ids, pa.binary())], names=["id", "digest", "copies", "k", "ids"])

    parts = chunks(rows.where(F.length("text") > chunk), chunk, overlap)
    found = parts.mapInArrow(cut, f"id {kind}, digest string, copies long, n int, k int, part string, head array<long>, tail array<long>")
    key = Window.partitionBy("id", "digest")
    at = key.orderBy("k")
    both = F.array_intersect(F.lag("tail").over(at), "head")
    found = found.withColumn("from", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.coalesce(F.array_min(both), F.lit(-1)))).drop("head", "tail")
    found = found.withColumns({"to": F.coalesce(F.lead("from").over(at) + step, F.length("part").cast("long")), "met": F.min(F.col("from") >= 0).over(key)})
    stitched = found.where("met").mapInArrow(own, f"id {kind}, digest string, copies long, k int, ids binary")
    joined = F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", F.hex("ids").alias("x")))), lambda s: s["x"]), ""))
    stitched = stitched.groupBy("id", "digest", "copies").agg(joined.alias("ids"))
    # Texts whose chunks never meet: their parts, without the overlaps, make the text again.
    apart = F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda s: F.when(s["k"] == 0, s["part"]).otherwise(F.substr(s["part"], F.lit(overlap + 1))))
    unmet = found.where("not met").groupBy("id", "digest", "copies").agg(F.array_join(apart, "").alias("text"))
    again = unmet.withColumn("one", F.explode(F.expr("sequence(1L, copies)"))).select("id", "text").mapInArrow(whole, f"id {kind}, ids binary")
    long = stitched.withColumn("one", F.explode(F.expr("sequence(1L, copies)"))).select("id", "ids")
    short = rows.where(F.length("text") <= chunk).mapInArrow(whole, f"id {kind}, ids binary")
    return short.unionByName(long).unionByName(again)


@lru_cache(maxsize=2)
def _bytes_of(path: str) -> list[bytes]:
    out = [b""] * (max(_ranks(path).values()) + 1)
    for token, rank in _ranks(path).items():
        out[rank] = token
    return out


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (id, ids, raw): ``raw`` is the bytes that the ids stand for."""
    path = path or vocabulary()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _bytes_of(path)
        for batch in slices(batches, "ids"):
            raw = [b"".join([table[i] for i in np.frombuffer(x or b"", dtype="<u4").tolist()]) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("ids"), pa.array(raw, pa.binary())], names=["id", "ids", "raw"])

    return encoded.select("id", "ids").mapInArrow(join, f"id {encoded.schema['id'].dataType.simpleString()}, ids binary, raw binary")
