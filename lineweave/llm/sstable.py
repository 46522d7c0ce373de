"""Sorted-string-table shards of token ids.

Documents are range-partitioned by id, encoded and written as shards of bounded size. A shard is one file:

    blocks   entries of about ``BLOCK`` bytes: varint shared, varint rest, varint value length, rest of the key, value
    index    per block: varint length of its first key, that key, then offset, length, entries and tokens before it
    bloom    varint count of hashes, bits of a Bloom filter over the keys
    footer   FOOTER: places of index and Bloom filter, entries, tokens, crc32 of all before, magic

Keys sort as the ids do (null first), then by a hash of the text and the count of equal rows before; a key shares a prefix
with the one before it, except at the start of a block. A value is a varint count of ids, a byte for the width of each (2
or 4) and the ids, little-endian. A look-up reads the footer, asks the Bloom filter, finds its block by binary search in
the index and reads that block alone.

Shards are written by Spark's committed writers, one file per row, so a lost task leaves no shard behind; the writer ends
each file with a line feed, which is the last byte of the magic. Ids are those that the library gives for the whole text
(an added token such as ``<|endoftext|>`` in a text is that token), but equal pre-tokens are encoded once per worker; they
are known by 64-bit hashes.

Defined cases: a null text is empty and holds the end id alone; a null id sorts first; repeated ids are kept, ordered by a
hash of their text and the text, and may lie in several shards; an empty table gives no shards and no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lineweave.llm.common import BYTES, cut, run_hashes, shared_dir, slices, small_batches, texts
from lineweave.llm.mixing import SMALL

END_ID = 2
BLOCK, SHARD = 64 << 10, 16 << 20
MAGIC = b"LWSST01\n"
FOOTER = struct.Struct("<QQQQQQI8s")
CACHED, CACHED_PARTS = 600_000, 100_000  #: pre-tokens and parts that a worker knows


# ---- ids --------------------------------------------------------------------------------------------------------


_ODD, _LETTER, _DIGIT, _SIGN, _SPACE, _FEED, _END = range(7)
_SEPARATOR = 0xFF  #: a byte that is in no text
_LATIN = 0x250  #: below it letters and their mapping are settled
_IS_LETTER = np.array([chr(c).isalpha() for c in range(_LATIN)] + [False] * (0x280 - _LATIN))
_KIND = np.array([_LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _SIGN if 32 < c < 127 else _ODD for c in range(128)] + [_ODD] * 128, dtype=np.uint8)
_KIND[[ord(" "), ord("\n"), _SEPARATOR]] = _SPACE, _FEED, _END


def pre_tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the matches of the byte-level pattern in texts that each end with the separator, and places it can't judge.

    Judged are letters below ``_LATIN``, digits and signs of ASCII, single spaces before one of these, and single line feeds.
    """
    kind = _KIND[data]
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC9))
    lead = lead[_IS_LETTER[(data[lead].astype(np.int64) & 0x1F) << 6 | data[lead + 1] & 0x3F]]
    kind[lead] = kind[lead + 1] = _LETTER
    start = np.empty(len(kind), dtype=bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    following = np.append(kind[1:], _END)
    space, feed = kind == _SPACE, kind == _FEED
    start[1:] &= ~space[:-1]
    start |= kind >= _FEED
    odd = kind == _ODD
    odd |= space & ((following == _ODD) | (following > _SIGN))
    odd |= feed & (following == _FEED)
    # An apostrophe that begins a run of signs begins a match of its own before these letters.
    for at in np.flatnonzero((data == ord("'")) & start):
        tail = bytes(data[at + 1 : at + 3])
        n = 2 if tail[:1] in (b"s", b"t", b"m", b"d") else 3 if tail in (b"re", b"ve", b"ll") else 0
        if n:
            start[at + 1 : at + n] = False
            start[at + n] = True
    return np.flatnonzero(start), np.flatnonzero(odd)


class _Encoder:
    """Ids of texts as bytes (unsigned 32-bit, little-endian).

    Where ``pre_tokens`` can judge a whole text, its pre-tokens are hashed and looked up together, with those of other texts;
    the library's model encodes each that the worker doesn't know. Any other text is cut before each single space or line
    feed between visible characters, where the pattern ends a match and starts anew, and the library finds the pre-tokens
    of the parts. A text with an added token and a part with white space inside go to the library as they are.
    """

    CUT = re.compile(r"(?<=\S)(?= \S|\n\S)")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = self.tokenizer.model.tokenize  #: of pre-tokens that are cut and mapped already
        self.letters = {}  #: the mapping of bytes
        for c in map(chr, range(_LATIN)):
            self.letters |= zip(c.encode(), "".join(x for x, _ in self.split(c)))
        self.parts: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")

    def _merged(self, mapped: str) -> list[int]:
        return [t.id for t in self.merge(mapped)]

    def _find(self, raw: bytes, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each pre-token begin in ``ids``, and their count; with ``starts`` comes the end."""
        sizes = np.diff(starts)
        hashes = run_hashes(BYTES[data], starts[:-1], sizes)
        distinct, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.keys, distinct)
        new = np.append(self.keys, np.uint64(0))[where] != distinct
        new[where == len(self.keys)] = True
        if len(self.keys) + int(new.sum()) > CACHED:
            self._forget()
            where, new = np.zeros(len(distinct), np.int64), np.ones(len(distinct), dtype=bool)
        found = []
        for a, n in zip(starts[first[new]].tolist(), sizes[first[new]].tolist()):
            token = raw[a : a + n]
            if token.isalnum():  # of ASCII
                mapped = token.decode()
            else:
                mapped = self.letters[32] + token[1:].decode() if token[0] == 32 and token.isascii() else token.decode("latin-1").translate(self.letters)
            found.append(self._merged(mapped))
        counts = np.array([len(x) for x in found], dtype=np.int64)
        ends = len(self.ids) + np.cumsum(counts)
        self.ids = np.concatenate((self.ids, np.fromiter((i for x in found for i in x), "<u4")))
        self.keys = np.insert(self.keys, where[new], distinct[new])
        self.at, self.count = np.insert(self.at, where[new], ends - counts), np.insert(self.count, where[new], counts)
        where = np.searchsorted(self.keys, distinct)[of]
        return self.at[where], self.count[where]

    def _even(self, batch: list[bytes]) -> list[bytes | None]:
        """Ids of the texts that ``pre_tokens`` can judge, None for the others."""
        sep = bytes([_SEPARATOR])
        if not batch:
            return []
        raw = sep.join(batch) + sep
        data = np.frombuffer(raw, dtype=np.uint8)
        starts, odd = pre_tokens(data)
        ends = np.cumsum([len(t) + 1 for t in batch])
        bad = np.zeros(len(batch), dtype=bool)
        bad[np.searchsorted(ends, odd, side="right")] = True
        of = np.searchsorted(ends, starts, side="right")
        # Separators are pre-tokens without ids; so are those of texts that others see to.
        gone = bad[of] | (data[starts] == _SEPARATOR)
        kept = np.flatnonzero(~gone)
        edges = np.append(starts, len(data))
        lengths = edges[kept + 1] - edges[kept]
        if len(kept) < len(starts):  # close the gaps
            keep = np.repeat(~gone, np.diff(edges))
            data = data[keep]
            raw = data.tobytes()
        if not len(kept):
            return [None if b else b"" for b in bad.tolist()]
        at, count = self._find(raw, data, np.append(0, np.cumsum(lengths)))
        upto = np.append(0, np.cumsum(count))
        ids = self.ids[np.repeat(at - upto[:-1], count) + np.arange(upto[-1])].tobytes()
        cuts = (4 * upto[np.searchsorted(of[kept], np.arange(len(batch) + 1))]).tolist()
        return [None if b else ids[x:y] for b, x, y in zip(bad.tolist(), cuts, cuts[1:])]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            inner = any(map(str.isspace, part[1:])) or part[:1].isspace() and part[0] not in " \n"
            ids = self._whole(part) if inner else array("I", [i for x, _ in self.split(part) for i in self._merged(x)]).tobytes()
            if len(part) <= 64:
                if len(self.parts) >= CACHED_PARTS:
                    self.parts.clear()
                self.parts[part] = ids
        return ids

    def __call__(self, batch: list[str]) -> list[bytes]:
        special = [any(x in t for x in self.added) for t in batch]
        even = self._even([b"" if x else t.encode() for t, x in zip(batch, special)])
        out = []
        for t, x, ids in zip(batch, special, even):
            out.append(self._whole(t) if x else b"".join([self._part(p) for p in self.CUT.split(t)]) if ids is None else ids)
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


# ---- the file format --------------------------------------------------------------------------------------------


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def unvarint(data, at: int) -> tuple[int, int]:
    n = shift = 0
    while data[at] & 128:
        n |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
    return n | data[at] << shift, at + 1


def key_of(doc_id: int | None, digest: int, occurrence: int) -> bytes:
    """Bytes that sort as the numbers do: the occurrence is led by its length."""
    count = occurrence.to_bytes((occurrence.bit_length() + 7) // 8, "big")
    return _id_key(doc_id) + (digest + 2**63).to_bytes(8, "big") + bytes([len(count)]) + count


def _id_key(doc_id: int | None) -> bytes:
    return b"\0" * 9 if doc_id is None else b"\1" + (doc_id + 2**63).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return int.from_bytes(key[1:9], "big") - 2**63 if key[0] else None


def _bits(key: bytes, size: int, hashes: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1
    return [(a + i * b + i * i) % size for i in range(hashes)]


class Shard:
    """Builds one shard from ids in ascending order of key."""

    def __init__(self):
        self.blocks, self.index, self.keys, self.block = [], [], [], bytearray()
        self.size = self.tokens = self.before = self.entries = 0
        self.first = self.last = b""

    def add(self, key: bytes, ids: bytes) -> None:
        wide = np.frombuffer(ids, dtype="<u4")
        narrow = not len(wide) or int(wide.max()) < 65536
        value = varint(len(wide)) + (b"\2" + wide.astype("<u2").tobytes() if narrow else b"\4" + ids)
        if not self.block:
            self.first, self.last, self.before, self.entries = key, b"", self.tokens, 0
        shared = 0
        while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
            shared += 1
        self.block += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.last = key
        self.keys.append(key)
        self.entries += 1
        self.tokens += len(wide)
        if len(self.block) >= BLOCK:
            self._close()

    def _close(self) -> None:
        if self.block:
            self.index.append(varint(len(self.first)) + self.first + varint(self.size) + varint(len(self.block)) + varint(self.entries) + varint(self.before))
            self.blocks.append(bytes(self.block))
            self.size += len(self.block)
            self.block = bytearray()

    def finish(self) -> bytes:
        """The whole file but for its last byte, a line feed."""
        self._close()
        index, hashes = b"".join(self.index), 7
        bits = bytearray(max(8, len(self.keys) * 10 // 8 + 1))
        for key in self.keys:
            for bit in _bits(key[:9], len(bits) * 8, hashes):
                bits[bit >> 3] |= 1 << (bit & 7)
        bloom = varint(hashes) + bytes(bits)
        body = b"".join([*self.blocks, index, bloom])
        return body + FOOTER.pack(self.size, len(index), self.size + len(index), len(bloom), len(self.keys), self.tokens, zlib.crc32(body), MAGIC)[:-1]


class Reader:
    """Reads a shard through ``read(offset, bytes)``: whole, or one document by binary search."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.blocks, at = read, [], 0
        index, n, bloom, m, self.entries, self.tokens, self.crc, magic = FOOTER.unpack(read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a whole shard")
        data = read(index, n)
        while at < n:
            k, at = unvarint(data, at)
            key, at = data[at : at + k], at + k
            place = []
            for _ in range(4):
                x, at = unvarint(data, at)
                place.append(x)
            self.blocks.append((key, *place))
        data = read(bloom, m)
        self.hashes, at = unvarint(data, 0)
        self.bits = data[at:]

    @classmethod
    def whole(cls, data: bytes) -> Reader:
        """Of a shard in memory, all of whose bytes are checked."""
        found = cls(lambda at, n: data[at : at + n], len(data))
        if zlib.crc32(memoryview(data)[: len(data) - FOOTER.size]) != found.crc:
            raise ValueError("not a whole shard")
        return found

    def may_have(self, doc_id: int | None) -> bool:
        return all(self.bits[b >> 3] >> (b & 7) & 1 for b in _bits(_id_key(doc_id), len(self.bits) * 8, self.hashes))

    def block(self, i: int) -> Iterator[tuple[bytes, int, np.ndarray]]:
        """(key, tokens before it in the shard, ids) of a block's entries."""
        _, offset, length, _, before = self.blocks[i]
        data, at, key = self.read(offset, length), 0, b""
        while at < length:
            shared, at = unvarint(data, at)
            rest, at = unvarint(data, at)
            size, at = unvarint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            n, start = unvarint(data, at)
            ids = np.frombuffer(data, dtype="<u2" if data[start] == 2 else "<u4", count=n, offset=start + 1)
            yield key, before, ids
            before += n
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, int, np.ndarray]]:
        for i in range(len(self.blocks)):
            yield from self.block(i)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of each row of a document."""
        if not self.may_have(doc_id):
            return []
        low = _id_key(doc_id)
        i = max(0, bisect_right(self.blocks, low, key=lambda b: b[0]) - 1)
        out = []
        while i < len(self.blocks) and self.blocks[i][0][:9] <= low:
            out += [ids for key, _, ids in self.block(i) if key[:9] == low]
            i += 1
        return out


# ---- Spark ------------------------------------------------------------------------------------------------------


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID, shard: int = SHARD) -> None:
    """Encodes every text and writes the shards to ``path``."""
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        now, last, seen = Shard(), None, 0
        for batch in slices(batches, "text", 1 << 20):
            for i, h, ids in zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), encode(texts(batch, "text"))):
                seen = seen + 1 if (i, h) == last else 0
                last = i, h
                now.add(key_of(i, h, seen), ids + end)
                if now.size >= shard:
                    yield pa.RecordBatch.from_arrays([pa.array([now.finish()], pa.binary())], names=["shard"])
                    now = Shard()
        if now.keys:
            yield pa.RecordBatch.from_arrays([pa.array([now.finish()], pa.binary())], names=["shard"])

    rows = small_batches(docs).select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"))
    rows = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text")
    shards = rows.mapInArrow(build, "shard binary")
    shards.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def shard_table(files: DataFrame) -> DataFrame:
    """Rows (path, first_id, last key's order, entries, tokens) of the shards: what their footers and indexes say."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                r = Reader.whole(content)
                yield pa.RecordBatch.from_pydict({"path": [path], "first_key": [r.blocks[0][0]], "entries": [r.entries], "tokens": [r.tokens]}, schema=_TABLE)

    return files.mapInArrow(read, "path string, first_key binary, entries long, tokens long")


_TABLE = pa.schema([("path", pa.string()), ("first_key", pa.binary()), ("entries", pa.int64()), ("tokens", pa.int64())])
_ROWS = pa.schema([("path", pa.string()), ("id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows (id, start, n_tokens, ids_crc32) read back from the shards; ``start`` counts the ids of all documents before."""
    files = read_files(spark, path)
    shards = shard_table(files)
    # One row per shard, so even 100 TB are a few million short rows here.
    before = Window.orderBy("first_key", "path").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(shards.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = [(name, id_of(k), b, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for k, b, ids in Reader.whole(content)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ROWS.types)], schema=_ROWS)

    rows = files.mapInArrow(read, "path string, id long, before long, n_tokens long, ids_crc32 long")
    rows = rows.join(F.broadcast(starts) if starts.count() <= SMALL else starts, "path")
    return rows.select("id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def _opened(path: str) -> pa.NativeFile:
    """A file of a shared folder, for reading parts of it, where pyarrow knows the file system."""
    system, name = FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return system.open_input_file(name)


def look_up(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Rows (id, tokens) of a stated list of documents, each found by Bloom filter and binary search in ranged reads."""
    wanted = list(dict.fromkeys(ids))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                with _opened(name) as f:
                    r = Reader(lambda at, n: f.read_at(n, at), size)
                    rows = [(i, x.tolist()) for i in wanted for x in r.get(i)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.list_(pa.int64()))], names=["id", "tokens"])

    return spark.read.format("binaryFile").load(path).select("path", "length").mapInArrow(find, "id long, tokens array<long>")


def new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
