"""What the operators share: shared-folder tables, worker-side helpers and word hashing.

Nothing here writes to a folder of one machine on a cluster: tables and checkpoints go below the folder
that the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lineweave.operators import tables
from lineweave.operators.tables import shared_dir


def cut(df: DataFrame) -> DataFrame:
    """Ends the lineage of narrow rows with a reliable checkpoint, which Spark removes with its last reader."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str) -> DataFrame:
    """Ends the lineage of wide rows: a Parquet table in the shared folder, removed when the application ends."""
    return tables.written(df, what)[0]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(df: DataFrame, most: str = "4m") -> DataFrame:
    """Has Spark hand rows to Python in batches of few bytes, so that neither side holds many texts at once.

    A session that was started with a bound of its own keeps it.
    """
    spark = df.sparkSession
    if spark.sparkContext.getConf().get(BATCH_BYTES) is None:
        spark.conf.set(BATCH_BYTES, most)
    return df


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that what a worker holds of one column is about ``most`` bytes, or one row if that is longer.

    Behind the last one the worker, which lives on for other tasks, gives the memory that it no longer needs back.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        part = np.cumsum(sizes) // most
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


# ---- words and their hashes -------------------------------------------------------------------------------------
# A word is a run of bytes other than space and 9 to 13. Its hash sums a mixed 64-bit value of each byte and its place in
# the word, so that a whole batch is hashed with array arithmetic and no loop over words. (A polynomial modulo a power of
# two would give equal hashes to the words of a Thue-Morse sequence, whatever its base.)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(9, 14)]] = True
_RANDOM = np.random.default_rng(20240607)
BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_FOLDED = BYTES.copy()  #: A-Z as a-z
_FOLDED[ord("A") : ord("Z") + 1] = BYTES[ord("a") : ord("z") + 1]
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 16  #: bytes hashed at once


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each run, from the values of its bytes; runs lie side by side and none is empty."""
    place = (np.arange(len(values)) - np.repeat(starts, sizes)).astype(np.uint64)
    return mixed(np.add.reduceat(mixed(values + place * _ODD), starts) + sizes.astype(np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash (A-Z as a-z) of each word in UTF-8 bytes."""
    gap = _SPACE[data]
    edge = np.diff(np.concatenate(([True], gap, [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=np.uint64)
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):  # in blocks, which end with a word, as values are eight times as long as bytes
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _BLOCK, side="right")))
        part, sizes = slice(base, ends[j - 1]), ends[i:j] - starts[i:j]
        hashes[i:j] = run_hashes(_FOLDED[data[part][~gap[part]]], np.cumsum(sizes) - sizes, sizes)
        i = j
    return starts, ends, hashes


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` word hashes; of the whole sequence if it is shorter; nothing without words."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = mixed(out * _ODD + words[k : len(words) - n + 1 + k])
    return out
