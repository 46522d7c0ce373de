"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of them. A passage is encoded by shares of byte classes, shape
of its words, repetition inside it and of what the document had before, and a hashed bag of words; a learned layer turns
that into ``HIDDEN`` values. Gated attention, learned with it from document labels alone, weighs the passages, and a
logistic unit scores the weighted sum.

The model is fitted on a bounded sample of labelled documents (``SAMPLE``, the smallest by a hash of their id; of rows with
one id the text with the smallest hash), on all passages of each. Their bags stay in workers, about ``PART`` documents in a
task: in each round every task descends from the common weights over its own documents, and the driver averages the weights,
a few thousand numbers, by the counts of documents.

Defined cases: null and empty texts are one passage without words and get a score like any other; rows may repeat and ids
be null (then the empty string decides the fold), every row gives a row; labels that are null or whose document is
missing are not learnt from; without labels of both kinds every score is the share of label 1 (1 without any); other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm.common import cut, mixed, shingle_hashes, slices, small_batches, word_hashes
from lineweave.llm.langid import fold
from lineweave.operators import tables

PASSAGE, BAG, HIDDEN = 64, 64, 24
SAMPLE, PART = 6_000, 1_000  #: documents that a model is fitted on at most, and of a task, about
ROUNDS, EPOCHS = 10, 4  #: of averaging, and of descent in each
THRESHOLD = 0.3

# Byte classes: lower case, upper case, digit, space, line feed, each common sign, other signs, other bytes.
_CLASS = np.full(256, 31, dtype=np.int64)
_CLASS[:128] = 30
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = 0, 1, 2
_CLASS[ord(" ")], _CLASS[ord("\n")] = 3, 4
for _k, _c in enumerate(".,!?*#$%&|-_:;'\"()<>/=@+~"):
    _CLASS[ord(_c)] = 5 + _k
CLASSES = 32
WIDTH = CLASSES + 8 + BAG


def passages(data: np.ndarray) -> np.ndarray:
    """Encodings of all passages of one text given as UTF-8 bytes: (passages, WIDTH)."""
    starts, ends, hashes = word_hashes(data)
    n = max(1, -(-len(hashes) // PASSAGE))
    out = np.zeros((n, WIDTH), dtype=np.float32)
    edges = np.concatenate((starts[::PASSAGE], [len(data)])) if len(starts) else np.array([0, len(data)])
    edges[0] = 0
    sizes = np.maximum(np.diff(edges), 1)[:, None]
    of_byte = np.repeat(np.arange(n), np.diff(edges))
    out[:, :CLASSES] = np.bincount(of_byte * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES) / sizes
    if not len(hashes):
        return out
    of = np.arange(len(hashes)) // PASSAGE
    count = np.bincount(of, minlength=n).astype(np.float32)
    mean = lambda x: np.bincount(of, x, n) / count
    length = ends - starts
    first = data[starts]
    upper = (first >= 65) & (first <= 90)
    same = np.concatenate(([False], hashes[1:] == hashes[:-1]))
    seen = np.ones(len(hashes), dtype=bool)
    grams = shingle_hashes(hashes, 3)
    seen[np.unique(grams, return_index=True)[1]] = False
    seen[len(grams) :] = False
    new = np.zeros(len(hashes), dtype=bool)
    new[np.unique(mixed(hashes + of.astype(np.uint64)), return_index=True)[1]] = True
    b = CLASSES
    for x in (length / 10, np.minimum(length, 40) ** 2 / 400, upper, same, seen, new, length > 15):
        out[:, b] = mean(x.astype(np.float32))
        b += 1
    out[:, b] = count / PASSAGE
    out[:, b + 1 :] = np.bincount(of * BAG + (hashes % np.uint64(BAG)).astype(np.int64), minlength=n * BAG).reshape(n, BAG) / count[:, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return {"W": scale(WIDTH, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": scale(HIDDEN, HIDDEN), "U": scale(HIDDEN, HIDDEN), "w": scale(HIDDEN, 1), "c": scale(HIDDEN, 1), "d": np.zeros(1, np.float32)}


def forward(m: dict[str, np.ndarray], x: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """All layers for bags whose passages start at ``at`` in ``x``."""
    h = np.tanh(x @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = ((t * g) @ m["w"])[:, 0]
    sizes = np.diff(np.append(at, len(x)))
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), sizes))
    a = e / np.repeat(np.add.reduceat(e, at), sizes)
    z = np.add.reduceat(h * a[:, None], at, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes, "p": _sigmoid(z @ m["c"] + m["d"])[:, 0]}


def gradients(m: dict[str, np.ndarray], x: np.ndarray, at: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss."""
    f = forward(m, x, at)
    dp = ((f["p"] - y) / len(y)).astype(np.float32)[:, None]
    dz = np.repeat(dp @ m["c"].T, f["sizes"], axis=0)
    da = (dz * f["h"]).sum(axis=1)
    mean = np.repeat(np.add.reduceat(da * f["a"], at), f["sizes"])
    de = (f["a"] * (da - mean))[:, None]
    tg = de @ m["w"].T
    dt, dg = tg * f["g"] * (1 - f["t"] ** 2), tg * f["t"] * f["g"] * (1 - f["g"])
    dh = dz * f["a"][:, None] + dt @ m["V"].T + dg @ m["U"].T
    du = dh * (1 - f["h"] ** 2)
    return {"W": x.T @ du, "b": du.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dp, "d": dp.sum(axis=0)}


Weights = dict[str, np.ndarray]


def _fresh(seed: int = 3) -> list[Weights]:
    """The weights to begin with, and the two moments of their gradients."""
    m = _start(np.random.default_rng(seed))
    return [m, {k: 0 * v for k, v in m.items()}, {k: 0 * v for k, v in m.items()}]


def descend(state: list[Weights], bags: list[np.ndarray], y: np.ndarray, epochs: range, steps: int, rate: float = 3e-3, decay: float = 1e-4, batch: int = 64) -> tuple[list[Weights], int]:
    """Weights and moments after some epochs over scaled bags, and the count of steps, of which ``steps`` were made before."""
    m, one, two = ({k: v.copy() for k, v in part.items()} for part in state)
    for epoch in epochs:
        order = np.random.default_rng(epoch).permutation(len(bags))
        step = rate * (1 - epoch / (ROUNDS * EPOCHS)) + rate * 0.02
        for a in range(0, len(order), batch):
            mine = order[a : a + batch]
            at = np.cumsum([0, *(len(bags[i]) for i in mine)])[:-1]
            steps += 1
            for k, g in gradients(m, np.concatenate([bags[i] for i in mine]), at, y[mine]).items():
                g = g + decay * m[k]
                one[k], two[k] = 0.9 * one[k] + 0.1 * g, 0.999 * two[k] + 0.001 * g * g
                m[k] = (m[k] - step * (one[k] / (1 - 0.9**steps)) / (np.sqrt(two[k] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return [m, one, two], steps


def score(m: dict[str, np.ndarray], bags: list[np.ndarray]) -> np.ndarray:
    if "W" not in m:
        return np.full(len(bags), m["share"][0])
    at = np.cumsum([0, *map(len, bags)])[:-1]
    return forward(m, ((np.concatenate(bags) - m["mean"]) * m["scale"]).astype(np.float32), at)["p"].astype(float)


def _bags(batch: pa.RecordBatch, column: str = "text") -> list[np.ndarray]:
    return [passages(np.frombuffer((t or "").encode(), dtype=np.uint8)) for t in batch.column(column).to_pylist()]


def _packed(state: list[Weights]) -> bytes:
    return b"".join(part[k].astype("<f4").tobytes() for part in state for k in sorted(part))


def _averaged(found: list[tuple[int, bytes]], like: list[Weights]) -> list[Weights]:
    """The mean of packed states, by counts."""
    counts = np.array([n for n, _ in found], dtype=float)
    mean = counts @ np.stack([np.frombuffer(x, "<f4") for _, x in found]) / counts.sum()
    out, at = [], 0
    for part in like:
        out.append({})
        for k in sorted(part):
            out[-1][k] = mean[at : at + part[k].size].reshape(part[k].shape).astype(np.float32)
            at += part[k].size
    return out


def _matrices(part: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype="<f2").astype(np.float32).reshape(-1, WIDTH) for x in part.column("x").to_pylist()]


def _round(state: list[Weights], steps: int, epochs: range, mean: np.ndarray, scale: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """What a task does in a round: it descends from the common state over its own documents."""

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("id")
        bags = [(b - mean) * scale for b in _matrices(part)]
        after, done = descend(state, bags, part.column("y").to_numpy().astype(np.float32), epochs, steps)
        return pa.table({"part": [part.column("part")[0].as_py()], "n": [len(bags)], "steps": [done], "state": [_packed(after)]})

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Weights:
    """Fits on at most ``sample`` of the labelled documents given."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y is not null")
    known = cut(known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample))
    groups = max(1, -(-known.count() // PART))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            whole = [b.astype("<f2").tobytes() for b in _bags(batch)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "y", "h")), pa.array(whole, pa.binary())], names=["id", "y", "h", "x"])

    rows = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    kind = rows.schema["id"].dataType.simpleString()
    coded = rows.select("id", "y", F.xxhash64("text").alias("h"), "text").mapInArrow(encode, f"id {kind}, y int, h long, x binary")
    taught = coded.groupBy("id").agg(F.min_by(F.struct("y", "x"), "h").alias("r")).select("id", "r.*", F.pmod(F.xxhash64("id"), F.lit(groups)).alias("part"))
    taught, path = tables.written(taught, "bags")

    def sums(part: pa.Table) -> pa.Table:
        every = np.concatenate(_matrices(part.sort_by("id"))).astype(float)
        y = part.column("y").to_numpy()
        total = np.stack((every.sum(axis=0), (every**2).sum(axis=0)))
        return pa.table({"part": [part.column("part")[0].as_py()], "n": [len(y)], "ones": [int(y.sum())], "passages": [len(every)], "total": [total.tobytes()]})

    found = sorted(taught.groupBy("part").applyInArrow(sums, "part long, n long, ones long, passages long, total binary").collect(), key=lambda r: r["part"])
    n, ones = (sum(r[c] for r in found) for c in ("n", "ones"))
    rest = {"share": np.array([ones / n if n else 1.0], dtype=np.float32)}
    if 0 < ones < n:
        passages_ = sum(r["passages"] for r in found)
        mean, square = sum(np.frombuffer(r["total"]).reshape(2, -1) for r in found) / passages_
        rest |= {"mean": mean.astype(np.float32), "scale": (1 / (np.sqrt(np.maximum(square - mean**2, 0)) + 1e-2)).astype(np.float32)}
        state, steps = _fresh(), 0
        for k in range(ROUNDS):
            run = _round(state, steps, range(k * EPOCHS, (k + 1) * EPOCHS), rest["mean"], rest["scale"])
            found = sorted(taught.groupBy("part").applyInArrow(run, "part long, n long, steps long, state binary").collect(), key=lambda r: r["part"])
            state, steps = _averaged([(r["n"], r["state"]) for r in found], state), max(r["steps"] for r in found)
        rest |= state[0]
    tables.remove(path)
    return rest


def predict(docs: DataFrame, model: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, score), one for each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.round(score(model, _bags(batch)), 6), pa.float64())], names=["id", "score"])

    rows = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(read, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield batch.filter(pa.array(np.round(score(model, _bags(batch, text)), 6) >= threshold))

    return small_batches(docs).mapInArrow(read, docs.schema)


FOLDS = 5


def in_fold(doc_id: str = "doc_id"):
    """Whether a document is held out."""
    return fold(F.col(doc_id), FOLDS) == 0
