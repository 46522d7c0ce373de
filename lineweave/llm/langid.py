"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability under a language is
the sum over all ways to segment it into pieces of the product of their probabilities, by the forward algorithm; a text's
is the product over its words. The piece probabilities are fitted by expectation maximisation (forward-backward) on the
words of a bounded sample of documents for each language; a language's words are fitted in a task of their own.

Words are the runs of letters in the lower-cased text, with the vocabulary's mark for a word's start before them; pieces
never span words, so equal words are scored once per worker. A character outside the vocabulary counts as a piece of
small fixed probability in all languages. Words of any length are scored over all their segmentations: long ones, and those
whose probability is too small for a number, by a forward pass that is scaled at every place. Only the fit cuts words of
more than ``LONGEST`` characters. A language's model is 128 KB in each worker.

Defined cases: a text that is null or has no letter gets ``und`` with score 0; rows may repeat and ids be null (then the
empty string decides the fold), every row gives a row; rows without a language are never learnt from; with nothing to
learn from, every text is ``und``; ties go to the language that sorts first; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineweave.llm.common import slices, small_batches, texts

SAMPLE = 400  #: documents that each language is learnt from, in expectation
ROUNDS, PRIOR, UNKNOWN, SMALLEST = 4, 0.05, 1e-7, 1e-280
LONGEST = 64  #: characters of a word that has a place in a lattice of many words
CACHED, HELD = 400_000, 32 << 20  #: runs or words that a worker knows, and their characters
# Letters are what Unicode calls so: of the characters of words without digits and low lines, not fractions, signs and numerals.
ASCII_LETTERS = re.compile("[A-Za-z]+")
LETTERS = re.compile("[^\\W\\d_%s]+" % "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()))
MARK = "▁"
_SIDE = LONGEST + 1  #: places in a word


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[dict[str, int], int]:
    """The vocabulary's ordinary pieces, numbered, with -1 for what only begins a piece; and the count of pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    found = [p for p in found if p == p.lower()]
    begun = {p[:n]: -1 for p in found for n in range(1, len(p))}
    return begun | {p: i for i, p in enumerate(found)}, len(found)


def words_of(token: str) -> list[str]:
    """The words in a lower-cased run without white space, marked."""
    if token.isalpha():
        return [MARK + token]
    return [MARK + w for w in (ASCII_LETTERS if token.isascii() else LETTERS).findall(token)]


def edges_of(word: str, path: str) -> list[tuple[int, int, int]]:
    """(from, to, piece) of all pieces in a word, -1 for a character that is none, by where they end."""
    vocabulary = pieces(path)[0].get
    found = []
    for i in range(len(word)):
        x = vocabulary(word[i])
        found.append((i, i + 1, -1 if x is None else x))
        j = i + 2
        while x is not None and j <= len(word):
            x = vocabulary(word[i:j])
            if x is not None and x >= 0:
                found.append((i, j, x))
            j += 1
    return sorted(found, key=lambda e: e[1])


def _sums(n: int, edges: list[tuple[int, int, float]]) -> list[float]:
    """Log of the summed probability of all ways from 0 to each place; edges come by where they end."""
    out, at = [0.0] * (n + 1), 0
    for j in range(1, n + 1):
        logs = []
        while at < len(edges) and edges[at][1] == j:
            logs.append(out[edges[at][0]] + edges[at][2])
            at += 1
        top = max(logs)
        out[j] = top + math.log(sum(math.exp(v - top) for v in logs))
    return out


def expected_pieces(word: str, probability: np.ndarray, path: str) -> Counter:
    """How often each piece occurs in a word in expectation over its segmentations, whatever its length."""
    n, edges = len(word), edges_of(word, path)
    logs = [math.log(UNKNOWN if x < 0 else probability[x]) for _, _, x in edges]
    there = _sums(n, [(i, j, w) for (i, j, _), w in zip(edges, logs)])
    back = _sums(n, sorted(((n - j, n - i, w) for (i, j, _), w in zip(edges, logs)), key=lambda e: e[1]))
    counts: Counter = Counter()
    for (i, j, x), w in zip(edges, logs):
        if x >= 0:
            counts[x] += math.exp(there[i] + w + back[n - j] - there[n])
    return counts


def scaled_total(word: str, probabilities: np.ndarray, path: str) -> np.ndarray:
    """Log of the summed probability of all segmentations of one word under every language, whatever its length."""
    vocabulary = pieces(path)[0].get
    ends: dict[int, list[tuple[int, int]]] = {}  #: pieces that end at places further on: (start, piece)
    sums, scale = {0: np.ones(len(probabilities))}, np.zeros(len(probabilities))
    for i in range(len(word)):
        if i:
            edges = ends.pop(i)
            here = sum(sums[a] * (UNKNOWN if x is None else probabilities[:, x]) for a, x in edges)
            least = min((a for es in ends.values() for a, _ in es), default=i)
            sums = {a: s / here for a, s in sums.items() if a >= least}
            sums[i], scale = np.ones(len(here)), scale + np.log(here)
        x = vocabulary(word[i])
        ends.setdefault(i + 1, []).append((i, x if x is not None and x >= 0 else None))
        j = i + 2
        while x is not None and j <= len(word):
            x = vocabulary(word[i:j])
            if x is not None and x >= 0:
                ends.setdefault(j, []).append((i, x))
            j += 1
    return scale + np.log(sum(sums[a] * (UNKNOWN if x is None else probabilities[:, x]) for a, x in ends[len(word)]))


class Lattice:
    """All segmentations of a list of words: edges (word, from, to, piece), sorted by where they end."""

    def __init__(self, words: list[str], path: str):
        vocabulary = pieces(path)[0].get
        place, piece = [], []
        at, to = place.append, piece.append
        for k, word in enumerate(words):
            n = len(word)
            for i in range(n):
                here = (k * _SIDE + i) * _SIDE
                x = vocabulary(word[i])
                at(here + i + 1), to(-1 if x is None else x)
                j = i + 2
                while x is not None and j <= n:
                    x = vocabulary(word[i:j])
                    if x is not None and x >= 0:
                        at(here + j), to(x)
                    j += 1
        self.n, self.lengths = len(words), np.array([len(x) for x in words], dtype=np.int64)
        self.width = int(self.lengths.max(initial=0)) + 1
        place, piece = np.array(place, dtype=np.int64), np.array(piece, dtype=np.int64)
        end = place % _SIDE
        order = np.argsort(end, kind="stable")
        self.end, self.piece, rest = end[order], piece[order], place[order] // _SIDE
        self.word, self.start = rest // _SIDE, rest % _SIDE
        self.steps = np.searchsorted(self.end, np.arange(self.width + 1))

    def weights(self, probability: np.ndarray) -> np.ndarray:
        return np.where(self.piece >= 0, probability[self.piece], UNKNOWN)

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Summed probability of each prefix of each word: (words, width)."""
        sums = np.zeros((self.n, self.width))
        sums[:, 0] = 1
        for j in range(1, self.width):
            e = slice(self.steps[j], self.steps[j + 1])
            sums[:, j] = np.bincount(self.word[e], sums[self.word[e], self.start[e]] * weight[e], self.n)
        return sums

    def backward(self, weight: np.ndarray) -> np.ndarray:
        sums = np.zeros((self.n, self.width))
        sums[np.arange(self.n), self.lengths] = 1
        order = np.argsort(self.start, kind="stable")
        steps = np.searchsorted(self.start[order], np.arange(self.width + 1))
        for i in range(self.width - 1, -1, -1):
            e = order[steps[i] : steps[i + 1]]
            if len(e):
                sums[:, i] += np.bincount(self.word[e], sums[self.word[e], self.end[e]] * weight[e], self.n)
        return sums

    def totals(self, probability: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations of each word; of some long words it is too small to tell."""
        return np.log(np.maximum(self.forward(self.weights(probability))[np.arange(self.n), self.lengths], SMALLEST))


def fit(counts: dict[str, int], path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities under which the counted words, over all their segmentations, are likely."""
    size = pieces(path)[1]
    probability = np.full(size, 1 / size)
    words = sorted(w for w in counts if len(w) <= LONGEST)
    long = sorted(w for w in counts if len(w) > LONGEST)
    lattices = [(Lattice(part := words[a : a + 5000], path), np.array([counts[w] for w in part], dtype=float)) for a in range(0, len(words), 5000)]
    for _ in range(rounds):
        expected = np.full(size, PRIOR)
        for lattice, n in lattices:
            weight = lattice.weights(probability)
            there, back = lattice.forward(weight), lattice.backward(weight)
            total = np.maximum(there[np.arange(lattice.n), lattice.lengths], 1e-300)
            share = there[lattice.word, lattice.start] * weight * back[lattice.word, lattice.end] * (n / total)[lattice.word]
            known = lattice.piece >= 0
            expected += np.bincount(lattice.piece[known], share[known], size)
        for word in long:
            for x, n in expected_pieces(word, probability, path).items():
                expected[x] += n * counts[word]
        probability = expected / expected.sum()
    return probability


class _Rows:
    """Rows of numbers by key; emptied when full."""

    def __init__(self, width: int):
        self.at: dict[str, int] = {}
        self.held = 0
        self.table = np.zeros((1024, width), dtype=np.float32)

    def add(self, keys: list[str], rows: np.ndarray) -> None:
        first = len(self.at)
        while len(self.table) < first + len(keys):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
        self.table[first : first + len(keys)] = rows
        self.at.update(zip(keys, range(first, first + len(keys))))

    def missing(self, keys: set[str]) -> list[str]:
        new = [k for k in keys if k not in self.at]
        self.held += sum(map(len, new))
        if self.at and (len(self.at) + len(new) > CACHED or self.held > HELD):
            self.at, self.table = {}, self.table[:1024]
            new = list(keys)
            self.held = sum(map(len, new))
        return new


class Scorer:
    """Log-probabilities of runs without white space under every language; runs and words met are kept up to a bound."""

    def __init__(self, probabilities: np.ndarray, path: str):
        self.probabilities, self.path = probabilities, path
        self.runs, self.words = _Rows(len(probabilities)), _Rows(len(probabilities))

    def learn(self, runs: set[str]) -> None:
        new = self.runs.missing(runs)
        words = [words_of(t) for t in new]
        unknown = self.words.missing({w for ws in words for w in ws})
        short = [w for w in unknown if len(w) <= LONGEST]
        for a in range(0, len(short), 5000):
            lattice = Lattice(part := short[a : a + 5000], self.path)
            logs = np.stack([lattice.totals(p) for p in self.probabilities], axis=1)
            for k in np.flatnonzero((logs <= np.log(SMALLEST)).any(axis=1)):
                logs[k] = scaled_total(part[k], self.probabilities, self.path)
            self.words.add(part, logs)
        for w in unknown:
            if len(w) > LONGEST:
                self.words.add([w], scaled_total(w, self.probabilities, self.path)[None])
        rows = np.zeros((len(new), len(self.probabilities)))
        at = self.words.at
        of = np.array([(i, at[w]) for i, ws in enumerate(words) for w in ws], dtype=np.int64).reshape(-1, 2)
        for c in range(rows.shape[1]):
            rows[:, c] = np.bincount(of[:, 0], self.words.table[of[:, 1], c], len(new))
        self.runs.add(new, rows)

    def __call__(self, batch: list[str]) -> np.ndarray:
        """Log-probability of each text under each language, 0 for texts without letters."""
        tokens = [t.lower().split() for t in batch]
        self.learn(set().union(*tokens))
        at = np.cumsum([0, *map(len, tokens)])
        known = self.runs.at
        every = np.array([known[t] for ts in tokens for t in ts], dtype=np.int64)
        out = np.zeros((len(batch), len(self.probabilities)))
        full = np.flatnonzero(np.diff(at))
        if len(full):
            out[full] = np.add.reduceat(self.runs.table[every].astype(np.float64), at[:-1][full], axis=0)
        return out


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the count of folds."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", path: str | None = None, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their piece probabilities, from the rows given; about ``sample`` documents of each."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    rows = small_batches(docs).where(F.col(lang).isNotNull())
    found = rows.groupBy(F.col(lang).alias("lang")).count().orderBy("lang").collect()
    if not found:
        return [], np.zeros((0, 0))
    share = F.create_map(*(F.lit(x) for r in found for x in (r["lang"], min(1.0, sample / r["count"]))))
    drawn = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 20)) / float(1 << 20) < F.element_at(share, F.col(lang))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: Counter = Counter()
            for x, t in zip(batch.column("lang").to_pylist(), texts(batch, "text")):
                counts.update((x, w) for token in t.lower().split() for w in words_of(token))
            yield pa.RecordBatch.from_pydict({"lang": [x for x, _ in counts], "word": [w for _, w in counts], "n": list(counts.values())}, schema=schema)

    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    counted = rows.where(drawn).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = counted.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def learn(key: tuple, words: pa.Table) -> pa.Table:
        counts = dict(zip(words.column("word").to_pylist(), words.column("n").to_pylist()))
        return pa.table({"lang": [key[0].as_py()], "p": pa.array([fit(counts, path).tolist()], pa.list_(pa.float64()))})

    fitted = sorted(counted.groupBy("lang").applyInArrow(learn, "lang string, p array<double>").collect(), key=lambda r: r["lang"])
    return [r["lang"] for r in fitted], np.array([r["p"] for r in fitted])


_scorers: dict[bytes, Scorer] = {}


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Rows (id, lang_pred, score), one for each document."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    languages, probabilities = model
    shared = docs.sparkSession.sparkContext.broadcast(probabilities.astype(np.float32))
    name = np.random.default_rng().bytes(8)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _scorers:
            _scorers.clear()
            _scorers[name] = Scorer(shared.value.astype(np.float64), path)
        for batch in slices(batches, "text"):
            body = texts(batch, "text")
            if languages:
                logs = _scorers[name](body)
                best = logs.argmax(axis=1)
                share = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            said = [languages and LETTERS.search(t) is not None for t in body]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([languages[best[i]] if ok else "und" for i, ok in enumerate(said)], pa.string()),
                    pa.array([float(share[i]) if ok else 0.0 for i, ok in enumerate(said)], pa.float64()),
                ],
                names=["id", "lang_pred", "score"],
            )

    rows = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")
