"""Runs (maximal periodicities) of words in texts, after Kolpakov and Kucherov.

A run is a stretch of consecutive words with a smallest period q that no neighbouring word extends. For the words of one
text: a suffix automaton gives its LZ factorisation (each factor is the longest stretch that also begins earlier, or a new
word). Runs that touch a factor's boundary are found by Main's extensions on both sides of it, in a window as long as the
factors beside it; every other run lies inside a factor and is copied from the factor's earlier occurrence. All of it is
linear in the words, but for sorting.

A run of at least four periods (``least`` in general) holds each of its words at least four times. So before the
factorisation the words of a whole batch of texts are cut, by array arithmetic, at all words that are rarer in their
stretch, again and again until nothing is cut; no run is lost or shortened by that, and only what recurs is factorised.

Texts are dealt out as they were read and never meet; a worker holds a few MB of them, or one text if that is longer.

Defined cases: a null or empty text has no words and no runs; of equal lengths the run with the smallest start and then
period is the longest; rows may repeat; a null id gives a row, and its text is not made periodic; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm.common import slices, small_batches, texts

LEAST, SHORTEST = 4, 6  #: periods and words of a run that counts
Run = tuple[int, int, int]  #: start, end (exclusive), period


class Automaton:
    """The suffix automaton of a sequence of numbers. Most states have one transition, so further ones lie in a table beside."""

    def __init__(self, word: Sequence[int]):
        self.letter, self.target, self.more = array("q", [-1]), array("q", [-1]), {}
        self.first_end = array("q", [-1])  #: where the first occurrence of a state's strings ends
        length, link = array("q", [0]), array("q", [-1])
        letter, target, more, first_end = self.letter, self.target, self.more, self.first_end
        last = 0
        for at, c in enumerate(word):
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            letter.append(-1)
            target.append(-1)
            first_end.append(at)
            p = last
            while p >= 0:
                if letter[p] == c:
                    q = target[p]
                    break
                if p in more and c in more[p]:
                    q = more[p][c]
                    break
                if letter[p] < 0:
                    letter[p], target[p] = c, new
                else:
                    more.setdefault(p, {})[c] = new
                p = link[p]
            if p >= 0:
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    letter.append(letter[q])
                    target.append(target[q])
                    first_end.append(first_end[q])
                    if q in more:
                        more[twin] = dict(more[q])
                    while p >= 0:
                        if letter[p] == c and target[p] == q:
                            target[p] = twin
                        elif p in more and more[p].get(c) == q:
                            more[p][c] = twin
                        else:
                            break
                        p = link[p]
                    link[q] = link[new] = twin
            last = new

    def step(self, state: int, c: int) -> int:
        if self.letter[state] == c:
            return self.target[state]
        return self.more[state].get(c, -1) if state in self.more else -1


def factors(word: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start, end, start of an earlier occurrence, or -1 for a new number): the LZ factorisation; occurrences may overlap."""
    automaton, found, i, n = Automaton(word), [], 0, len(word)
    step, first_end = automaton.step, automaton.first_end
    while i < n:
        state, j = 0, i
        while j < n:
            to = step(state, word[j])
            if to < 0 or first_end[to] >= j:
                break
            state, j = to, j + 1
        found.append((i, j, first_end[state] - (j - i) + 1) if j > i else (i, i + 1, -1))
        i = max(j, i + 1)
    return found


def _z(s: Sequence[int]) -> list[int]:
    """For each place the length of the longest stretch there that also begins the sequence."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _touching(word: Sequence[int], low: int, at: int, high: int, longest: int, least: int, shortest: int) -> Iterator[Run]:
    """Main's step: runs with a period up to ``longest`` that touch the boundary ``at`` and lie in low..high, perhaps with multiples
    of their periods."""
    n = len(word)
    before, behind = word[low:at], word[at:high]
    nx, ny = len(before), len(behind)
    turned = before[::-1]
    right = _z(behind)  # equal words to the right of at and at + q
    over = _z([*behind, -1, *before, *behind]) if ny else []  # of at - q and at
    left = _z(turned)  # to the left of at and at - q
    across = _z([*turned, -1, *behind[::-1], *turned]) if nx else []  # of at and at + q
    for q in range(1, min(longest, max(nx, ny)) + 1):
        spans = []
        if q <= nx:
            more, less = min(over[ny + 1 + nx - q], ny) if ny else 0, left[q] if q < nx else 0
            spans.append((at - q - less, at + more))
        if q <= ny:
            less, more = min(across[nx + 1 + ny - q], nx) if nx else 0, right[q] if q < ny else 0
            spans.append((at - less, at + q + more))
        for s, t in spans:
            if t - s >= max(least * q, shortest) and (s == 0 or s > low or word[s - 1] != word[s - 1 + q]) and (t == n or t < high or word[t] != word[t - q]):
                yield s, t, q


def runs(word: Sequence[int], least: int = 2, shortest: int = 2) -> list[Run]:
    """All runs of at least ``least`` (2 or more) periods and ``shortest`` numbers, by start and then period. Numbers are not negative."""
    word = list(word)
    smallest: dict[tuple[int, int], int] = {}  # of a stretch the smallest period
    starting: dict[int, set[int]] = {}
    size = 0
    cut = factors(word) if len(word) >= shortest else []
    for start, end, earlier in [*cut, (len(word), len(word), -1)] if cut else []:
        # Runs that end in this factor and begin at or before its start, or in the factor before and end at its start.
        longest = (size + end - start) // (least - 1)
        low = max(0, start - size - longest)
        for s, t, q in _touching(word, low, start, end, longest, least, shortest) if start else ():
            if smallest.get((s, t), q + 1) > q:
                smallest[s, t] = q
                starting.setdefault(s, set()).add(t)
        if earlier >= 0:  # the runs inside, without its first and last place
            back = start - earlier
            for s in range(start + 1, end - 1):
                for t in starting.get(s - back, ()):
                    if t + back < end:
                        smallest[s, t + back] = smallest[s - back, t]
                        starting.setdefault(s, set()).add(t + back)
        size = end - start
    return sorted(((s, t, q) for (s, t), q in smallest.items()), key=lambda r: (r[0], r[2]))


def recurring(numbers: np.ndarray, of: np.ndarray, least: int = LEAST, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Stretches (start, end) in which every number occurs at least ``least`` times, which hold all runs of so many periods.

    ``of`` tells the text of each place, and rises.
    """
    at = np.arange(len(numbers))
    part = np.cumsum(np.concatenate(([0], (np.diff(of) != 0).astype(np.int64)))) if len(of) else of
    most = int(numbers.max(initial=0)) + 1
    while len(at):
        _, which, count = np.unique(part * most + numbers[at], return_inverse=True, return_counts=True)
        keep = count[which] >= least
        whole = bool(keep.all())
        at, was = at[keep], part[keep]
        if not len(at):
            return []
        fresh = np.concatenate(([0], ((np.diff(at) != 1) | (np.diff(was) != 0)).astype(np.int64)))
        part = np.cumsum(fresh)
        sizes = np.bincount(part)
        long = sizes[part] >= shortest
        if whole and long.all():
            first = np.flatnonzero(np.concatenate(([1], fresh[1:])))
            return list(zip(at[first].tolist(), (at[first] + sizes).tolist()))
        at, part = at[long], part[long]
    return []


def runs_of_texts(batch: list[list[bytes]], least: int = LEAST, shortest: int = SHORTEST) -> list[list[Run]]:
    """The runs of each list of words."""
    known: dict[bytes, int] = {}
    for words in batch:
        for w in set(words):
            known.setdefault(w, len(known))
    sizes = np.array([len(words) for words in batch], dtype=np.int64)
    numbers = np.fromiter((known[w] for words in batch for w in words), dtype=np.int64, count=int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    found: list[list[Run]] = [[] for _ in batch]
    for a, b in recurring(numbers, np.repeat(np.arange(len(batch)), sizes), least, shortest):
        k = int(np.searchsorted(begins, a, side="right")) - 1
        while not sizes[k]:
            k -= 1
        shift = a - int(begins[k])
        _, own = np.unique(numbers[a:b], return_inverse=True)
        found[k] += [(s + shift, t + shift, q) for s, t, q in runs(own.tolist(), least, shortest)]
    return found


def words_of(text: str) -> list[bytes]:
    """The runs of bytes other than space and 9 to 13."""
    return text.encode().split()


def periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a test text: of every tenth id, by crc32, the words from some place on repeat the first of them."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def kept(words: list[bytes], found: list[Run]) -> list[bytes]:
    """Without the words that a run holds after its first period."""
    if not found:
        return words
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(drop, [s + q for s, _, q in found], 1)
    np.add.at(drop, [t for _, t, _ in found], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


SCHEMA = "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, shortest: int = SHORTEST, plant: bool = False) -> DataFrame:
    """Rows (id, n_words, runs by start and period, collapsed): one for each document; ``plant`` makes every tenth text periodic."""
    if least < 2:
        raise ValueError("a run has at least two periods")
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            ids = batch.column("id").to_pylist()
            words = [periodic(words_of(t), i) if plant else words_of(t) for t, i in zip(texts(batch, "text"), ids)]
            found = runs_of_texts(words, least, shortest)
            short = [b" ".join(kept(w, r)).decode() for w, r in zip(words, found)]
            spans = [[{"start": s, "length": t - s, "period": q} for s, t, q in r] for r in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), pa.array(spans, run), pa.array(short, pa.string())], ["id", "n_words", "runs", "collapsed"]
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return small_batches(rows).mapInArrow(scan, SCHEMA)


def run_digests(found: DataFrame) -> DataFrame:
    """The columns of the contract, from the runs."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    said = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    rows = found.withColumn("top", longest)
    return rows.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.n")).alias("length"), F.col("top.period").alias("period"),
        F.expr("1000 * -top.n div top.period").alias("exponent_milli"), F.sha2(said, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
