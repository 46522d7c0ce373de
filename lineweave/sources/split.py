"""A scan of GeoJSON collections of any size by many tasks, however the file is laid out.

Files are cut into ranges of bytes. What a range begins in (inside a string or not, at which depth) depends on all before
it, so a first pass sums each range up under both assumptions, by array arithmetic; the sums, three numbers for a range,
are put together in order. A second pass then knows where it stands: each range cuts out the objects that begin in it at
the depth of features, reading on behind its end for the last one, and Spark parses their text by the schema.

Ranges are read with ranged reads of the file's store. Keys may stand in any order, and strings may hold anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSelector, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineweave.sources.files import store
from lineweave.sources.geojson import decoded, feature_type

RANGE = 32 << 20
DEPTH = 2  #: brackets that are open around a feature: the collection's and those of its features
_BACK = 1 << 16

QUOTE, ESCAPE = ord('"'), ord("\\")
_TURN = np.zeros(256, dtype=np.int8)
_TURN[[ord("{"), ord("[")]] = 1
_TURN[[ord("}"), ord("]")]] = -1


def files(path: str | list[str]) -> list[tuple[str, int]]:
    """(path, size) of a file, a list of files or all files of a folder, in order."""
    found = []
    for one in [path] if isinstance(path, str) else path:
        system, place = store(one)
        info = system.get_file_info(place)
        below = system.get_file_info(FileSelector(place)) if info.type == FileType.Directory else [info]
        head = one[: len(one) - len(place)] if one.endswith(place) else ""
        found += sorted((head + f.path, f.size) for f in below if f.type == FileType.File and not f.base_name.startswith(("_", ".")))
    return found


def quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that aren't escaped, if the first byte isn't."""
    at = np.flatnonzero(data == QUOTE)
    escapes = data == ESCAPE
    if not escapes.any():
        return at
    run = np.arange(len(data)) - np.maximum.accumulate(np.where(escapes, -1, np.arange(len(data))))  # backslashes up to each place
    before = np.where(at > 0, run[at - 1], 0)
    before = np.where((at > 0) & ~escapes[at - 1], 0, before)
    return at[before % 2 == 0]


def _slice(file, start: int, end: int) -> tuple[np.ndarray, bytes]:
    """The bytes of a range that begins, and the next one too, at the first place from its start that no backslash precedes."""

    def settled(at: int) -> int:
        while at > 0:
            file.seek(at - 1)
            more = file.read(_BACK)
            for k, byte in enumerate(more):
                if byte != ESCAPE:
                    return at + k
            if len(more) < _BACK:
                return at + len(more)
            at += _BACK
        return 0

    start, end = settled(start), settled(end)
    file.seek(start)
    raw = file.read(max(0, end - start))
    return np.frombuffer(raw, dtype=np.uint8), raw


def summary(data: np.ndarray) -> tuple[bool, int, int]:
    """Whether the range ends on the other side of a string's quotes, and how many brackets it opens if it begins outside or inside one."""
    marks = quotes(data)
    turns = np.flatnonzero(_TURN[data])
    inside = np.searchsorted(marks, turns) % 2 == 1
    value = _TURN[data[turns]]
    return len(marks) % 2 == 1, int(value[~inside].sum()), int(value[inside].sum())


def _objects(file, data: np.ndarray, raw: bytes, end: int, inside: bool, depth: int) -> Iterator[str]:
    """The text of each object that begins in the range at ``DEPTH``, whole."""
    marks, turns = quotes(data), np.flatnonzero(_TURN[data])
    turns = turns[np.searchsorted(marks, turns) % 2 == (1 if inside else 0)]
    level = depth + np.cumsum(_TURN[data[turns]])
    opens = turns[(data[turns] == ord("{")) & (level == DEPTH + 1)]
    closes = turns[(data[turns] == ord("}")) & (level == DEPTH)]
    ends = np.append(closes, len(data))[np.searchsorted(closes, opens)]
    for a, b in zip(opens.tolist(), ends.tolist()):
        if b < len(data):
            yield raw[a : b + 1].decode()
            continue
        # The last one goes on behind the range.
        text, open_, string, escaped = bytearray(raw[a:]), int(level[-1]) - DEPTH, (len(marks) % 2 == 1) != inside, False
        file.seek(end)
        while open_ > 0 and (more := file.read(_BACK)):
            for k, byte in enumerate(more):
                if string:
                    string = escaped or byte != QUOTE
                    escaped = byte == ESCAPE and not escaped
                elif byte == QUOTE:
                    string = True
                elif _TURN[byte]:
                    open_ += int(_TURN[byte])
                    if open_ == 0:
                        text += more[: k + 1]
                        break
            else:
                text += more
        yield text.decode()


def read_split(spark: SparkSession, path: str | list[str], properties: T.StructType, size: int = RANGE) -> DataFrame:
    """Rows (kind, g, the properties) of collections, read in ranges of ``size`` bytes, a task for each or for some.

    ``path`` is a file, a folder or a list of them, as a local path or with the scheme of a store that pyarrow can read. Objects
    of other lists beside the features, and files without features, give no row.
    """
    ranges = [(f, a, min(a + size, n)) for f, n in files(path) for a in range(0, n, size)]
    if not ranges:
        raise FileNotFoundError(f"no file at {path}")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                system, place = store(r["file"])
                with system.open_input_file(place) as file:
                    data, raw = _slice(file, r["a"], r["b"])
                odd, outside, within = summary(data)
                yield pa.RecordBatch.from_pylist([{"no": r["no"], "odd": odd, "outside": outside, "within": within}])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                system, place = store(r["file"])
                with system.open_input_file(place) as file:
                    data, raw = _slice(file, r["a"], r["b"])
                    texts, held = [], 0
                    for text in _objects(file, data, raw, file.tell(), r["inside"], r["depth"]) if len(data) else ():
                        texts.append(text)
                        held += len(text)
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_pydict({"text": texts})
                            texts, held = [], 0
                    yield pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})

    # A task for each range, or for several small ones, which it reads one after another.
    tasks = min(len(ranges), max(4 * spark.sparkContext.defaultParallelism, sum(b - a for _, a, b in ranges) // RANGE + 1))

    def dealt(rows: list[tuple], kind: str) -> DataFrame:
        return spark.createDataFrame(rows, kind).repartitionByRange(tasks, "no")

    found = dealt([(k, *r) for k, r in enumerate(ranges)], "no long, file string, a long, b long").mapInArrow(sums, "no long, odd boolean, outside long, within long").collect()
    states, inside, depth, last = [], False, 0, None
    for k, r in enumerate(sorted(found, key=lambda r: r["no"])):
        if ranges[k][0] != last:
            inside, depth, last = False, 0, ranges[k][0]
        states.append((k, *ranges[k], inside, depth))
        depth += r["within"] if inside else r["outside"]
        inside = inside != r["odd"]
    texts = dealt(states, "no long, file string, a long, b long, inside boolean, depth long").mapInArrow(cut, "text string")
    shape = T.StructType([*feature_type(properties), T.StructField("type", T.StringType())])
    return decoded(texts.select(F.from_json("text", shape).alias("f")).where("f.type = 'Feature'"))
