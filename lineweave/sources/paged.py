"""Layers that come in pages from a service: fetched by many tasks, tried again, and resumed.

Each page is a file of its own in a folder that all executors share. A page is fetched by a function that the caller
gives, checked, written under a name that readers pass over and renamed, so what has a page's name is whole. A later call
fetches only what isn't there. A page may be larger than memory if the function gives it in blocks: these are checked and
written as they come.
"""

from __future__ import annotations

import codecs
import collections
import json
import re
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.sources.split import store


def page_name(page: int) -> str:
    return f"page_{page:06d}.geojson"


class _Text:
    """Blocks of bytes as a file that is read once."""

    def __init__(self, blocks: Iterable[bytes]):
        self.blocks, self.rest = iter(blocks), b""

    def read(self, n: int) -> bytes:
        while len(self.rest) < n and (more := next(self.blocks, None)) is not None:
            self.rest += more
        out, self.rest = self.rest[:n], self.rest[n:]
        return out


_BLANK, _NUMBER = re.compile(r"[ \t\n\r]*"), re.compile(r"[-+.0-9eE]*\Z")
_PIECE = 1 << 20


class _Reader:
    """Values of a JSON text one after another; of the text, a piece and the value at hand are held."""

    def __init__(self, blocks: Iterable[bytes]):
        self.file, self.decode = _Text(blocks), codecs.getincrementaldecoder("utf-8")().decode
        self.text, self.at, self.whole, self.parse = "", 0, False, json.JSONDecoder().raw_decode

    def more(self) -> bool:
        raw = self.file.read(max(_PIECE, len(self.text) - self.at))  # twice as much each time, so a long value takes linear time
        self.whole = not raw
        self.text, self.at = self.text[self.at :] + self.decode(raw, self.whole), 0
        return not self.whole

    def next(self) -> str:
        """The next sign that isn't blank, not taken; nothing at the end."""
        while True:
            self.at = _BLANK.match(self.text, self.at).end()
            if self.at < len(self.text) or not self.more():
                return self.text[self.at : self.at + 1]

    def take(self, *signs: str) -> str:
        if (found := self.next()) not in signs or not found:
            raise ValueError(f"a page with {found!r} for one of {signs}")
        self.at += 1
        return found

    def value(self) -> object:
        self.next()
        while True:
            try:
                found, end = self.parse(self.text, self.at)
                # A number at the end of the piece may go on.
                if end < len(self.text) or self.whole or not _NUMBER.match(self.text, self.at):
                    self.at = end
                    return found
            except ValueError:
                if self.whole:
                    raise
            self.more()

    def items(self, close: str) -> Iterator[None]:
        """Stops before each item of a list or object that has been opened."""
        if self.next() == close:
            self.take(close)
            return
        while True:
            yield
            if self.take(",", close) == close:
                return


def features_of(payload: bytes | Iterable[bytes]) -> int:
    """Count of the features of a page, whole or in blocks; raises where it is something else, such as an error that came with
    status 200. Features are read one by one."""
    page, count = _Reader([payload] if isinstance(payload, (bytes, bytearray)) else payload), None
    if page.next() != "{":
        raise ValueError("a page that isn't an object")
    page.take("{")
    for _ in page.items("}"):
        key = page.value()
        if not isinstance(key, str):
            raise ValueError("a page with a key that isn't text")
        page.take(":")
        listed = key == "features" and page.next() == "["
        if not listed:
            page.value()
            count = None if key == "features" else count
            continue
        page.take("[")
        count = 0
        for _ in page.items("]"):
            page.value()
            count += 1
    if page.next():
        raise ValueError("a page with more behind its end")
    if count is None:
        raise ValueError("a page without features")
    return count


def _copied(blocks: Iterable[bytes], to) -> Iterator[bytes]:
    for block in blocks:
        to.write(block)
        yield block


def fetch_pages(
    spark: SparkSession, pages: int, fetch: Callable[[int, int], bytes | Iterable[bytes]], folder: str, tries: int = 3, wait: float = 1.0, check: Callable[[bytes | Iterable[bytes]], int] = features_of, at_once: int | None = None
) -> DataFrame:
    """(page, state, tries, error) of pages 0 to ``pages``: "kept" if it was there, "fetched", or "failed" after so many tries.

    ``fetch`` gets the page and the number of the try, from 0, and gives its bytes, at once or in
    blocks, which ``check`` then gets in blocks too; what it or ``check`` raises makes for another try, after ``wait`` seconds, then twice as many, and so on. ``at_once`` bounds the tasks that ask the service.
    """
    system, place = store(folder)
    system.create_dir(place, recursive=True)
    there = {f.base_name for f in system.get_file_info(FileSelector(place)) if f.type == FileType.File}
    missing = [k for k in range(pages) if page_name(k) not in there]

    def load(page: int) -> tuple[str, int, str | None]:
        system, place = store(folder)
        for n in range(tries):
            try:
                payload, hidden = fetch(page, n), f"{place}/_{uuid.uuid4().hex}"
                if whole := isinstance(payload, (bytes, bytearray)):
                    check(payload)
                try:
                    with system.open_output_stream(hidden) as to:
                        if whole:
                            to.write(payload)
                        else:
                            check(rest := _copied(payload, to))
                            collections.deque(rest, 0)  # what the check left
                except BaseException:
                    system.delete_file(hidden)
                    raise
            except Exception as e:  # whatever a service does, the other pages go on
                error = f"{type(e).__name__}: {e}"
                if n + 1 < tries:
                    time.sleep(wait * 2**n)
                continue
            system.move(hidden, f"{place}/{page_name(page)}")
            return "fetched", n + 1, None
        return "failed", tries, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, *load(k)) for k in batch.column("page").to_pylist()]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*found), kinds)], ["page", "state", "tries", "error"])

    shape = "page long, state string, tries int, error string"
    kept = spark.range(pages).select(F.col("id").alias("page"), F.lit("kept").alias("state"), F.lit(0).alias("tries"), F.lit(None).cast("string").alias("error"))
    if not missing:
        return kept
    tasks = min(len(missing), at_once or spark.sparkContext.defaultParallelism)
    asked = spark.createDataFrame([(k, i % tasks) for i, k in enumerate(missing)], "page long, task int").repartition(tasks, "task")
    # The rows tell what was done, so they are made once, here.
    done = spark.createDataFrame(asked.mapInArrow(run, shape).collect(), shape)
    return kept.join(done, "page", "left_anti").unionByName(done)
