"""One big JSON document, read by many tasks (S4): the elements of an array that is a member of the document's object.

The file is cut into byte ranges. Whether a range begins inside a string, and how deep, depends on all before it, so each
range is first summed up under both assumptions, which needs no knowledge of the others; composing the sums in order, a row a
range, gives every range's true beginning. With that, a second pass finds where the member's array begins and ends, and the
reader, a data source whose partitions are the ranges, gives the elements that begin in its range, reading on past its end
for the last one. A task holds a range and an element, never the document.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

QUOTE, BACKSLASH, COMMA = ord('"'), ord("\\"), ord(",")
SPACE = b" \t\r\n"
NAME = "json_elements"
#: Bytes before an array's bracket in which its member's name must lie, white space included.
NAME_BYTES = 4096


def _file(path: str):
    from pyarrow import fs

    for ours, theirs in (("s3a://", "s3://"), ("s3n://", "s3://")):  # Spark's names for stores that pyarrow calls otherwise
        if path.startswith(ours):
            path = theirs + path[len(ours) :]
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///") if path.startswith("file:/") and not path.startswith("file://") else path)


def _read(path: str, start: int, end: int) -> bytes:
    files, at = _file(path)
    with files.open_input_file(at) as f:
        return f.read_at(max(0, end - start), start)


def _size(path: str) -> int:
    files, at = _file(path)
    return files.get_file_info(at).size


def _escaped_start(path: str, start: int) -> bool:
    """Whether the byte at start is escaped: an odd run of backslashes stands before it."""
    run, step = 0, 64
    while start - run > 0:
        before = _read(path, max(0, start - run - step), start - run)
        kept = len(before.rstrip(b"\\"))
        run += len(before) - kept
        if kept:
            break
    return run % 2 == 1


def _quotes(code: np.ndarray, escaped: bool) -> np.ndarray:
    """Where unescaped quotes stand."""
    slash = np.flatnonzero(code == BACKSLASH)
    quote = np.flatnonzero(code == QUOTE)
    if not len(slash) and not escaped:
        return quote
    # A quote is escaped by an odd run of backslashes before it; a run at the very beginning goes on from the range before.
    first = slash[np.concatenate(([True], np.diff(slash) > 1))] if len(slash) else slash
    last = slash[np.concatenate((np.diff(slash) > 1, [True]))] if len(slash) else slash
    run = np.zeros(len(code) + 1, dtype=np.int64)
    run[last + 1] = last - first + 1
    if escaped:
        run[last[0] + 1 if len(slash) and first[0] == 0 else 0] += 1
    return quote[run[quote] % 2 == 0]


def _depths(code: np.ndarray, quotes: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of brackets and commas outside strings, and the depth after each, counted from 0 at the beginning."""
    marks = np.flatnonzero(np.isin(code, np.frombuffer(b"{}[],", np.uint8)))
    outside = (np.searchsorted(quotes, marks) + inside) % 2 == 0
    marks = marks[outside]
    step = np.where((code[marks] == 123) | (code[marks] == 91), 1, np.where(code[marks] == COMMA, 0, -1))
    return marks, np.cumsum(step)


def _summary(path: str, start: int, end: int) -> tuple[int, int, int]:
    """Quotes in a range, and how much deeper it ends than it begins if it begins outside and inside a string."""
    code = np.frombuffer(_read(path, start, end), np.uint8)
    quotes = _quotes(code, _escaped_start(path, start))
    deeper = [int(d[-1]) if len(d := _depths(code, quotes, inside)[1]) else 0 for inside in (False, True)]
    return len(quotes), *deeper


def _array_ends(path: str, start: int, end: int, inside: bool, depth: int, member: str) -> tuple[list[int], list[int]]:
    """Where, in a range, the member's array begins (behind its bracket), and where arrays of the object's members end."""
    raw = _read(path, start, end)
    code = np.frombuffer(raw, np.uint8)
    marks, deep = _depths(code, _quotes(code, _escaped_start(path, start)), inside)
    deep, kind = deep + depth, code[marks]
    begins = []
    for at in marks[(kind == 91) & (deep == 2)].tolist():
        before = raw[:at] if at >= NAME_BYTES else _read(path, max(0, start + at - NAME_BYTES), start + at)
        before = before[-NAME_BYTES:].rstrip(SPACE)
        if before.endswith(b":") and (name := before[:-1].rstrip(SPACE)).endswith(b'"'):
            # The name is the shortest text up to here that is a JSON string.
            at_quote = name.rfind(b'"', 0, len(name) - 1)
            while at_quote > 0 and (len(name[:at_quote]) - len(name[:at_quote].rstrip(b"\\"))) % 2:
                at_quote = name.rfind(b'"', 0, at_quote)
            if at_quote >= 0 and json.loads(name[at_quote:]) == member:
                begins.append(start + at + 1)
    return begins, (start + marks[(kind == 93) & (deep == 1)]).tolist()


def _elements(path: str, start: int, end: int, inside: bool, depth: int, begin: int, stop: int, step: int = 1 << 20) -> Iterator[bytes]:
    """The elements of the array from begin to stop whose bracket or comma lies before them in the range."""
    start, end = max(start, begin) if start <= begin < end else start, min(end, stop)
    if start >= end:
        return
    first = start == begin
    if first:
        inside, depth = False, 2
    held, base, escaped, cuts = _read(path, start, end), start, _escaped_start(path, start), []
    while True:
        code = np.frombuffer(held, np.uint8)
        marks, deep = _depths(code, _quotes(code, escaped), inside)
        cuts = marks[(code[marks] == COMMA) & (deep + depth == 2)]
        own = cuts[cuts < end - base]
        # What begins behind the last comma of the range is this range's: read on to the comma that ends it.
        if base + len(held) >= stop or len(cuts) > len(own):
            break
        held += _read(path, base + len(held), min(stop, base + len(held) + step))
        step *= 2
    starts = ([0] if first else []) + (own + 1).tolist()
    if not starts:
        return
    ends = [*starts[1:], None]
    for a, b in zip(starts, ends, strict=True):
        if b is None:
            b = int(cuts[len(own)]) if len(cuts) > len(own) else stop - base
        else:
            b -= 1
        text = held[a:b].strip(SPACE)
        if text:
            yield text


class Range(InputPartition):
    def __init__(self, start: int, end: int, inside: bool, depth: int):
        self.start, self.end, self.inside, self.depth = start, end, inside, depth


class ElementsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.begin, self.stop = options["path"], int(options["begin"]), int(options["stop"])
        self.ranges = [Range(*r) for r in json.loads(options["ranges"])]

    def partitions(self) -> list[Range]:
        return self.ranges

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for element in _elements(self.path, part.start, part.end, part.inside, part.depth, self.begin, self.stop):
            held.append(element.decode("utf-8", "replace"))
            size += len(element)
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])


class JsonElements(DataSource):
    """Elements as JSON texts, column value. Options: path, begin, stop and ranges, as scan_json_elements() works them out."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> ElementsReader:
        return ElementsReader(self.options)


def scan_json_elements(spark: SparkSession, path: str, member: str, range_bytes: int = 16 << 20) -> DataFrame:
    """The elements of a member's array, each as JSON text (value), of one document that is an object.

    The document has to be valid JSON in UTF-8. A member that is absent, or isn't an array, has no elements; of a repeated
    one the first counts; null elements are the text null. The path must be one that pyarrow's file systems open.
    """
    size = _size(path)
    cuts = [*range(0, size, range_bytes), size]
    spans = list(enumerate(zip(cuts[:-1], cuts[1:], strict=True)))
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in spans], "i int, a bigint, b bigint").repartition(max(1, len(spans)), "i")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(i, *_summary(path, a, b)) for i, a, b in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*made, strict=True) if made else [()] * 4)], names=["i", "quotes", "out", "in"])

    inside, depth, states = False, 0, []
    for r in sorted(rows.mapInArrow(summed, "i bigint, quotes bigint, out bigint, in bigint").collect()):  # a row a range
        a, b = spans[r.i][1]
        states.append((a, b, inside, depth))
        inside, depth = inside ^ (r.quotes % 2 == 1), depth + (r["in"] if inside else r.out)
    known = spark.createDataFrame(states, "a bigint, b bigint, inside boolean, depth bigint").repartition(max(1, len(spans)), "a") if states else None

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, what = [], []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                begins, ends = _array_ends(path, *row, member)
                at += begins + ends
                what += [True] * len(begins) + [False] * len(ends)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(what, pa.bool_())], names=["at", "begins"])

    found = known.mapInArrow(bracketed, "at bigint, begins boolean") if known is not None else None
    begin = found.filter("begins").agg({"at": "min"}).first()[0] if found is not None else None
    stop = found.filter(f"not begins and at >= {begin}").agg({"at": "min"}).first()[0] if begin is not None else None
    if stop is None:
        return spark.createDataFrame([], "value string")
    spark.dataSource.register(JsonElements)
    ranges = json.dumps([s for s in states if s[1] > begin and s[0] < stop])
    return spark.read.format(NAME).option("path", path).option("begin", begin).option("stop", stop).option("ranges", ranges).load()
