"""Large single files read in many tasks, whose records no fixed mark divides.

A JSON array and a CSV file with newlines inside quotes can be cut anywhere only if one
knows whether the cut lies in quotes. Each byte range first tells what it would do to
the state from either one (a few numbers); the running sums over a file's ranges give each
its true state; then each range reads the records that begin in it, beyond its end where the last
one goes on. No task reads more than its range and the end of one record.

Both functions read through Arrow's file systems (local, HDFS, S3 and the like), and
take a file or a folder, whose files with names in `_` or `.` are passed over.
"""

from __future__ import annotations

import csv
import io
import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from textmart.sources import files
from textmart.sources.files import shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(files)

RANGE_BYTES = 16 << 20
MORE = 1 << 20
QUOTE, BACKSLASH, COMMA = 34, 92, 44
OPEN, CLOSE = np.zeros(256, bool), np.zeros(256, bool)
OPEN[list(b"[{")], CLOSE[list(b"]}")] = True, True
BLANK = np.zeros(256, bool)
BLANK[list(b" \t\r\n")] = True


def byte_ranges(spark: SparkSession, path: str, size: int) -> list[tuple[str, int, int, int]]:
    """(file, start, end, file's size) of the files at a path; none where it is missing."""
    system, name = shared(path)
    info = system.get_file_info(name)
    if info.type == pafs.FileType.NotFound:
        return []
    found = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(name))
    scheme = path.split("://", 1)[0] + "://" if "://" in path else ""
    kept = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "_.")
    return [(scheme + p, at, min(at + size, n), n) for p, n in kept for at in range(0, n, size)]


def bytes_of(uri: str, start: int, end: int) -> np.ndarray:
    system, path = shared(uri)
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read_at(end - start, start), np.uint8)


def spread(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """One row for each range, one range to a task."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, "number INT, " + schema).repartitionById(max(len(rows), 1), "number").drop("number")


def table_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


# --- CSV ----------------------------------------------------------------------


def csv_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, list[str]]:
    """(file, place, fields) of the records of CSV files whose quoted fields may hold newlines, and the header's names.

    Quotes inside a quoted field are doubled; a field that holds quotes is quoted. `place` is
    where a record begins. All files have the header of the first; a file without a record is passed over.
    """
    ranges = byte_ranges(spark, path, range_bytes)
    if not ranges:
        return spark.createDataFrame([], "file STRING, place LONG, fields ARRAY<STRING>"), []

    def parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, end, _ in table_rows(batches):
            odd = int((bytes_of(file, start, end) == QUOTE).sum() % 2)
            yield pa.record_batch([pa.array([file]), pa.array([start]), pa.array([odd])], names=["file", "start", "odd"])

    schema = "file STRING, start LONG, `end` LONG, size LONG"
    # A few numbers for each range.
    odd = {(r.file, r.start): r.odd for r in spread(spark, ranges, schema).mapInArrow(parities, "file STRING, start LONG, odd LONG").collect()}
    inside, states = defaultdict(int), []
    for file, start, end, size in ranges:
        states.append((file, start, end, size, bool(inside[file])))
        inside[file] ^= odd[file, start]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, end, size, quoted in table_rows(batches):
            data, places = whole_records(file, start, end, size, quoted)
            rows = []
            for low, high in places:
                text = data[low:high].tobytes().decode("utf-8", "replace").removesuffix("\r")
                fields = next(csv.reader(io.StringIO(text, newline="")), [])
                if fields:
                    rows.append((file, start + low, [f if f else None for f in fields]))
            for i in range(0, len(rows), 1000):
                part = list(zip(*rows[i : i + 1000]))
                yield pa.record_batch([pa.array(part[0]), pa.array(part[1], pa.int64()), pa.array(part[2], pa.list_(pa.string()))], names=["file", "place", "fields"])

    every = spread(spark, states, schema + ", quoted BOOLEAN").mapInArrow(records, "file STRING, place LONG, fields ARRAY<STRING>")
    header = every.where("place = 0").orderBy("file").first()
    return every.where("place > 0"), [] if header is None else list(header.fields)


def whole_records(file: str, start: int, end: int, size: int, quoted: bool) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The range's bytes with those that its last record goes on to, and where each record that begins in it begins and ends."""
    data, own = bytes_of(file, start, end), end - start

    def ends(block: np.ndarray, quoted: bool) -> np.ndarray:
        return np.flatnonzero((block == 10) & ((np.cumsum(block == QUOTE) + quoted) % 2 == 0))

    breaks = ends(data, quoted).tolist()
    at = 0
    if start and (quoted or bytes_of(file, start - 1, start)[0] != 10):
        # The range begins within a record of another one.
        at = breaks.pop(0) + 1 if breaks else own
    places = []
    for stop in breaks:
        places.append((at, stop))
        at = stop + 1
    now = bool((int((data == QUOTE).sum()) + quoted) % 2)
    while at < own:
        if end == size:
            places.append((at, len(data)))
            break
        block = bytes_of(file, end, min(end + MORE, size))
        found = ends(block, now)
        if len(found):
            places.append((at, len(data) + int(found[0])))
        now ^= bool((block == QUOTE).sum() % 2)
        data, end = np.concatenate([data, block]), end + len(block)
        if len(found):
            break
    return data, places


# --- JSON ---------------------------------------------------------------------


def outside(data: np.ndarray, in_string: bool, odd_before: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Which bytes lie in no string; which are a string's quotes; and whether the data end in a string.

    A quote after an odd number of backslashes is none; `odd_before`: such a number ends before the data.
    """
    quote = np.flatnonzero(data == QUOTE)
    other = np.flatnonzero(data != BACKSLASH)
    # The run of backslashes before each quote.
    at = np.searchsorted(other, quote) - 1
    run = quote - 1 - np.where(at >= 0, other[at], -1)
    odd = (run + ((at < 0) & odd_before)) % 2 == 1
    flips = np.zeros(len(data), bool)
    flips[quote[~odd]] = True
    count = np.cumsum(flips, dtype=np.int32) + in_string
    return (count % 2 == 0) & ~flips, flips, bool(count[-1] % 2) if len(data) else in_string


def backslashes_before(file: str, start: int) -> bool:
    """Whether an odd number of backslashes ends before a place."""
    n, at = 0, start
    while at > 0:
        low = max(at - 4096, 0)
        others = np.flatnonzero(bytes_of(file, low, at) != BACKSLASH)
        if len(others):
            return (n + at - low - 1 - int(others[-1])) % 2 == 1
        n, at = n + at - low, low
    return n % 2 == 1


def depths(data: np.ndarray, free: np.ndarray) -> np.ndarray:
    """How many brackets are open after each byte, beyond those before the data."""
    return np.cumsum((OPEN[data] & free).astype(np.int8) - (CLOSE[data] & free).astype(np.int8), dtype=np.int32)


def json_elements(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, place, element) of the objects of JSON arrays, each file one array, as JSON text.

    A file that is no array of objects from its first to its last bracket gives an `element`
    that is NULL, at the place where this was seen: the reader drops such a file.
    """
    ranges = byte_ranges(spark, path, range_bytes)
    if not ranges:
        return spark.createDataFrame([], "file STRING, place LONG, element STRING")

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, end, _ in table_rows(batches):
            data, odd = bytes_of(file, start, end), backslashes_before(file, start)
            row = [file, start]
            for state in (False, True):
                free, _, last = outside(data, state, odd)
                row += [last, int(depths(data, free)[-1])]
            yield pa.record_batch([pa.array([x]) for x in [*row, odd]], names=["file", "start", "last0", "depth0", "last1", "depth1", "odd"])

    schema = "file STRING, start LONG, `end` LONG, size LONG"
    # A few numbers for each range.
    told = spread(spark, ranges, schema).mapInArrow(effects, "file STRING, start LONG, last0 BOOLEAN, depth0 LONG, last1 BOOLEAN, depth1 LONG, odd BOOLEAN")
    effect = {(r.file, r.start): r for r in told.collect()}
    now, states = defaultdict(lambda: (False, 0)), []
    for file, start, end, size in ranges:
        (in_string, depth), e = now[file], effect[file, start]
        states.append((file, start, end, size, in_string, depth, e.odd))
        now[file] = (e.last1, depth + e.depth1) if in_string else (e.last0, depth + e.depth0)

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, end, size, in_string, depth, odd in table_rows(batches):
            rows = [(file, start + place, text) for place, text in range_elements(file, start, end, size, in_string, depth, odd)]
            for i in range(0, len(rows), 1000):
                part = list(zip(*rows[i : i + 1000]))
                yield pa.record_batch([pa.array(part[0]), pa.array(part[1], pa.int64()), pa.array(part[2], pa.string())], names=["file", "place", "element"])

    return spread(spark, states, schema + ", in_string BOOLEAN, depth LONG, odd BOOLEAN").mapInArrow(elements, "file STRING, place LONG, element STRING")


# What may follow each mark at the level of the array itself.
FOLLOWS = {"[": "{]", "{": "}", "}": ",]", ",": "{"}


def range_elements(file: str, start: int, end: int, size: int, in_string: bool, depth: int, odd: bool) -> Iterator[tuple[int, str | None]]:
    """The objects that begin in a range; (place, None) where the file is no array of objects."""
    data, own = bytes_of(file, start, end), end - start
    while True:
        free, quotes, _ = outside(data, in_string, odd)
        after = depths(data, free) + depth
        before = np.concatenate([[depth], after[:-1]])
        # The array's brackets, its objects' braces, commas between them, and whatever else stands there.
        level = np.flatnonzero((free | quotes) & ~BLANK[data] & ((before <= 1) | (after <= 1)))
        mine = int(np.searchsorted(level, own))
        # The range's last mark is judged by the next one; an object's next mark is its end.
        if not mine or len(level) > mine or end == size:
            break
        block = bytes_of(file, end, min(end + MORE, size))
        data, end = np.concatenate([data, block]), end + len(block)
    marks = [chr(b) for b in data[level].tolist()]
    if start == 0 and marks[:1] != ["["]:
        yield 0, None
    for k in range(mine):
        mark, at = marks[k], int(level[k])
        if k + 1 == len(marks):
            if mark != "]":
                yield at, None
        elif marks[k + 1] not in FOLLOWS.get(mark, ""):
            yield at, None
        elif mark == "{":
            yield at, data[at : level[k + 1] + 1].tobytes().decode("utf-8", "replace")
