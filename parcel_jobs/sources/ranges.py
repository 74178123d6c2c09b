"""Delimited text with quoted line breaks, read by ranges of bytes: a file is as many tasks as it has ranges.

Whether a byte lies inside quotes depends on all that precedes it. Runs of quotes tell: a run of even length changes
nothing. One of odd length behind a separator or a line's end opens a field, or closes one that was open. One of odd length
behind anything else leaves a position outside quotes, whatever it was before: it closes a field, or stands in a plain one.
So the effect of a range is either a known state or a turn, the first pass finds it for all ranges side by side, and a
window over the ranges of a file composes them. The second pass reads, from each range, the records that begin there.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.gates import GateClosed

QUOTE, LF, CR = 34, 10, 13
BOM = b"\xef\xbb\xbf"
#: Bytes read beyond a range at first, for the record that goes on there.
AHEAD = 1 << 16
RANGE = "file string, length long, start long, stop long"


class Runs(NamedTuple):
    """Runs of quotes in a buffer: where they start, and the state (1 inside quotes) after each for the one before all."""

    start: np.ndarray
    turns: np.ndarray
    settles: np.ndarray

    def after(self, state: int) -> np.ndarray:
        turned = np.cumsum(self.turns)
        last = np.maximum.accumulate(np.where(self.settles, np.arange(len(self.start)), -1)) if len(self.start) else np.zeros(0, np.int64)
        return (turned - np.where(last >= 0, turned[last], -state)) % 2 if len(self.start) else np.zeros(0, np.int64)


def quote_runs(data: np.ndarray, sep: int) -> Runs:
    """Runs that start behind the first byte of data."""
    at = np.flatnonzero(data == QUOTE)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    size = np.diff(first, append=len(at))
    start = at[first]
    if len(start) and start[0] == 0:
        start, size = start[1:], size[1:]
    before = data[start - 1]
    opens = (before == sep) | (before == LF) | (before == CR)
    odd = size % 2 == 1
    return Runs(start, odd & opens, odd & ~opens)


def record_ends(data: np.ndarray, state: int, sep: int) -> np.ndarray:
    """Places of the bytes that end a record: line feeds, and carriage returns that none follows, outside quotes."""
    ends = np.flatnonzero((data == LF) | ((data == CR) & (np.append(data[1:], 0) != LF)))
    runs = quote_runs(data, sep)
    states = np.concatenate([[state], runs.after(state)])
    return ends[states[np.searchsorted(runs.start, ends)] == 0]


def opened(uri: str) -> tuple:
    """(file system, path in it) of Arrow for a place as Spark names it."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")) if uri.startswith("file:") else fs.FileSystem.from_uri(uri)


class Source:
    """Bytes of a file, with a line's end in place of what precedes it. The mark of UTF-8 at its start counts as such an end, too."""

    def __init__(self, uri: str, length: int):
        store, path = opened(uri)
        self.file, self.length = store.open_input_file(path), length
        self.skip = 3 if self.file.read_at(3, 0) == BOM else 0

    def read(self, start: int, stop: int) -> np.ndarray:
        """Bytes start - 1 to stop, or to the end of the file."""
        stop = min(stop, self.length)
        if start > self.skip:
            return np.frombuffer(self.file.read_at(stop - start + 1, start - 1), np.uint8)
        data = np.frombuffer(b"\n" + self.file.read_at(stop, 0), np.uint8).copy()
        data[: self.skip + 1] = LF
        return data[start:]


def _effect(source: Source, start: int, stop: int, sep: int) -> tuple[int | None, int]:
    """(state that the range leaves whatever preceded it, or None; whether it turns the state)."""
    more = 0
    while True:
        data = source.read(start, stop + more)
        runs = quote_runs(data, sep)
        if not len(data) or data[-1] != QUOTE or start - 1 + len(data) >= source.length:
            break
        more = more * 2 + AHEAD  # the last run goes on
    own = np.searchsorted(runs.start, stop - start + 1)
    runs = Runs(runs.start[:own], runs.turns[:own], runs.settles[:own])
    turns = int(runs.turns.sum()) % 2
    return (int(runs.after(0)[-1]) if runs.settles.any() else None), turns


def _records(source: Source, start: int, stop: int, state: int, sep: int, most: int) -> Iterator[bytes]:
    """The bytes of some records at a time: those that begin from start to before stop. The first piece of a file begins behind its mark."""
    ahead = AHEAD
    while True:
        data = source.read(start, stop + ahead)
        done = start - 1 + len(data) >= source.length
        begins = record_ends(data, state, sep) + 1  # place p of data is byte start - 1 + p
        begins = begins[begins + start - 1 > source.skip]
        if start == 0:
            begins = np.concatenate([[source.skip + 1], begins])
        if not done and len(data) and data[-1] == CR:
            begins = begins[begins < len(data)]  # a line feed may follow
        last = max(stop - start, source.skip + 1 - start)
        if done or (len(begins) and begins[-1] > last):
            break
        if ahead > most:
            raise GateClosed(f"a record of more than {most} bytes at {stop}")
        ahead *= 2
    if done and len(begins) and begins[-1] < len(data):
        begins = np.append(begins, len(data))  # the last record has no end of line
    own = max(np.searchsorted(begins, stop - start + 1), int(start == 0))  # the first that begins behind the range
    begins = begins[: own + 1]
    if not own or len(begins) < 2:
        return
    at = int(begins[0])
    while at < begins[-1]:
        to = int(begins[min(max(np.searchsorted(begins, at + (4 << 20), side="right") - 1, np.searchsorted(begins, at, side="right")), len(begins) - 1)])
        yield data[at:to].tobytes()
        at = to


def _rows(data: bytes, sep: str) -> Iterator[list[str] | None]:
    """Fields of each record of data, None for one with a quote where none may be. Bytes that aren't UTF-8 raise."""
    text = data.decode()
    try:
        yield from list(csv.reader(io.StringIO(text, newline=""), delimiter=sep, strict=True))
        return
    except csv.Error:
        pass
    whole = np.frombuffer(b"\n" + data, np.uint8)
    ends = record_ends(whole, 0, ord(sep)).tolist()
    if not ends or ends[-1] < len(data):
        ends.append(len(data))
    at = 0
    for end in ends:
        if end > at:
            try:
                yield next(csv.reader([data[at:end].decode()], delimiter=sep, strict=True))
            except csv.Error:
                yield None
            at = end


def read_ranges(spark: SparkSession, path: str, header: Sequence[str], sep: str = ",", range_bytes: int = 32 << 20, record_bytes: int = 64 << 20) -> DataFrame:
    """All-text rows of the files at path, each under this exact header, with error.

    error is width for a record of another number of fields (an empty line, too), nul where a field holds one, quote where text follows
    a closing quote or a quote never closes; fields that are missing are ''. Fields may hold separators, doubled
    quotes and line breaks within quotes; a record ends with LF, CR LF or CR. UTF-8 is decoded strictly: other bytes, another header, a
    file without one, or a record of more than record_bytes fail the job, so nothing is lost in silence. Rows have no
    order. Files are read twice, at first for quotes alone, and by any store that Arrow's file systems open.
    """
    mark, names = ord(sep), list(header)
    csv_limit = max(record_bytes, 1 << 20)

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [_effect(Source(r["file"], r["length"]), r["start"], r["stop"], mark) for r in rows]
            extra = pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "settled", "turns"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(csv_limit)
        for batch in batches:
            for r in batch.to_pylist():
                first, seen = r["start"] == 0, False
                for data in _records(Source(r["file"], r["length"]), r["start"], r["stop"], r["state"], mark, record_bytes):
                    rows = list(_rows(data, sep))
                    if first and not seen:
                        if rows[0] != names:
                            raise GateClosed(f"header drift in {r['file']}: {str(rows[0])[:200]}")
                        seen, rows = True, rows[1:]
                    sound = b"\0" not in data and None not in rows and set(map(len, rows)) <= {len(names)}
                    errors = [None] * len(rows) if sound else ["quote" if x is None else "width" if len(x) != len(names) else "nul" if any("\0" in v for v in x) else None for x in rows]
                    full = rows if sound else [x if e is None or e == "nul" else [*(x or ()), *[""] * len(names)][: len(names)] for x, e in zip(rows, errors, strict=True)]
                    columns = list(zip(*full, strict=True)) if full else [()] * len(names)
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(errors, pa.string())], names=[*names, "error"])
                if first and not seen:
                    raise GateClosed(f"header drift in {r['file']}: no record")

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
    n, found = files.select(F.sum(F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1))), F.count("*")).first()
    if found < len(set(files.inputFiles())):  # Spark leaves out files of no bytes
        raise GateClosed(f"header drift: a file of no bytes in {path}")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = files.withColumn("start", F.explode(starts)).withColumn("stop", F.least(F.col("start") + range_bytes, "length"))
    tasks = int(min(n or 1, 100_000))
    ranges = ranges.repartition(tasks).mapInArrow(effects, RANGE + ", settled int, turns int")
    until = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("turns").over(until), F.lit(0))
    own = F.col("settled") - F.sum("turns").over(until.rowsBetween(Window.unboundedPreceding, 0))
    ranges = ranges.withColumns({"turned": turned, "base": own})
    state = F.pmod(F.coalesce(F.last("base", ignorenulls=True).over(until), F.lit(0)) + F.col("turned"), F.lit(2)).cast("int")
    ranges = ranges.withColumn("state", state).select("file", "length", "start", "stop", "state")
    return ranges.repartition(tasks).mapInArrow(parse, ", ".join(f"`{c}` string" for c in (*names, "error")))
