"""CSV with line breaks inside quoted fields, read by many tasks.

Whether a line break ends a record depends on all the text before it, which is why
Spark reads such a file in one task. Here every byte range of a file is read once
under both assumptions, that it begins outside and that it begins inside a quoted
field. What a range does to the state is thus known without its beginning, and the
states at all beginnings follow by composing the ranges in order (a prefix scan, as
in Ge et al. 2019, "Speculative Distributed CSV Data Parsing"). A second reading cuts
the ranges into records, which Spark's own parser turns into columns (``from_csv``).

A record that crosses ranges is put together from its parts, which the first reading
has kept: at most one record a range, whatever the state at its beginning.

Records end with LF or CRLF. A quote opens a field only as its first character; a
doubled quote stands for one; after a closing quote anything up to the next delimiter
belongs to the field, as Spark's parser has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkgauge.session import ship_package, written

_OPENED = re.compile(rb'(?:^|,)"')  # a field that begins with a quote
_CLOSED = re.compile(rb'(?:[^"]|"")*+"')  # up to the quote that ends a field


def inside_after(line: bytes, inside: bool) -> bool:
    """Whether the text is inside a quoted field after ``line``."""
    at = 0
    while True:
        if not inside:
            opened = _OPENED.search(line, at) if at else _OPENED.match(line) or _OPENED.search(line)
            if not opened:
                return False
            at = opened.end()
        closed = _CLOSED.match(line, at)
        if not closed:
            return True
        # the next field begins after the next delimiter, which _OPENED looks for
        inside, at = False, closed.end()
        if at >= len(line):
            return False


class _Segment:
    """Lines of one range in one Arrow batch."""

    def __init__(self, lines: pa.Array):
        self.lines = lines
        self.quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        self.with_quotes = lines.take(pa.array(self.quoted)).to_pylist()
        blank = pc.is_in(lines, pa.array([b"", b"\r"], lines.type))
        self.blank = blank.to_numpy(zero_copy_only=False)

    def states(self, inside: bool) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line begins and ends inside a field; only lines with quotes change it."""
        after = [inside]
        for line in self.with_quotes:
            after.append(inside_after(line, after[-1]))
        passed = np.searchsorted(self.quoted, np.arange(len(self.lines)), side="right")
        ends = np.array(after)[passed]
        return np.concatenate([[inside], ends[:-1]]), ends


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], _Segment]]:
    """((file, start of the range), lines) in the order of the file."""
    for batch in batches:
        files, begins = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        new = np.ones(len(batch), bool)
        new[1:] = (files[1:] != files[:-1]) | (begins[1:] != begins[:-1])
        starts = np.flatnonzero(new).tolist()
        for a, b in zip(starts, [*starts[1:], len(batch)], strict=True):
            yield (int(files[a]), int(begins[a])), _Segment(batch.column(0).slice(a, b - a))


class _Guess:
    """A range read under one assumption about its beginning."""

    def __init__(self, inside: bool):
        self.began_inside = self.inside = inside
        self.head: list[bytes] | None = [] if inside else None  # lines of a record begun before
        self.head_ended = not inside
        self.open: list[bytes] = []  # lines of the record that is not over yet
        self.records = 0  # begun in the range, blank lines left out

    def add(self, segment: _Segment) -> None:
        before, after = segment.states(self.inside)
        self.inside = bool(after[-1])
        at = 0
        if not self.head_ended:
            over = np.flatnonzero(~after)
            self.head_ended = len(over) > 0
            at = int(over[0]) + 1 if len(over) else len(after)
            self.head += segment.lines.slice(0, at).to_pylist()
        begun = np.flatnonzero(~before[at:]) + at
        self.records += int((~segment.blank[begun]).sum())
        if not self.inside:
            self.open = []
        elif len(begun):
            self.open = segment.lines.slice(int(begun[-1])).to_pylist()
        else:
            self.open += segment.lines.slice(at).to_pylist()


_RANGE = (
    "file bigint, begin bigint, began_inside boolean, ends_inside boolean, head string, head_ended boolean, "
    "tail string, records bigint"
)


def _guessed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both readings of each range: what they end in, and the parts of records that cross its borders."""

    def rows(key: tuple[int, int], guesses: list[_Guess]) -> pa.RecordBatch:
        names = [c.split()[0] for c in _RANGE.split(", ")]
        out = [
            {
                "file": key[0],
                "begin": key[1],
                "began_inside": g.began_inside,
                "ends_inside": g.inside,
                "head": None if g.head is None else b"\n".join(g.head).decode("utf-8", "replace"),
                "head_ended": g.head_ended,
                "tail": b"\n".join(g.open).decode("utf-8", "replace") if g.inside and g.head_ended else None,
                "records": g.records,
            }
            for g in guesses
        ]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.bool_(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_pylist(out, pa.schema(list(zip(names, types, strict=True))))

    at, guesses = None, []
    for key, segment in _segments(batches):
        if key != at:
            if at is not None:
                yield rows(at, guesses)
            at, guesses = key, [_Guess(False), _Guess(True)]
        for g in guesses:
            g.add(segment)
    if at is not None:
        yield rows(at, guesses)


class Ranges:
    """What is known of the ranges after the first reading: a few bytes each, held by the driver."""

    def __init__(self, summary: list):
        found: dict[int, dict[int, dict[bool, tuple[bool, bool, int]]]] = {}
        for r in summary:
            of = found.setdefault(r["file"], {}).setdefault(r["begin"], {})
            of[r["began_inside"]] = (r["ends_inside"], r["head_ended"], r["records"])
        self.inside: dict[tuple[int, int], bool] = {}  # the state at the beginning of each range
        self.owner: dict[tuple[int, int], int] = {}  # for an inside range, where its first record began
        self.header: dict[int, int] = {}  # the range in which a file's first record begins
        for file, ranges in found.items():
            inside, begun = False, None
            for begin in sorted(ranges):
                self.inside[file, begin] = inside
                if inside:
                    self.owner[file, begin] = begun
                ends, head_ended, records = ranges[begin][inside]
                if records and file not in self.header:
                    self.header[file] = begin
                if head_ended and ends:
                    begun = begin  # its last record is open
                inside = ends


def _records(ranges: Ranges):
    """Cut ranges into the records that lie in one range; the header of each file is left out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, seen, held = None, False, 0, None
        for key, segment in _segments(batches):
            if key != at:
                if key not in ranges.inside:
                    raise RuntimeError("the files are not split as when they were scanned: scan them again")
                # lines of a record of an earlier range are not this one's
                at, inside, seen, held = key, ranges.inside[key], 0, None
            before, after = segment.states(inside)
            inside = bool(after[-1])
            ends = np.flatnonzero(~after)
            if not len(ends):
                if not before[0]:
                    held = segment.lines.to_pylist()
                elif held is not None:
                    held += segment.lines.to_pylist()
                continue
            first, out = 0, []
            if before[0]:  # the end of a record begun before
                first = int(ends[0]) + 1
                if held is not None:
                    out.append(pa.array([b"\n".join(held + segment.lines.slice(0, first).to_pylist())], pa.binary()))
            starts = np.flatnonzero(~before[first:]) + first
            last = int(ends[-1]) + 1
            held = segment.lines.slice(last).to_pylist()
            starts = starts[starts < last]
            if len(starts):
                offsets = pa.array(np.append(starts, last).astype(np.int32))
                found = pc.binary_join(pa.ListArray.from_arrays(offsets, segment.lines), b"\n")
                out.append(found.filter(pa.array(~segment.blank[starts])).cast(pa.binary()))
            found = pa.concat_arrays(out) if out else pa.array([], pa.binary())
            if not seen and len(found) and ranges.header.get(key[0]) == key[1]:
                seen, found = 1, found.slice(1)
            seen += len(found)
            if len(found):
                yield pa.record_batch([found], ["record"])

    return cut


def _crossing(parts: DataFrame, ranges: Ranges) -> DataFrame:
    """Records that cross ranges, put together from the parts the first reading kept."""
    spark = parts.sparkSession
    known = [(f, b, inside, ranges.owner.get((f, b))) for (f, b), inside in ranges.inside.items()]
    known = spark.createDataFrame(known, "file bigint, begin bigint, began_inside boolean, owner bigint")
    mine = parts.join(known, ["file", "begin", "began_inside"])
    pieces = F.array(
        F.struct("owner", "begin", F.lit(0).alias("nth"), F.col("head").alias("text"), F.lit(False).alias("header")),
        F.struct(
            F.col("begin").alias("owner"), "begin", F.lit(1).alias("nth"), F.col("tail").alias("text"),
            # the first record of a file may be one that crosses ranges
            (F.col("first") & (F.col("records") == 1)).alias("header"),
        ),
    )
    firsts = spark.createDataFrame(list(ranges.header.items()), "file bigint, begin bigint").withColumn("first", F.lit(True))
    mine = mine.join(firsts, ["file", "begin"], "left").withColumn("first", F.coalesce("first", F.lit(False)))
    pieces = mine.select("file", F.inline(pieces)).where("text IS NOT NULL AND owner IS NOT NULL")
    of = F.sort_array(F.collect_list(F.struct("begin", "nth", "text")))
    whole = pieces.groupBy("file", "owner").agg(of.alias("of"), F.max("header").alias("header")).where("NOT header")
    return whole.select(F.array_join(F.transform("of", lambda p: p["text"]), "\n").cast("binary").alias("record"))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of all files at ``path`` as text, headers left out.

    The files are read once right away, to learn the states at the beginnings of the
    ranges. The driver holds a few bytes for each range, as it does for the list of files.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("begin"),
    )
    parts = written(lines.mapInArrow(_guessed, _RANGE), "ranges")
    summary = parts.select("file", "begin", "began_inside", "ends_inside", "head_ended", "records").collect()
    ranges = Ranges(summary)
    inner = lines.mapInArrow(_records(ranges), "record binary")
    records = inner.unionAll(_crossing(parts, ranges)).select(F.col("record").cast("string").alias("record"))
    # the line break of a record that ends with CRLF
    return records.select(F.regexp_replace("record", "\r\\z", "").alias("record"))


def scan_quoted_csv(
    spark: SparkSession, path: str, columns: T.StructType, header: list[str], options: dict[str, str]
) -> DataFrame:
    """``columns`` of the files at ``path``, found by their names in ``header`` and cast."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    parse = {k: v for k, v in options.items() if k != "header"}
    rows = quoted_records(spark, path).select(F.from_csv("record", schema.toDDL(), parse).alias("r"))
    return rows.select(*(F.col(f"r.`{c.name}`").cast(c.dataType).alias(c.name) for c in columns))
