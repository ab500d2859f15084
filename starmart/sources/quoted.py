"""CSV records with line breaks in quotes, cut out of large files by many tasks.

Spark splits text files at line ends, but a line end inside quotes ends no record. A record ends at the first line end
with an even number of quotes before it in the file, as quotes inside a value are doubled. So the quotes of each byte range are counted
first; sums over the ranges of a file say which ranges begin inside quotes, and with that each range is cut on its own. Records that cross
the border of ranges come in parts, at most two per range; only these are shuffled and put together.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Place = tuple[str, int]

#: odd: quotes of the range, modulo two. ends, ends_inside: whether a record ends in it if it begins outside or inside quotes.
RANGES = "file string, start long, odd boolean, ends boolean, ends_inside boolean, first_line string"
#: part_of: null for a whole record; for a part the range in which its record begins.
RECORDS = "record string, header boolean, file string, start long, part_of long"


@dataclass(frozen=True)
class Layout:
    """The ranges of some files: whether each begins inside quotes, and the range where the record that is open there began."""

    starts: dict[Place, tuple[bool, int]]
    header: list[str] | None

    @property
    def crossing(self) -> bool:
        return any(inside for inside, _ in self.starts.values())


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, start: the text between line feeds, and the file and byte range it was read from."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Place, pa.Array, np.ndarray]]:
    """Lines of one range, in order, with the number of quotes in each."""
    for batch in batches:
        files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        borders = [i for i in range(1, batch.num_rows) if starts[i] != starts[i - 1] or files[i] != files[i - 1]]
        for a, b in zip([0, *borders], [*borders, batch.num_rows], strict=True):
            if a < b:
                values = batch.column(0).slice(a, b - a)
                yield (files[a], starts[a]), values, pc.count_substring(values, '"').to_numpy(zero_copy_only=False)


def ranges(lines: DataFrame) -> DataFrame:
    """RANGES of the lines, one row for each."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, odd, ends, ends_inside, first = None, False, False, False, None

        def row() -> Iterator[pa.RecordBatch]:
            if here is not None:
                values = (*here, odd, ends, ends_inside, first)
                kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["file", "start", "odd", "ends", "ends_inside", "first_line"])

        for place, values, counts in segments(batches):
            if place != here:
                yield from row()
                here, odd, ends, ends_inside, first = place, False, False, False, None
            if here[1] == 0 and first is None:
                first = next((text for text in values.to_pylist() if text.strip("﻿ \t\r")), None)
            after = (np.cumsum(counts) + odd) % 2 == 1
            odd, ends, ends_inside = bool(after[-1]), ends or not after.all(), ends_inside or bool(after.any())
        yield from row()

    return lines.mapInArrow(work, RANGES)


def layout(lines: DataFrame) -> Layout:
    """One pass over the files; the driver gets a few numbers per byte range, and the first line of each file."""
    starts: dict[Place, tuple[bool, int]] = {}
    headers: dict[str, list[str]] = {}
    file, inside, opened = None, False, 0
    for r in sorted(ranges(lines).collect(), key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            if inside:
                raise ValueError(f"a quote that never closes in {file}")
            file, inside, opened = r["file"], False, r["start"]
        if r["first_line"] is not None:
            headers[file] = next(csv.reader([r["first_line"].strip("﻿\r")]))
        starts[file, r["start"]] = (inside, opened)
        if not inside or r["ends_inside"]:
            opened = r["start"]
        inside ^= r["odd"]
    if inside:
        raise ValueError(f"a quote that never closes in {file}")
    names = next(iter(headers.values()), None)
    other = [file for file, found in headers.items() if found != names]
    if other:
        raise ValueError(f"other header in {other[:3]}")
    return Layout(starts, names)


def cut(lines: DataFrame, found: Layout) -> DataFrame:
    """RECORDS of the lines: whole records, and parts of those that cross the border of a range. Blank lines between records are dropped."""
    shared = lines.sparkSession.sparkContext.broadcast(found.starts)

    def made(place: Place, records: pa.Array | list[str], part_of: int | None = None, header: bool = False) -> pa.RecordBatch:
        n = len(records)
        arrays = [pa.array(records, pa.string()), pa.array([header and i == 0 for i in range(n)]), pa.array([place[0]] * n, pa.string()), pa.array([place[1]] * n, pa.int64()), pa.array([part_of] * n, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["record", "header", "file", "start", "part_of"])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = shared.value
        here: Place | None = None
        held: list[str] = []  # lines of the record that is open
        inside = crossing = header = False

        def left_over() -> Iterator[pa.RecordBatch]:
            if held:
                yield made(here, ["\n".join(held)], starts[here][1] if crossing else here[1], header)

        for place, values, counts in segments(batches):
            if place != here:
                yield from left_over()
                if place not in starts:
                    raise RuntimeError(f"other byte ranges than in the first pass: {place}")
                here, held = place, []
                inside = crossing = starts[here][0]
                header = here[1] == 0
            after = (np.cumsum(counts) + inside) % 2 == 1
            before = np.concatenate([[inside], after[:-1]])
            inside = bool(after[-1])
            whole = ~before & ~after & pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(values)), 0).to_numpy(zero_copy_only=False)
            broken = np.flatnonzero(before | after)
            if header and whole.any() and not (broken.size and broken[0] < np.flatnonzero(whole)[0]):
                yield made(here, values.filter(pa.array(whole)), header=True)
                header = False
            elif whole.any():
                yield made(here, values.filter(pa.array(whole)))
            for i in broken.tolist():
                held.append(values[i].as_py())
                if not after[i]:
                    yield made(here, ["\n".join(held)], starts[here][1] if crossing else None, header)
                    held, crossing, header = [], False, False
        yield from left_over()

    return lines.mapInArrow(work, RECORDS)


def quoted_records(spark: SparkSession, path: str) -> tuple[list[str] | None, DataFrame]:
    """The names in the header line, and all records but the headers as text (column ``record``), without their line end.

    The files are read once when this is called. Every file has one header line and all have the same; quotes enclose values or are
    doubled inside them. A file with an odd number of quotes is refused, as no border of its records would be certain.
    """
    lines = text_lines(spark, path)
    found = layout(lines)
    pieces = cut(lines, found)
    records = pieces.where("part_of is null").select("record", "header")
    if found.crossing:
        parts = pieces.where("part_of is not null").groupBy("file", "part_of")
        joined = parts.agg(F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"), F.max("header").alias("header"))
        whole = F.array_join(F.transform("parts", lambda part: part["record"]), "\n")
        records = records.unionByName(joined.select(whole.alias("record"), "header"))
    return found.header, records.where("not header").select(F.regexp_replace("record", r"\r\z", "").alias("record"))
