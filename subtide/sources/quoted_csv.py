"""CSV records whose quoted fields may hold line breaks, read from large files by many tasks.

Whether a line break ends a record depends on the quotes before it, back to the start of
the file. Spark splits a file into byte ranges of whole lines. One pass counts the quotes of
each range; a running sum over the ranges of a file says which of them start inside quotes.
With that, each range finds its own records in a second pass. A record that lies over the
end of a range comes in fragments, one from each range; only where there are such records
their ranges are read once more, and the fragments put together.

Quotes stand around fields and are doubled inside them, as writers of CSV do; a quote inside
an unquoted field is none.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HEAD, TAIL = 0, 1


class _Ranges:
    """All byte ranges (file, start) and whether each starts inside quotes. A row for each
    range of a scan, so its size is the input's over the size of a range."""

    def __init__(self, rows: Sequence):
        self.inside = {(r.key, r.start): bool(r.inside) for r in rows}
        self.names = {r.key: r.file for r in rows}
        starts = sorted(self.inside)
        follows = {a: b for a, b in zip(starts, starts[1:]) if a[0] == b[0]}
        #: ranges with a fragment: those that start inside quotes, and those before them
        self.broken = [r for r in starts if self.inside[r] or self.inside.get(follows.get(r), False)]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, key (of the file), start (of the byte range), in the order of the file."""
    return spark.read.text(path, lineSep="\n").select(
        "value", F.xxhash64("_metadata.file_path").alias("key"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_name").alias("file"),
    )


def _ranges(lines: DataFrame) -> _Ranges:
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("key", "file", "start").agg(F.sum(quotes).alias("quotes"))
    file = Window.partitionBy("key")
    before = F.sum("quotes").over(file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    rows = counted.select(
        "key", "file", "start", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"),
        (F.sum("quotes").over(file) % 2 == 1).alias("open"),
    ).collect()  # a row for each byte range
    unbalanced = sorted({r.file for r in rows if r.open})
    if unbalanced:
        raise ValueError(f"quoted fields without an end: {unbalanced[:5]}")
    return _Ranges(rows)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """((key, start), lines) for each stretch of a batch that is of one byte range."""
    keys, starts = batch.column("key").to_numpy(), batch.column("start").to_numpy()
    cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
        if b > a:
            yield (int(keys[a]), int(starts[a])), batch.column("value").slice(a, b - a)


class _Splitter:
    """Turns the lines of byte ranges into whole records and fragments."""

    def __init__(self, ranges: _Ranges):
        self.ranges = ranges
        self.at: tuple[int, int] | None = None
        self.inside = self.is_head = False
        self.waiting: list[str] = []

    def leave(self) -> list[tuple[tuple[int, int], int, str]]:
        """The fragment at the end of the range, if there is one."""
        held = [(self.at, HEAD if self.is_head else TAIL, "\n".join(self.waiting))] if self.waiting else []
        self.waiting = []
        return held

    def enter(self, at: tuple[int, int]) -> None:
        if at not in self.ranges.inside:
            raise RuntimeError("the byte ranges changed between two passes; set spark.sql.files.minPartitionNum to keep them")
        self.at, self.inside = at, self.ranges.inside[at]
        self.is_head = self.inside

    def add(self, lines: pa.Array) -> tuple[list[tuple[tuple[int, int], int, str]], list[pa.Array]]:
        """(fragments, arrays of records) that the next lines of the range complete."""
        after = (np.cumsum(pc.count_substring(lines, '"').to_numpy()) + self.inside) % 2
        ends = np.flatnonzero(after == 0)
        self.inside = bool(after[-1])
        if not len(ends):
            self.waiting += lines.to_pylist()
            return [], []
        first, last = int(ends[0]), int(ends[-1])
        fragments, records = [], []
        opening = "\n".join([*self.waiting, *lines.slice(0, first + 1).to_pylist()])
        if self.is_head:
            fragments.append((self.at, HEAD, opening))
            self.is_head = False
        else:
            records.append(pa.array([opening], pa.string()))
        begins = ends[:-1] + 1
        single = begins == ends[1:]
        records.append(lines.take(pa.array(ends[1:][single])))
        several = [
            "\n".join(lines.slice(a, b - a + 1).to_pylist()) for a, b in zip(begins[~single].tolist(), ends[1:][~single].tolist())
        ]
        records.append(pa.array(several, pa.string()))
        self.waiting = lines.slice(last + 1).to_pylist()
        return fragments, records


def _check_header(line: str, names: Sequence[str], file: str) -> None:
    found = next(csv.reader([line.removeprefix("\ufeff").removesuffix("\r")]), [])
    if found != list(names):
        raise ValueError(f"the header of {file} is {found}, not {list(names)}")


def records_of(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """(record, file): every record of the files, without their headers, which must be the
    names, and without blank lines."""
    lines = _lines(spark, path)
    ranges = _ranges(lines)
    given = spark.sparkContext.broadcast(ranges)  # a row for each byte range of the input

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _Splitter(given.value)
        for batch in batches:
            for at, values in _runs(batch):
                fresh = at != splitter.at
                if fresh:
                    splitter.leave()
                    splitter.enter(at)
                file = given.value.names[at[0]]
                if fresh and at[1] == 0:
                    _check_header(values[0].as_py(), names, file)
                    values = values.slice(1)
                    if not len(values):
                        continue
                for records in splitter.add(values)[1]:
                    if len(records):
                        yield pa.RecordBatch.from_arrays([records, pa.array([file] * len(records))], names=["record", "file"])

    def broken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _Splitter(given.value)

        def out(fragments: list) -> pa.RecordBatch:
            keys, starts = zip(*(at for at, _, _ in fragments))
            files = [given.value.names[key] for key in keys]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(files), pa.array(starts, pa.int64()), pa.array([k for _, k, _ in fragments], pa.int32()), pa.array([t for *_, t in fragments])],
                names=["key", "file", "start", "kind", "text"],
            )

        for batch in batches:
            for at, values in _runs(batch):
                fragments = []
                if at != splitter.at:
                    fragments += splitter.leave()
                    splitter.enter(at)
                fragments += splitter.add(values)[0]
                if fragments:
                    yield out(fragments)
        fragments = splitter.leave()
        if fragments:
            yield out(fragments)

    columns = ["value", "key", "start"]
    records = lines.select(*columns).mapInArrow(whole, "record string, file string")
    if ranges.broken:
        named = F.concat_ws("/", "key", "start").isin([f"{key}/{start}" for key, start in ranges.broken])
        fragments = lines.filter(named).select(*columns).mapInArrow(broken, "key bigint, file string, start bigint, kind int, text string")
        # each tail begins a record, the heads of the ranges after it go on with it
        order = Window.partitionBy("key").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        joined = (
            fragments.withColumn("n", F.sum("kind").over(order))
            .groupBy("key", "file", "n").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))).alias("parts"))
        )
        record = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
        records = records.unionByName(joined.select(record.alias("record"), "file"))
    return records.select(F.regexp_replace("record", r"\r\z", "").alias("record"), "file").filter(F.trim("record") != "")
