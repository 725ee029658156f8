"""Readers of the raw extracts: CSV with a header, and JSON records.

Each can name the file a row came from in a column of its own, from the scan's hidden file
metadata.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.operators.rows import with_lineage
from subtide.schemas import RAW_FILES, RAW_SCHEMAS, TABLES
from subtide.sources.quoted_csv import records_of


def _file_name(column: str | None) -> list[Column]:
    return [F.col("_metadata.file_name").alias(column)] if column else []


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False, file_column: str | None = None
) -> DataFrame:
    """CSV with a header line and doubled quotes; empty fields, quoted or not, are NULL.

    A row with too many or too few fields fails the read. ``multiline`` accepts line
    breaks inside quotes, at the price of a pass over the files that counts quotes; a large
    file is still read by many tasks (``sources.quoted_csv``).
    """
    options = {"escape": '"', "mode": "FAILFAST"}
    if not multiline:
        rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=False, **options)
        return rows.select("*", *_file_name(file_column))
    record = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options | {"multiLine": "true"})
    named = [F.col("file").alias(file_column)] if file_column else []
    return records_of(spark, path, schema.names).select(F.inline(F.array(record)), *named)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text before each opening brace, and the last one's rest."""
    trimmed = F.trim(F.col("value"), F.lit(" \t\r\n\ufeff")).alias("piece")
    return spark.read.text(path, lineSep="{").select(trimmed, *_file_name("file"))


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType, layout: str = "array", file_column: str | None = None,
    watch: Observation | None = None,
) -> DataFrame:
    """Flat JSON objects. ``layout`` says how they lie in the files:

    * ``array``: an array over any number of lines. Spark's own array reader gives a
      whole file to one task; here the file is split at opening braces, like lines of
      text, and one large array is read by many tasks. Each record keeps its own closing
      brace, so a record that is cut off, or an opening brace inside a text value, fails
      the read. One object per line is read as well.
    * ``lines``: one object per line, with any text.
    * ``whole``: any layout and any text, one task per file.
    """
    if layout == "whole":
        return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST").select("*", *_file_name(file_column))
    if layout == "lines":
        return spark.read.schema(schema).json(path, mode="FAILFAST").select("*", *_file_name(file_column))
    if layout != "array":
        raise ValueError(f"layout {layout!r} is none of array, lines, whole")
    body = F.rtrim(F.col("piece"), F.lit(" \t\r\n],"))
    record = F.from_json(F.concat(F.lit("{"), body), schema, {"mode": "FAILFAST"})
    # Generated columns keep each object to one parse, whatever filters follow.
    pieces = _pieces(spark, path)
    if watch is not None:
        pieces = pieces.observe(watch, *[F.count_if(condition).alias(name) for name, condition in _array_marks().items()])
    return pieces.filter(~body.isin("", "[")).select(F.inline(F.array(record)), *([F.col("file").alias(file_column)] if file_column else []))


def _array_marks() -> dict[str, Column]:
    """What of a JSON array's text a piece shows: its start, its end, a start before records,
    a record, and a comma after it."""
    piece = F.col("piece")
    return {
        "opened": piece.startswith("["),
        "closed": piece.endswith("]"),
        "filled": piece == "[",
        "records": ~F.rtrim(piece, F.lit(" \t\r\n],")).isin("", "["),
        "commas": piece.endswith(","),
    }


def require_whole_arrays(seen: Mapping[str, int], files: int) -> None:
    """Fails if what a read has observed of so many files is not that of whole arrays: one
    was cut off, or a comma is missing between records. Files of one object per line have
    no such marks; next to them commas are not counted."""
    if seen["opened"] != seen["closed"]:
        raise ValueError(f"JSON arrays without an end: {seen['opened']} begin and {seen['closed']} end")
    if seen["opened"] == files and seen["records"] != seen["commas"] + seen["filled"]:
        raise ValueError(f"JSON arrays with {seen['records']} records and {seen['commas']} commas between them")


def require_closed_arrays(spark: SparkSession, path: str) -> None:
    """Fails if a file that starts an array does not end it: a file cut between two
    records has only whole ones. Reads the files once more."""
    piece = F.col("piece")
    ends = (
        _pieces(spark, path).select(F.input_file_name().alias("file"), "piece").groupBy("file")
        .agg(F.count_if(piece.startswith("[")).alias("opened"), F.count_if(piece.endswith("]")).alias("closed"))
    )
    cut = ends.filter((F.col("opened") > 0) & (F.col("closed") == 0)).select("file").take(5)
    if cut:
        raise ValueError(f"JSON arrays without an end: {[row.file for row in cut]}")


def read_raw(
    spark: SparkSession, folder: str, name: str, multiline: bool = False, layout: str = "array", file_column: str | None = None,
    watch: Observation | None = None,
) -> DataFrame:
    """A raw extract; ``multiline`` is for CSV, ``layout`` for JSON. JSON arrays are looked
    through first for one without an end, or, with ``watch``, observed while they are read,
    for ``require_whole_arrays``."""
    path = f"{folder.rstrip('/')}/{RAW_FILES[name]}"
    if not path.endswith(".json"):
        return read_csv(spark, path, RAW_SCHEMAS[name], multiline, file_column)
    if layout == "array" and watch is None:
        require_closed_arrays(spark, path)
    return read_json_records(spark, path, RAW_SCHEMAS[name], layout, file_column, watch)


def bronze_tables(
    spark: SparkSession, folder: str, ingested_at: str | dt.datetime | None = None,
    multiline: bool = False, layout: str = "array", watch: Observation | None = None,
) -> dict[str, DataFrame]:
    """All raw extracts as they are, with lineage columns: one time for all, and the file
    that each row was read from. ``watch`` as for ``read_raw``."""
    if ingested_at is None:
        ingested_at = spark.range(1).select(F.localtimestamp()).first()[0]
    return {
        name: with_lineage(read_raw(spark, folder, name, multiline, layout, "_file", watch), F.col("_file"), ingested_at).drop("_file")
        for name in TABLES
    }
