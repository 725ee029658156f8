"""Row-level operators: lineage, deduplication, duplicate keys and counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.functions.scalars import timestamp_or_now


def with_lineage(df: DataFrame, source_file: str | Column, ingested_at: str | dt.datetime | None = None) -> DataFrame:
    """df and where it came from: when, and the name of its file or a column that holds it."""
    return df.withColumns({
        "_ingested_at": timestamp_or_now(ingested_at),
        "_source_file": source_file if isinstance(source_file, Column) else F.lit(source_file),
    })


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    Spark plans ``row_number() = 1`` as a group limit on both sides of the shuffle,
    so each map task sends at most one row per key however many copies it holds.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(by_key)).filter("_rn = 1").drop("_rn")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, halved at each step: every union analyses all plans below it."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return stack(frames[:middle]).unionByName(stack(frames[middle:]))


def row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """One row (layer, table, n) per table, counted in a single job."""
    return stack([
        df.agg(F.count("*").alias("n")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table"), "n"
        )
        for layer, tables in layers.items()
        for name, df in tables.items()
    ])
