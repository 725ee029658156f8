"""Sets of values as bitmaps, whose unions can be counted without the rows behind them.

Values get dense numbers, and a set is a row of bits for each 32,768 numbers. Bitmaps of
parts merge into those of the whole with OR, so distinct counts over any parts come from
the parts' bitmaps, exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Groups in which values are numbered one after another.
BUCKETS = 1024


def number_values(df: DataFrame, column: str, first: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(column, number): the distinct values, without NULL, numbered from ``first`` without
    gaps. The same values get the same numbers on every run.

    Values are numbered within buckets of their hash, so no task sorts more than its
    buckets, and the buckets' sizes, at most ``buckets`` rows, say where each starts.
    """
    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    placed = distinct.withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_bucket").agg(F.count("*").alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(column))
    return placed.withColumn("_rank", rank).join(F.broadcast(starts), "_bucket").select(
        column, (F.col("_start") + F.col("_rank") + (first - 1)).alias("number")
    )


def bitmaps_of(df: DataFrame, *by: str, number: str = "number") -> DataFrame:
    """(by, part, bitmap): the numbers of each group as bits. Rows are made distinct before
    the bits are set, and pre-aggregated before they are shuffled."""
    part = F.bitmap_bucket_number(F.col(number)).alias("part")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number)))
    return df.select(*by, number).distinct().groupBy(*by, part).agg(bits.alias("bitmap"))


def count_union(bitmaps: DataFrame, *by: str, out: str = "n") -> DataFrame:
    """(by, out): how many different numbers the bitmaps of each group hold together."""
    merged = bitmaps.groupBy(*by, "part").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(out))
