"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TAG = "_key_tag"
ROWS_PER_TASK = 100_000  # rows that one task sorts, so that its memory does not grow with the table


def hash_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on the hash of the keys and the keys.

    Two things come with the hash as first join column:

    * Adaptive execution splits a hot key only where both inputs of a join are
      plain shuffles, but an aggregate on the keys would pass its own partitioning
      on to the join. With the hash among the join columns Spark shuffles the
      aggregate once more: it is the small side, and in exchange a key with a third
      of all rows on the other side is read by many tasks.
    * The sorts of a merge join compare hashes instead of long ids with a common
      beginning.

    A side that turns out small enough is still broadcast by the session's own
    size check. Equal values of different types hash differently, so the keys must
    have the same types on both sides.
    """
    for key in keys:
        types = left.schema[key].dataType, right.schema[key].dataType
        if types[0] != types[1]:
            raise ValueError(f"join key {key} is {types[0].simpleString()} and {types[1].simpleString()}")
    tag = F.xxhash64(*keys)
    return left.withColumn(_TAG, tag).join(right.withColumn(_TAG, tag), [_TAG, *keys], how).drop(_TAG)


def left_join_from(
    left: DataFrame, right: DataFrame, key: str, left_start: str, right_start: str
) -> DataFrame:
    """Left join on ``key`` with ``right_start >= left_start``: one row per pair.

    A left join can be split only on its left side, which leaves a hot key on the
    right with one task. So the pairs come from an inner join, where both sides
    can be split, and the left rows without a partner are those that start after
    their key's latest right start.
    """
    pairs = hash_join(left, right, [key], "inner").filter(F.col(right_start) >= F.col(left_start))

    latest = right.groupBy(key).agg(F.max(right_start).alias("_latest"))
    has_partner = F.coalesce(F.col("_latest") >= F.col(left_start), F.lit(False))
    alone = hash_join(left, latest, [key]).filter(~has_partner).drop("_latest")
    return pairs.unionByName(alone, allowMissingColumns=True)


def first_hit_within_days(
    rows: DataFrame, key: str, at: str, opens: Column, hits: Column, days: int, out: str
) -> DataFrame:
    """Per key, the first row with ``hits`` that lies after some row with ``opens`` and
    within ``days`` of it: (key, out), for keys that have one.

    A hit counts if ``opened < hit <= opened + days`` for any opening of the key. Pairing
    them grows with the square of a key's rows; here the rows are read once and shuffled
    once. They are dealt by key and hour, so a hot key is spread over its hours, and sorted
    in them. Of an hour only four times matter: the last opening, the first hit, and the
    first hit after one of its own openings, which is always recent enough. A key's hours
    then follow each other: a hit in a later hour than an opening comes after it, and is
    recent enough if it is within reach of the latest one; the first hit of an hour is if
    any of its hits is.

    Rows without a key or a time take no part. The rows are dealt over as many tasks as their
    count asks for, at least the session's number of shuffle partitions.
    """
    stamp = F.col("_at")
    narrow = rows.filter(F.col(key).isNotNull() & F.col(at).isNotNull() & (opens | hits)).select(
        key, F.col(at).alias("_at"), F.when(opens, F.col(at)).alias("_open"), F.when(hits, F.col(at)).alias("_hit")
    )
    spark = rows.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    tasks = max(least, -(-narrow.count() // ROWS_PER_TASK))
    hourly = narrow.withColumn("_hour", F.date_trunc("hour", stamp).cast("timestamp_ntz")).repartition(tasks, key, "_hour")
    # rows of one time are each other's peers, so an opening is earlier only if it is before
    so_far = Window.partitionBy(key, "_hour").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    hours = (
        hourly.withColumn("_first", F.min("_open").over(so_far))
        .groupBy(key, "_hour")
        .agg(
            F.max("_open").alias("_last"),
            F.min("_hit").alias("_any"),
            F.min(F.when(F.col("_first") < F.col("_hit"), F.col("_hit"))).alias("_own"),
        )
    )
    earlier = Window.partitionBy(key).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    until = F.max("_last").over(earlier) + F.make_dt_interval(F.lit(days))
    return (
        hours.repartition(tasks, key).withColumn("_until", until)
        .withColumn("_found", F.least(F.col("_own"), F.when(F.col("_any") <= F.col("_until"), F.col("_any"))))
        .groupBy(key)
        .agg(F.min("_found").alias(out))
        .filter(F.col(out).isNotNull())
    )


def first_within_days(
    opens: DataFrame, hits: DataFrame, key: str, opened_at: str, hit_at: str, days: int, out: str
) -> DataFrame:
    """As ``first_hit_within_days``, for openings and hits in two tables."""
    both = opens.select(key, F.col(opened_at).alias("at"), F.lit(True).alias("opens")).unionByName(
        hits.select(key, F.col(hit_at).alias("at"), F.lit(False).alias("opens"))
    )
    return first_hit_within_days(both, key, "at", F.col("opens"), ~F.col("opens"), days, out)
