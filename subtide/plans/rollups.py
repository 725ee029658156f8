"""Rollups: weekly users as bitmaps, so that users of several weeks are counted without
the events; failed payments and owners by subscription, so that they meet without a
shuffle once both are stored in buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.functions.scalars import NTZ, week_of
from subtide.operators.bitmaps import bitmaps_of, count_union, number_values
from subtide.operators.joins import hash_join

SPAN_WEEKS = 4


def user_numbers(events: DataFrame) -> DataFrame:
    """(user_id, number) of all users with an event."""
    return number_values(events, "user_id")


def new_user_numbers(events: DataFrame, known: DataFrame, first: int) -> DataFrame:
    """Numbers from ``first`` on for the users that have none yet."""
    return number_values(events.select("user_id").join(known.select("user_id"), "user_id", "left_anti"), "user_id", first)


def week_users(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """(week_start, part, bitmap): the users with an event in each week. A user's events of a
    week are one row before they meet the user's number."""
    watched = events.select(week_of(F.col("event_ts")).alias("week_start"), "user_id").distinct()
    return bitmaps_of(hash_join(watched, numbers, ["user_id"], "inner"), "week_start")


def active_users(weeks: DataFrame, span: int = SPAN_WEEKS) -> DataFrame:
    """(week_start, weekly_active_users, span_active_users): for each week with an event its
    different users, and those of it and the ``span`` - 1 weeks before it together."""
    own = count_union(weeks, "week_start", out="weekly_active_users")
    ahead = F.array(*[(F.col("week_start") + F.make_dt_interval(F.lit(7 * n))).cast(NTZ) for n in range(span)])
    reaching = weeks.select(F.explode(ahead).alias("week_start"), "part", "bitmap")
    return own.join(count_union(reaching, "week_start", out="span_active_users"), "week_start")


def subscription_owners(subscriptions: DataFrame) -> DataFrame:
    """(subscription_id, user_id, times): who holds each subscription, in how many rows."""
    held = subscriptions.filter(F.col("subscription_id").isNotNull())
    return held.groupBy("subscription_id", "user_id").agg(F.count("*").alias("times"))


def failed_of_owners(failed: DataFrame, owners: DataFrame) -> DataFrame:
    """(user_id, failed) for each subscription with a failed payment, from the two rollups; a
    user with several has several rows."""
    return owners.join(failed, "subscription_id").select("user_id", (F.col("failed") * F.col("times")).alias("failed"))


def failed_by_user(failed: DataFrame, owners: DataFrame) -> DataFrame:
    return failed_of_owners(failed, owners).groupBy("user_id").agg(F.sum("failed").alias("failed_payment_count"))
