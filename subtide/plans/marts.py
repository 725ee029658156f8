"""Gold: the five marts and the parts they are built from.

All functions take staging tables (see ``plans.staging``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.functions.scalars import (
    NTZ,
    date_or_today,
    days_between,
    flag,
    month_of,
    to_hours,
    week_of,
)
from subtide.operators.joins import first_hit_within_days, hash_join, left_join_from
from subtide.operators.rows import stack
from subtide.schemas import FREE_PLAN

RECOVERY_DAYS = 7
NEVER_ACTIVE_DAYS = 999


# ---- trial conversion ---------------------------------------------------------

def trial_paid_pairs(subscriptions: DataFrame) -> DataFrame:
    """Each trial with every paid subscription that starts at or after the trial start.

    A trial without one is kept once. A NULL plan is neither trial nor paid.
    """
    trials = subscriptions.filter(F.col("plan_id") == FREE_PLAN).select(
        "user_id", F.col("start_ts").alias("trial_start"), F.col("end_ts").alias("trial_end")
    )
    paid = subscriptions.filter(F.col("plan_id") != FREE_PLAN).select(
        "user_id", F.col("plan_id").alias("converted_plan"), F.col("start_ts").alias("paid_start")
    )
    return left_join_from(trials, paid, "user_id", "trial_start", "paid_start")


def mart_trial_conversion(subscriptions: DataFrame) -> DataFrame:
    """One row per (trial, later paid subscription), or per unconverted trial.

    Days run from the trial end, so a paid start inside the trial gives negative days.
    """
    return trial_paid_pairs(subscriptions).select(
        "user_id",
        "trial_start",
        "trial_end",
        "converted_plan",
        "paid_start",
        days_between(F.col("trial_end"), F.col("paid_start")).alias("days_to_convert"),
        F.when(F.col("converted_plan").isNotNull(), "converted")
        .otherwise("not_converted")
        .alias("conversion_status"),
    )


# ---- retention ----------------------------------------------------------------

def user_month_activity(events: DataFrame) -> DataFrame:
    return events.groupBy(
        "user_id", month_of(F.col("event_ts")).alias("activity_month"), "device_type", "category"
    ).agg(
        F.sum("watch_seconds").alias("total_watch_seconds"),
        F.count("*").alias("total_events"),
    )


def user_active_plans(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Distinct paid plans each user holds actively, with the plan's attributes.

    Both sides are made distinct before the join, so the shuffle carries each
    (user, plan) once and the joined rows need no second pass. Whether plans are
    broadcast is left to the session's size check.
    """
    held = (
        subscriptions.filter((F.col("plan_id") != FREE_PLAN) & (F.col("status") == "active"))
        .select("user_id", "plan_id")
        .distinct()
    )
    attributes = plans.select("plan_id", "plan_name", "billing_cycle", "list_price").distinct()
    return held.join(attributes, "plan_id", "left").select(
        "user_id", "plan_id", "plan_name", "billing_cycle", "list_price"
    )


def mart_retention(events: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per user, month, device, category and active paid plan.

    Activity repeats per plan for users with several, and is kept with NULL plan
    columns for users with none, so sums over the mart count such users twice.
    """
    activity = user_month_activity(events)
    return hash_join(activity, user_active_plans(subscriptions, plans), ["user_id"]).select(
        "user_id",
        "activity_month",
        "device_type",
        "category",
        "plan_id",
        "plan_name",
        "billing_cycle",
        "list_price",
        "total_watch_seconds",
        "total_events",
        to_hours(F.col("total_watch_seconds")).alias("watch_hours"),
    )


# ---- payment failures -----------------------------------------------------------

def failures(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("payment_status") == "failed").select(
        "payment_id", "subscription_id", F.col("payment_ts").alias("failed_at"), "amount", "failure_reason"
    )


def payment_recoveries(payments: DataFrame) -> DataFrame:
    """Per subscription, the first success within 7 days after any of its failures, from one
    scan of the payments."""
    status = F.col("payment_status")
    return first_hit_within_days(
        payments, "subscription_id", "payment_ts", status == "failed", status == "success", RECOVERY_DAYS, "recovered_at"
    )


def mart_payment_failures(payments: DataFrame) -> DataFrame:
    """One row per failed payment.

    A recovery belongs to the subscription, not to one failure: every failure of
    the subscription shows it, also with negative days or more than 7.
    """
    recovered_at = F.col("recovered_at")
    return hash_join(failures(payments), payment_recoveries(payments), ["subscription_id"]).select(
        "payment_id",
        "subscription_id",
        "failed_at",
        "amount",
        "failure_reason",
        "recovered_at",
        recovered_at.isNotNull().alias("recovered_within_7_days"),
        days_between(F.col("failed_at"), recovered_at).alias("days_to_recovery"),
    )


# ---- churn risk -----------------------------------------------------------------

def last_activity(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.max("event_ts").alias("last_event_ts"))


def failed_by_subscription(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(F.col("payment_status") == "failed")
        .groupBy("subscription_id")
        .agg(F.count("*").alias("failed"))
    )


def _failed_per_owner(payments: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Failed payments counted per subscription before they meet its owner."""
    # One row per subscription on both sides: there is no hot key, and the plain join keeps
    # the count's shuffle.
    return subscriptions.select("subscription_id", "user_id").join(failed_by_subscription(payments), "subscription_id")


def failed_payments_by_user(payments: DataFrame, subscriptions: DataFrame) -> DataFrame:
    return (
        _failed_per_owner(payments, subscriptions)
        .groupBy("user_id")
        .agg(F.sum("failed").alias("failed_payment_count"))
    )


def _cancelled(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.filter(F.col("status") == "cancelled").select("user_id")


def cancelled_users(subscriptions: DataFrame) -> DataFrame:
    return _cancelled(subscriptions).distinct()


def support_cases_by_user(support_cases: DataFrame) -> DataFrame:
    return support_cases.groupBy("user_id").agg(F.count("*").alias("support_case_count"))


def user_signals(
    events: DataFrame, payments: DataFrame, subscriptions: DataFrame, support_cases: DataFrame,
    failed: DataFrame | None = None,
) -> DataFrame:
    """The four churn signals of each user, from one aggregation over all sources.

    Every source contributes rows of one narrow shape, so all four signals share
    one partial aggregation and one shuffle, where a join per signal would sort
    and merge four aggregates. With ``failed``, rows of (user_id, failed), no payment is read.
    """
    if failed is None:
        failed = _failed_per_owner(payments, subscriptions)

    def marks(df: DataFrame, **signal) -> DataFrame:
        empty = {
            "event_ts": F.lit(None).cast(NTZ),
            "failed": F.lit(0).cast("bigint"),
            "cases": F.lit(0),
            "cancelled": F.lit(False),
        }
        return df.select("user_id", *[col.alias(name) for name, col in (empty | signal).items()])

    sources = [
        marks(events, event_ts=F.col("event_ts")),
        marks(failed, failed=F.col("failed")),
        marks(_cancelled(subscriptions), cancelled=F.lit(True)),
        marks(support_cases, cases=F.lit(1)),
    ]
    return stack(sources).groupBy("user_id").agg(
        F.max("event_ts").alias("last_event_ts"),
        F.sum("failed").alias("failed_payment_count"),
        F.sum("cases").alias("support_case_count"),
        F.max("cancelled").alias("has_cancellation"),
    )


def mart_churn_risk(
    users: DataFrame,
    events: DataFrame,
    payments: DataFrame,
    subscriptions: DataFrame,
    support_cases: DataFrame,
    as_of: str | dt.date | None = None,
    failed: DataFrame | None = None,
) -> DataFrame:
    """One row per user, scored as of a date (today if none is given).

    The score counts four signals and is capped at 3; the label follows the
    uncapped count. Users without events are 999 days inactive. ``failed`` takes the place
    of the payments, where they have been counted before (see ``rollups``).
    """
    inactive = days_between(F.to_date("last_event_ts"), date_or_today(as_of))
    signals = user_signals(events, payments, subscriptions, support_cases, failed)
    scored = (
        users.select("user_id", "country", "channel").join(signals, "user_id", "left")
        .select(
            "user_id",
            "country",
            F.col("channel").alias("acquisition_channel"),
            "last_event_ts",
            F.coalesce(inactive, F.lit(NEVER_ACTIVE_DAYS)).alias("days_inactive"),
            F.coalesce("failed_payment_count", F.lit(0)).alias("failed_payment_count"),
            F.coalesce("support_case_count", F.lit(0)).alias("support_case_count"),
            F.coalesce("has_cancellation", F.lit(False)).alias("has_cancellation"),
        )
        .withColumn(
            "_raw",
            flag(F.col("days_inactive") > 30)
            + flag(F.col("failed_payment_count") > 0)
            + flag(F.col("has_cancellation"))
            + flag(F.col("support_case_count") > 1),
        )
    )
    raw = F.col("_raw")
    return scored.withColumns({
        "churn_risk_score": F.least(raw, F.lit(3)),
        "churn_risk_label": F.when(raw >= 3, "high").when(raw == 2, "medium").otherwise("low"),
    }).drop("_raw")


# ---- weekly metrics ---------------------------------------------------------------

def weekly_activity(events: DataFrame) -> DataFrame:
    seconds = F.sum("watch_seconds")
    return events.groupBy(week_of(F.col("event_ts")).alias("week_start")).agg(
        F.count_distinct("user_id").alias("weekly_active_users"),
        seconds.alias("total_watch_seconds"),
        to_hours(seconds).alias("total_watch_hours"),
    )


def weekly_renewals(subscriptions: DataFrame) -> DataFrame:
    """Active, auto-renewing subscriptions by the week they started."""
    return (
        subscriptions.filter(F.col("auto_renew_flag") & (F.col("status") == "active"))
        .groupBy(week_of(F.col("start_ts")).alias("week_start"))
        .agg(F.count("*").alias("renewals"))
    )


def mart_weekly_metrics(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """One row per week with an event, in week order; other weeks' renewals drop out."""
    return (
        weekly_activity(events)
        .join(weekly_renewals(subscriptions), "week_start", "left")
        .withColumn("renewals", F.coalesce("renewals", F.lit(0)))
        .orderBy("week_start")
    )


def mart_tables(
    staged: Mapping[str, DataFrame], as_of: str | dt.date | None = None, failed: DataFrame | None = None
) -> dict[str, DataFrame]:
    events, subscriptions, payments = staged["content_events"], staged["subscriptions"], staged["payments"]
    return {
        "mart_trial_conversion": mart_trial_conversion(subscriptions),
        "mart_retention": mart_retention(events, subscriptions, staged["plans"]),
        "mart_payment_failures": mart_payment_failures(payments),
        "mart_churn_risk": mart_churn_risk(
            staged["users"], events, payments, subscriptions, staged["support_cases"], as_of, failed
        ),
        "mart_weekly_metrics": mart_weekly_metrics(events, subscriptions),
    }
