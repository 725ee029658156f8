"""Registered queries: each operator run over the star-schema tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.functions.scalars import as_timestamp, as_whole_number, lower_label
from subtide.operators.rows import duplicate_keys, row_counts, stack, with_lineage
from subtide.plans import marts, quality, rollups, silver
from subtide.plans.staging import stage, staging_tables
from subtide.schemas import EVENT_KEY, RAW_FILES, TABLES
from subtide.sinks.writers import write_buckets
from subtide.sources.layers import read_table
from subtide.sources.star_schema import AS_OF, INGESTED_AT, raw_table

Query = Callable[[SparkSession, str], DataFrame]


def _raw(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(raw_table(spark, sf_dir, name))


def _staged(build: Callable[..., DataFrame], *names: str, **options) -> Query:
    """A query over staging tables, passed to ``build`` in the given order."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        clean = [silver.SILVER[name](raw_table(spark, sf_dir, name)) for name in names]
        return build(*map(stage, names, clean), **options)

    return run


def _layers(spark: SparkSession, sf_dir: str) -> dict[str, Mapping[str, DataFrame]]:
    bronze = {name: with_lineage(raw_table(spark, sf_dir, name), name, INGESTED_AT) for name in TABLES}
    clean = silver.silver_tables(bronze)
    return {"bronze": bronze, "silver": clean, "gold": marts.mart_tables(staging_tables(clean), AS_OF)}


def _layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(_layers(spark, sf_dir))


def _dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _layers(spark, sf_dir)
    named = {f"{layer}_{name}": df for layer in ("bronze", "silver") for name, df in layers[layer].items()}
    return quality.dq_checks(named | dict(layers["gold"]))


def _dq_checks_on_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks over tables whose defects were parsed but not removed, most tables
    missing, so that each kind of check fails."""
    bronze = {name: raw_table(spark, sf_dir, name) for name in ("users", "subscriptions", "content_events")}
    return quality.dq_checks({
        "bronze_content_events": bronze["content_events"],
        "silver_users": bronze["users"].select("user_id", as_timestamp("signup_ts").alias("signup_ts")),
        "silver_subscriptions": bronze["subscriptions"].select(lower_label("status").alias("status")),
        "silver_content_events": bronze["content_events"].select(
            "user_id", "content_id", as_timestamp("event_ts").alias("event_ts"),
            lower_label("event_type").alias("event_type"), as_whole_number("watch_seconds").alias("watch_seconds"),
        ),
    })


def _rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each table were left out for each reason."""
    return stack([
        silver.rejected(name, raw_table(spark, sf_dir, name)).groupBy("reason").agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("table"), "reason", "n")
        for name in TABLES
    ])


def _row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    def counted(role: str, name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(F.lit(role).alias("role"), F.lit(name).alias("table"), "n")

    raw = {name: raw_table(spark, sf_dir, name) for name in TABLES}
    copies = quality.key_copies(silver.typed_events(raw["content_events"]), EVENT_KEY)
    return quality.row_accounting(stack([
        *(counted("bronze", name, df) for name, df in raw.items()),
        *(counted("silver", name, clean(raw[name])) for name, clean in silver.SILVER.items()),
        *(counted("rejected", name, silver.rejected(name, df)) for name, df in raw.items()),
        copies.select(F.lit("duplicate").alias("role"), F.lit("content_events").alias("table"), "n"),
    ]))


def _active_users(events: DataFrame) -> DataFrame:
    return rollups.active_users(rollups.week_users(events, rollups.user_numbers(events)))


def _failed_from_buckets(payments: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Both rollups stored in buckets, in the folder that all executors share, and joined there."""
    spark = payments.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    base = f"{shared.rstrip('/')}/subtide-{uuid.uuid4().hex}"
    made = {"failed": marts.failed_by_subscription(payments), "owners": rollups.subscription_owners(subscriptions)}
    for name, df in made.items():
        write_buckets(df, base, "rollups", name, "subscription_id", 8)
    return rollups.failed_by_user(*(read_table(spark, base, "rollups", name) for name in made))


def _bronze(name: str) -> Query:
    return _raw(name, lambda df: with_lineage(df, RAW_FILES[name], INGESTED_AT))


QUERIES: dict[str, Query] = {
    **{f"bronze_layer_{name}": _bronze(name) for name in TABLES if name != "content_events"},
    "bronze_events": _raw("content_events", lambda df: with_lineage(df, "content_events.json", INGESTED_AT)),
    **{f"silver_{name}": _raw(name, clean) for name, clean in silver.SILVER.items()},
    "duplicate_events": _raw("content_events", lambda df: duplicate_keys(silver.typed_events(df), EVENT_KEY)),
    "rejected_rows": _rejected_rows,
    "rejected_payments": _raw("payments", lambda df: silver.rejected("payments", df).select("reason", "raw.*")),
    "row_accounting": _row_accounting,
    "stg_users": _staged(lambda users: users, "users"),
    "trial_paid_pairs": _staged(marts.trial_paid_pairs, "subscriptions"),
    "payment_recoveries": _staged(marts.payment_recoveries, "payments"),
    "user_month_activity": _staged(marts.user_month_activity, "content_events"),
    "user_active_plans": _staged(marts.user_active_plans, "subscriptions", "plans"),
    "weekly_activity": _staged(marts.weekly_activity, "content_events"),
    "active_users_of_four_weeks": _staged(_active_users, "content_events"),
    "weekly_renewals": _staged(marts.weekly_renewals, "subscriptions"),
    "last_activity": _staged(marts.last_activity, "content_events"),
    "failed_payments_by_user": _staged(marts.failed_payments_by_user, "payments", "subscriptions"),
    "failed_payments_from_buckets": _staged(_failed_from_buckets, "payments", "subscriptions"),
    "cancelled_users": _staged(marts.cancelled_users, "subscriptions"),
    "support_cases_by_user": _staged(marts.support_cases_by_user, "support_cases"),
    "mart_trial_conversion": _staged(marts.mart_trial_conversion, "subscriptions"),
    "mart_retention": _staged(marts.mart_retention, "content_events", "subscriptions", "plans"),
    "mart_payment_failures": _staged(marts.mart_payment_failures, "payments"),
    "mart_churn_risk": _staged(
        marts.mart_churn_risk, "users", "content_events", "payments", "subscriptions", "support_cases", as_of=AS_OF
    ),
    "mart_weekly_metrics": _staged(marts.mart_weekly_metrics, "content_events", "subscriptions"),
    "layer_row_counts": _layer_row_counts,
    "dq_checks": _dq_checks,
    "dq_checks_on_defects": _dq_checks_on_defects,
}
