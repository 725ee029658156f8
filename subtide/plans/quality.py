"""Data-quality checks as one DataFrame: (check, table, column, failing_rows, passed).

Row rules of a table are one aggregation; uniqueness adds a shuffle of counts that are
combined before it. The comparison with bronze counts both event tables once more.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.operators.rows import stack
from subtide.schemas import EVENT_KEY, MARTS, PAYMENT_STATUSES, SUBSCRIPTION_STATUSES, TABLES, UNKNOWN

# The rules of each table.
NOT_NULL = {
    "silver_users": ("user_id", "signup_ts"),
    "mart_trial_conversion": ("user_id", "conversion_status"),
    "mart_churn_risk": ("user_id", "churn_risk_label", "churn_risk_score"),
    "mart_payment_failures": ("payment_id", "recovered_within_7_days"),
    "mart_retention": ("user_id", "activity_month"),
    "mart_weekly_metrics": ("week_start", "weekly_active_users"),
}
# A NULL is a value like others in the events' natural key, and exempts a row elsewhere.
NULL_IS_A_VALUE = ("silver_content_events",)
UNIQUE = {
    "silver_content_events": EVENT_KEY,
    "mart_churn_risk": ("user_id",),
    "mart_payment_failures": ("payment_id",),
    "mart_weekly_metrics": ("week_start",),
}
ACCEPTED = {
    "silver_subscriptions": {"status": (*SUBSCRIPTION_STATUSES, UNKNOWN)},
    "silver_payments": {"payment_status": PAYMENT_STATUSES},
    "mart_trial_conversion": {"conversion_status": ("converted", "not_converted")},
    "mart_churn_risk": {
        "churn_risk_label": ("high", "medium", "low"),
        "churn_risk_score": (0, 1, 2, 3),
    },
}
POSITIVE = {
    "silver_content_events": ("watch_seconds",),
    "silver_payments": ("amount",),
}
EXPECTED_TABLES = (
    *(f"bronze_{name}" for name in TABLES),
    *(f"silver_{name}" for name in TABLES),
    *MARTS,
)


def _row_rules(table: str) -> list[tuple[str, str, Column]]:
    """(check, column, condition of a failing row). NULL passes all but not_null."""
    return [
        *(("not_null", c, F.col(c).isNull()) for c in NOT_NULL.get(table, ())),
        *(("accepted_values", c, ~F.col(c).isin(*ok)) for c, ok in ACCEPTED.get(table, {}).items()),
        *(("positive", c, F.col(c) <= 0) for c in POSITIVE.get(table, ())),
    ]


def check_table(table: str, df: DataFrame) -> DataFrame:
    """All rules of one table from one pass over it.

    Where keys must be unique, the failures of the row rules are counted per key
    along with the copies, and then summed up.
    """
    rules = _row_rules(table)
    keys = UNIQUE.get(table, ())
    failing = [F.count_if(condition).alias(f"n{i}") for i, (_, _, condition) in enumerate(rules)]
    labels = [(check, column) for check, column, _ in rules]
    if keys:
        whole = F.lit(True) if table in NULL_IS_A_VALUE else F.expr(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        repeated = F.count_if((F.col("copies") > 1) & whole)
        per_key = df.groupBy(*keys).agg(F.count("*").alias("copies"), *failing)
        totals = [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(rules))]
        counted = per_key.agg(*totals, repeated.alias(f"n{len(rules)}"))
        labels.append(("unique", ", ".join(keys)))
    else:
        counted = df.agg(*failing)
    results = F.array(*[
        F.struct(
            F.lit(check).alias("check"),
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.col(f"n{i}").alias("failing_rows"),
        )
        for i, (check, column) in enumerate(labels)
    ])
    return counted.select(F.inline(results))


def check_fewer_rows(table: str, df: DataFrame, before: DataFrame) -> DataFrame:
    """Fails unless ``df`` has fewer rows than ``before``."""
    both = stack([
        before.select(F.lit(1).alias("before"), F.lit(0).alias("after")),
        df.select(F.lit(0).alias("before"), F.lit(1).alias("after")),
    ])
    return both.agg(
        F.when(F.sum("after") < F.sum("before"), 0).otherwise(1).cast("bigint").alias("failing_rows")
    ).select(
        F.lit("fewer_rows").alias("check"), F.lit(table).alias("table"), F.lit("*").alias("column"), "failing_rows"
    )


def key_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n): how many rows are copies of an earlier row with the same keys."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return per_key.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n"))


def row_accounting(counts: DataFrame) -> DataFrame:
    """From counts (role, table, n) one row per table: bronze_rows, silver_rows,
    rejected_rows, duplicate_rows, and whether the last three make up the first."""
    def rows(role: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("role") == role, F.col("n"))), F.lit(0)).alias(f"{role}_rows")

    summed = counts.groupBy("table").agg(*map(rows, ("bronze", "silver", "rejected", "duplicate")))
    return summed.withColumn("balanced", F.col("bronze_rows") == F.expr("silver_rows + rejected_rows + duplicate_rows"))


def accounted_rows(accounting: DataFrame) -> DataFrame:
    """As a check: the bronze rows of each table that are neither silver, rejected nor a
    duplicate, or are more than one of these."""
    missing = F.abs(F.expr("bronze_rows - silver_rows - rejected_rows - duplicate_rows"))
    return accounting.select(
        F.lit("accounted").alias("check"), F.concat(F.lit("bronze_"), "table").alias("table"), F.lit("*").alias("column"),
        missing.alias("failing_rows"), F.col("balanced").alias("passed"),
    )


def check_tables_exist(spark: SparkSession, present: Iterable[str], expected: Sequence[str]) -> DataFrame:
    """Metadata only: one row per expected table."""
    found = set(present)
    rows = [("exists", name, "*", 0 if name in found else 1) for name in expected]
    return spark.createDataFrame(rows, "check string, table string, column string, failing_rows bigint")


def dq_checks(tables: Mapping[str, DataFrame], expected: Sequence[str] = EXPECTED_TABLES) -> DataFrame:
    """All checks that apply to the given tables, named ``<layer>_<table>`` or ``mart_<name>``."""
    spark = next(iter(tables.values())).sparkSession
    found = [check_tables_exist(spark, tables, expected)]
    found += [check_table(name, df) for name, df in tables.items() if name in UNIQUE or _row_rules(name)]
    if {"bronze_content_events", "silver_content_events"} <= set(tables):
        found.append(
            check_fewer_rows(
                "silver_content_events", tables["silver_content_events"], tables["bronze_content_events"]
            )
        )
    return stack(found).withColumn("passed", F.col("failing_rows") == 0)
