"""Silver: typed, normalised and deduplicated tables.

Each is made from its bronze table without the lineage columns. A row without a required
value is no row of silver; values count after parsing, so an unreadable timestamp is
missing. ``checked`` keeps such rows and says why, for a table of rejects.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.functions.scalars import (
    as_number,
    as_timestamp,
    as_whole_number,
    computed_once,
    known_label,
    label_or_none,
    lower_label,
    present,
    upper_label,
)
from subtide.operators.rows import keep_first
from subtide.schemas import EVENT_KEY, RAW_SCHEMAS, RESOLUTION_STATUSES, SUBSCRIPTION_STATUSES

#: What each column that is not taken as it is becomes.
_SUBSCRIPTION_STATUS = partial(known_label, allowed=SUBSCRIPTION_STATUSES)
_RESOLUTION_STATUS = partial(known_label, allowed=RESOLUTION_STATUSES)
CONVERSIONS: dict[str, dict[str, Callable[[str], Column]]] = {
    "plans": {
        "plan_name": lower_label, "billing_cycle": lower_label, "list_price": partial(as_number, kind="double"),
    },
    "users": {
        "signup_ts": as_timestamp, "country": upper_label, "acquisition_channel": lower_label, "device_preference": lower_label,
    },
    "subscriptions": {
        "start_ts": as_timestamp, "end_ts": as_timestamp, "status": _SUBSCRIPTION_STATUS,
        "auto_renew_flag": partial(as_number, kind="boolean"),
    },
    "payments": {
        "payment_ts": as_timestamp, "amount": partial(as_number, kind="double"),
        "payment_status": lower_label, "failure_reason": label_or_none,
    },
    "content_events": {
        "event_ts": as_timestamp, "event_type": lower_label, "watch_seconds": as_whole_number,
        "device_type": lower_label, "category": lower_label,
    },
    "support_cases": {"case_ts": as_timestamp, "issue_type": lower_label, "resolution_status": _RESOLUTION_STATUS},
}
#: Columns that a row of silver must have. Unreadable times of subscriptions and cases stay
#: as NULL.
REQUIRED: dict[str, tuple[str, ...]] = {
    "plans": (),
    "users": ("user_id", "signup_ts"),
    "subscriptions": ("subscription_id", "user_id"),
    "payments": ("payment_id", "payment_ts"),
    "content_events": ("user_id", "event_ts", "watch_seconds"),
    "support_cases": ("case_id",),
}
POSITIVE: dict[str, tuple[str, ...]] = {"content_events": ("watch_seconds",)}


def _parsed(name: str, bronze: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The bronze table with what its rules need parsed, once, and all columns of silver.

    Rules of raw columns reach the scan as filters; those of parsed ones are evaluated on
    the parsed value, not by parsing again.
    """
    converted = CONVERSIONS[name]
    ruled = {f"_{c}": converted[c](c) for c in REQUIRED[name] if c in converted}
    df = computed_once(bronze, **ruled) if ruled else bronze
    return df, {
        c: F.col(f"_{c}") if f"_{c}" in ruled else converted[c](c) if c in converted else F.col(c)
        for c in RAW_SCHEMAS[name].names
    }


def typed(name: str, bronze: DataFrame) -> DataFrame:
    """The rows that pass the table's rules, with typed and normalised columns."""
    df, columns = _parsed(name, bronze)
    rows = df.select(*[column.alias(c) for c, column in columns.items()])
    if REQUIRED[name]:
        rows = rows.filter(present(*REQUIRED[name]))
    for c in POSITIVE.get(name, ()):
        rows = rows.filter(F.col(c) > 0)
    return rows


def _reason(name: str, columns: Mapping[str, Column]) -> Column:
    """The first rule that a row breaks; NULL if it breaks none."""
    reason = F.lit(None).cast("string")
    for c in reversed(POSITIVE.get(name, ())):
        reason = F.when(columns[c] <= 0, f"{c} not positive").otherwise(reason)
    for c in reversed(REQUIRED[name]):
        if c in CONVERSIONS[name]:
            reason = F.when(columns[c].isNull(), f"{c} unreadable").otherwise(reason)
        reason = F.when(F.col(c).isNull(), f"{c} missing").otherwise(reason)
    return reason


def checked(name: str, bronze: DataFrame) -> DataFrame:
    """All rows of the bronze table: silver's columns, ``reason``, and for rows with a reason
    ``raw``, the bronze row as it came. Rows without one are those of ``typed``."""
    df, columns = _parsed(name, bronze)
    raw = F.struct(*[F.col(f"`{c}`") for c in bronze.columns])
    return df.select("*", _reason(name, columns).alias("_reason")).select(
        *[column.alias(c) for c, column in columns.items()],
        F.col("_reason").alias("reason"), F.when(F.col("_reason").isNotNull(), raw).alias("raw"),
    )


def rejected(name: str, bronze: DataFrame) -> DataFrame:
    """(reason, raw) of the rows that silver leaves out for a broken rule."""
    return checked(name, bronze).filter(F.col("reason").isNotNull()).select("reason", "raw")


def longest_watch(events: DataFrame) -> DataFrame:
    """One row per natural key: of differing copies the longest watch stays.

    Labels are normalised by then, so ``play`` and `` Play`` are the same event.
    """
    longest_first = [
        F.col("watch_seconds").desc(),
        F.col("device_type").asc_nulls_last(),
        F.col("category").asc_nulls_last(),
    ]
    return keep_first(events, EVENT_KEY, longest_first)


def typed_events(bronze: DataFrame) -> DataFrame:
    """Valid viewing events before deduplication."""
    return typed("content_events", bronze)


def silver_plans(bronze: DataFrame) -> DataFrame:
    return typed("plans", bronze)


def silver_users(bronze: DataFrame) -> DataFrame:
    return typed("users", bronze)


def silver_subscriptions(bronze: DataFrame) -> DataFrame:
    return typed("subscriptions", bronze)


def silver_payments(bronze: DataFrame) -> DataFrame:
    return typed("payments", bronze)


def silver_content_events(bronze: DataFrame) -> DataFrame:
    return longest_watch(typed_events(bronze))


def silver_support_cases(bronze: DataFrame) -> DataFrame:
    return typed("support_cases", bronze)


SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "plans": silver_plans,
    "users": silver_users,
    "subscriptions": silver_subscriptions,
    "payments": silver_payments,
    "content_events": silver_content_events,
    "support_cases": silver_support_cases,
}


def silver_tables(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: clean(bronze[name]) for name, clean in SILVER.items()}
