"""Raw schemas, label domains and keys of the six subscription tables.

Everything silver parses arrives as text, so no read needs a pass over the input
to infer types and a malformed value becomes NULL instead of failing the job.
"""

from pyspark.sql import types as T


def _text_fields(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# The columns of the raw files.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "plans": _text_fields("plan_id", "plan_name", "billing_cycle", "list_price"),
    "users": _text_fields("user_id", "signup_ts", "country", "acquisition_channel", "device_preference"),
    "subscriptions": _text_fields(
        "subscription_id", "user_id", "plan_id", "start_ts", "end_ts", "status", "auto_renew_flag"
    ),
    "payments": _text_fields(
        "payment_id", "subscription_id", "payment_ts", "amount", "currency", "payment_status", "failure_reason"
    ),
    "content_events": _text_fields(
        "user_id", "content_id", "event_ts", "event_type", "watch_seconds", "device_type", "category"
    ),
    "support_cases": _text_fields("case_id", "user_id", "case_ts", "issue_type", "resolution_status"),
}

TABLES = tuple(RAW_SCHEMAS)

RAW_FILES = {
    name: f"{name}.json" if name == "content_events" else f"{name}.csv" for name in TABLES
}

# Lineage columns, labels, the trial plan and the event key.
LINEAGE = ("_ingested_at", "_source_file")
FREE_PLAN = "plan_free"
UNKNOWN = "unknown"
SUBSCRIPTION_STATUSES = ("active", "cancelled", "expired")
RESOLUTION_STATUSES = ("resolved", "pending", "escalated")
PAYMENT_STATUSES = ("success", "failed")
EVENT_KEY = ("user_id", "content_id", "event_ts", "event_type")
MARTS = (
    "mart_trial_conversion",
    "mart_retention",
    "mart_payment_failures",
    "mart_churn_risk",
    "mart_weekly_metrics",
)
