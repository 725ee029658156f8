"""Raw subscription tables derived from a star schema of orders and events.

Feeds the registered queries: every row of the source tables becomes a raw row
of text, with the defects silver has to clean (stray case and spaces, missing
keys, unreadable timestamps, repeated events). Rules are listed in FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.schemas import RAW_SCHEMAS

# The columns used, so that no read has to look up a schema first.
_SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}

AS_OF = "2024-02-15"
INGESTED_AT = "2024-02-15 06:00:00"


def _pick(index: str, *values: str) -> str:
    """SQL for the value at a zero-based index."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({index} AS INT) + 1)"


def _day(number: str) -> str:
    """SQL for the text timestamp that many days after the start of 2024."""
    return f"concat(date_add(DATE '2024-01-01', CAST({number} AS INT)), ' 00:00:00')"


def _select(df: DataFrame, name: str, columns: dict[str, str]) -> DataFrame:
    """The raw table as text columns."""
    return df.select(*[F.expr(columns[c]).cast("string").alias(c) for c in RAW_SCHEMAS[name].names])


PLAN_IDS = ("plan_free", "plan_basic", "plan_standard", "plan_premium", "plan_annual")


def _plans(table: Callable[[str], DataFrame]) -> DataFrame:
    return _select(table("region"), "plans", {
        "plan_id": _pick("r_regionkey", *PLAN_IDS),
        "plan_name": "concat(' ', r_name, ' ')",
        "billing_cycle": "CASE r_regionkey WHEN 0 THEN 'Trial' WHEN 4 THEN ' YEARLY' ELSE 'monthly' END",
        "list_price": "r_regionkey * 5 - 0.01",
    })


def _users(table: Callable[[str], DataFrame]) -> DataFrame:
    customers = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return _select(customers, "users", {
        "user_id": "CASE WHEN c_custkey % 97 <> 96 THEN c_custkey END",
        "signup_ts": (
            "CASE WHEN c_custkey % 89 = 88 THEN NULL WHEN c_custkey % 83 = 82 THEN 'not a date' "
            "WHEN c_custkey % 79 = 78 THEN '2024-1-5' WHEN c_custkey % 73 = 72 THEN '      2024' "
            "WHEN c_custkey % 71 = 70 THEN '2024-01-05T10:00:00Z' WHEN c_custkey % 67 = 66 THEN ' 2024-01-05 10:00:00 ' "
            r"WHEN c_custkey % 61 = 60 THEN '2024-01-05\n' "
            f"ELSE {_day('c_custkey % 25')} END"
        ),
        "country": "concat(' ', lower(n_name))",
        "acquisition_channel": "c_mktsegment",
        "device_preference": _pick("c_custkey % 4", "Mobile", "desktop", "tablet ", "smart_tv"),
    })


def _subscriptions(table: Callable[[str], DataFrame]) -> DataFrame:
    return _select(table("orders"), "subscriptions", {
        "subscription_id": "o_orderkey",
        "user_id": "CASE WHEN o_orderkey % 101 <> 100 THEN o_custkey END",
        "plan_id": f"CASE WHEN o_orderkey % 109 <> 108 THEN {_pick('o_orderkey % 5', *PLAN_IDS)} END",
        "start_ts": f"CASE WHEN o_orderkey % 103 = 102 THEN 'not a date' ELSE {_day('(o_orderkey * 7) % 30')} END",
        "end_ts": _day("(o_orderkey * 7) % 30 + 7 + o_orderkey % 8"),
        "status": (
            "CASE WHEN o_orderkey % 50 = 7 THEN 'paused' WHEN o_orderkey % 50 = 8 THEN NULL "
            "WHEN o_orderstatus = 'F' THEN ' Active' WHEN o_orderstatus = 'P' THEN 'expired' "
            "WHEN o_orderkey % 10 = 1 THEN 'CANCELLED' ELSE 'active' END"
        ),
        "auto_renew_flag": "o_orderkey % 2 = 0",
    })


def _payments(table: Callable[[str], DataFrame]) -> DataFrame:
    lines = table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_extendedprice").alias("price"),
        F.max(F.col("l_returnflag") == "R").alias("returned"),
    )
    failed = "returned AND l_linenumber % 2 = 1"
    return _select(lines, "payments", {
        "payment_id": "concat(l_orderkey, '-', l_linenumber)",
        "subscription_id": "CASE WHEN l_orderkey % 107 <> 106 THEN l_orderkey END",
        "payment_ts": (
            "CASE WHEN l_orderkey % 113 = 112 AND l_linenumber = 3 THEN 'not a date' "
            "WHEN l_orderkey % 113 = 111 AND l_linenumber = 3 THEN '2024-02    ' "
            "WHEN l_orderkey % 113 = 110 AND l_linenumber = 3 THEN '2024-1-5 7:30' "
            "WHEN l_orderkey % 113 = 109 AND l_linenumber = 3 THEN '2024-01-15T10:00:00+02:00' "
            "WHEN l_orderkey % 113 = 108 AND l_linenumber = 3 THEN '2024-01-15 10:00:00.5 UTC' "
            f"ELSE {_day('(l_orderkey * 7) % 30 + l_linenumber * 4')} END"
        ),
        "amount": "price",
        "currency": "CASE WHEN l_linenumber = 2 THEN ' usd' ELSE 'USD' END",
        "payment_status": f"CASE WHEN {failed} THEN 'Failed' ELSE 'success' END",
        "failure_reason": f"CASE WHEN {failed} AND l_linenumber <> 5 THEN ' Card_Expired' END",
    })


def _content_events(table: Callable[[str], DataFrame]) -> DataFrame:
    """A twentieth of the events arrives twice, the copy with other case and, for
    some, a shorter watch. A third of the users stopped watching early.
    """
    viewed = table("events").withColumns({
        "viewer": F.expr("user_id * 10 + event_id % 7"),
        "copy": F.expr("explode(CASE WHEN event_id % 20 = 0 THEN array(0, 1) ELSE array(0) END)"),
        "label": F.expr(
            "CASE event_type WHEN 'view' THEN 'Play' WHEN 'click' THEN ' pause' "
            "WHEN 'purchase' THEN 'complete' WHEN 'signup' THEN 'seek' ELSE 'stop' END"
        ),
    })
    return _select(viewed, "content_events", {
        "user_id": "CASE WHEN event_id % 211 <> 210 THEN viewer END",
        "content_id": "CASE WHEN event_id % 100 <> 60 THEN concat('content_', event_id % 200) END",
        "event_ts": (
            "CASE WHEN event_id % 223 = 222 THEN 'not a date' "
            "WHEN event_id % 227 = 226 THEN concat(replace(CAST(ts AS STRING), ' ', 'T'), 'Z') "
            "WHEN event_id % 229 = 228 THEN concat(' ', CAST(ts AS STRING), '+0530 ') WHEN viewer % 3 = 0 "
            "THEN CAST(ts - INTERVAL '20' DAY AS STRING) ELSE CAST(ts AS STRING) END"
        ),
        "event_type": "CASE WHEN copy = 1 THEN upper(label) ELSE label END",
        "watch_seconds": (
            "concat(CAST(floor(value * 10) AS INT) - CASE WHEN copy = 1 AND event_id % 40 = 0 THEN 1 ELSE 0 END, "
            "CASE event_id % 7 WHEN 3 THEN '.0' WHEN 4 THEN '.5' ELSE '' END)"
        ),
        "device_type": _pick("event_id % 4", "Mobile", "desktop", "tablet", "smart_tv"),
        "category": _pick("event_id % 3", "Drama", " kids", "sports"),
    })


def _support_cases(table: Callable[[str], DataFrame]) -> DataFrame:
    """A case for every order. Of four neighbouring customers one has most of the cases,
    two have few, and one has none."""
    return _select(table("orders"), "support_cases", {
        "case_id": "o_orderkey",
        "user_id": "o_custkey - o_custkey % 4 + CASE o_orderkey % 16 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END",
        "case_ts": _day("o_orderkey % 45"),
        "issue_type": _pick("o_orderkey % 3", "Billing_Issue", "cancellation", "plan_change"),
        "resolution_status": (
            "CASE o_orderkey % 7 WHEN 0 THEN 'reopened' WHEN 1 THEN NULL WHEN 2 THEN ' Pending' ELSE 'resolved' END"
        ),
    })


_BUILDERS = {
    "plans": _plans,
    "users": _users,
    "subscriptions": _subscriptions,
    "payments": _payments,
    "content_events": _content_events,
    "support_cases": _support_cases,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    def table(source: str) -> DataFrame:
        return spark.read.schema(_SOURCES[source]).parquet(f"{sf_dir}/{source}.parquet")

    return _BUILDERS[name](table)
