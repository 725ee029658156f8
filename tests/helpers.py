"""Small hand-made tables for the tests."""

import datetime as dt

from subtide.plans.silver import SILVER
from subtide.plans.staging import stage
from subtide.schemas import RAW_SCHEMAS


def ts(text):
    return dt.datetime.fromisoformat(text)


def raw(spark, name, *rows):
    """Raw rows as dicts; missing columns are NULL, all values text."""
    names = RAW_SCHEMAS[name].names
    values = [tuple(None if row.get(c) is None else str(row[c]) for c in names) for row in rows]
    return spark.createDataFrame(values, RAW_SCHEMAS[name])


def silver(spark, name, *rows):
    return SILVER[name](raw(spark, name, *rows))


def staged(spark, name, *rows):
    return stage(name, silver(spark, name, *rows))


def event(user="u1", content="c1", at="2024-01-01 10:00:00", kind="play", seconds=60, **more):
    return {
        "user_id": user, "content_id": content, "event_ts": at, "event_type": kind,
        "watch_seconds": seconds, "device_type": "mobile", "category": "drama", **more,
    }


def subscription(sid="s1", user="u1", plan="plan_basic", start="2024-01-01 00:00:00", **more):
    return {
        "subscription_id": sid, "user_id": user, "plan_id": plan, "start_ts": start,
        "end_ts": "2024-01-10 00:00:00", "status": "active", "auto_renew_flag": "true", **more,
    }


def payment(pid, at, status, sid="s1", **more):
    return {
        "payment_id": pid, "subscription_id": sid, "payment_ts": at, "amount": "9.99",
        "currency": "USD", "payment_status": status, **more,
    }


def user(uid="u1", **more):
    return {
        "user_id": uid, "signup_ts": "2024-01-01 00:00:00", "country": "in",
        "acquisition_channel": "organic", "device_preference": "mobile", **more,
    }


def case(cid, uid="u1", **more):
    return {"case_id": cid, "user_id": uid, "case_ts": "2024-01-01 00:00:00", "issue_type": "billing_issue",
            "resolution_status": "resolved", **more}
