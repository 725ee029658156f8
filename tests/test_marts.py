"""Mart semantics on hand-made rows."""

import datetime as dt

import pytest

from subtide.plans import marts
from subtide.plans.staging import create_staging_views, stage
from tests.helpers import case, event, payment, silver, staged, subscription, ts, user


def trial(start="2024-01-01 00:00:00", end="2024-01-10 00:00:00", uid="u1"):
    return subscription(f"t-{uid}-{start}", uid, "plan_free", start, end_ts=end)


def conversions(spark, *rows):
    df = marts.mart_trial_conversion(staged(spark, "subscriptions", *rows))
    return sorted(
        ((r.user_id, r.converted_plan, r.days_to_convert, r.conversion_status) for r in df.collect()),
        key=repr,
    )


def test_paid_start_at_trial_start_converts_with_negative_days(spark):
    assert conversions(spark, trial(), subscription("s2", "u1", "plan_basic", "2024-01-01 00:00:00")) == [
        ("u1", "plan_basic", -9, "converted"),
    ]


def test_each_later_paid_subscription_gives_a_row(spark):
    rows = conversions(
        spark, trial(),
        subscription("s0", "u1", "plan_basic", "2023-12-31 23:59:59"),
        subscription("s1", "u1", "plan_basic", "2024-01-05 00:00:00"),
        subscription("s2", "u1", "plan_annual", "2024-01-12 00:00:00"),
    )
    assert rows == [("u1", "plan_annual", 2, "converted"), ("u1", "plan_basic", -5, "converted")]


def test_unconverted_trials_and_null_plans(spark):
    rows = conversions(
        spark,
        trial(uid="early"), subscription("a", "early", "plan_basic", "2023-01-01 00:00:00"),
        trial(uid="null-plan"), subscription("b", "null-plan", None, "2024-02-01 00:00:00"),
        trial(start="bad", uid="no-start"), subscription("c", "no-start", "plan_basic", "2024-02-01 00:00:00"),
        trial(uid="no-paid-start"), subscription("d", "no-paid-start", "plan_basic", "bad"),
        subscription("e", "no-trial", "plan_basic", "2024-02-01 00:00:00"),
    )
    assert rows == [
        (uid, None, None, "not_converted") for uid in ("early", "no-paid-start", "no-start", "null-plan")
    ]


def test_days_count_midnights(spark):
    rows = conversions(
        spark, trial(end="2024-01-09 23:59:00"), subscription("s", "u1", "plan_basic", "2024-01-10 00:01:00")
    )
    assert rows[0][2] == 1


def failures(spark, *rows):
    df = marts.mart_payment_failures(staged(spark, "payments", *rows))
    return {r.payment_id: (r.recovered_at, r.recovered_within_7_days, r.days_to_recovery) for r in df.collect()}


def test_recovery_is_shared_by_the_subscription(spark):
    found = failures(
        spark,
        payment("f1", "2024-01-01 00:00:00", "failed"),
        payment("f2", "2024-01-20 00:00:00", "failed"),
        payment("ok", "2024-01-03 00:00:00", "success"),
    )
    day3 = ts("2024-01-03 00:00:00")
    assert found == {"f1": (day3, True, 2), "f2": (day3, True, -17)}


@pytest.mark.parametrize("success, recovered", [
    ("2024-01-08 12:00:00", True),
    ("2024-01-08 12:00:01", False),
    ("2024-01-01 12:00:00", False),
    ("2024-01-01 12:00:01", True),
    ("2023-12-31 12:00:00", False),
])
def test_recovery_window_bounds(spark, success, recovered):
    found = failures(
        spark, payment("f", "2024-01-01 12:00:00", "failed"), payment("ok", success, "success")
    )
    assert found["f"][1] is recovered


def test_failures_without_subscription_do_not_recover(spark):
    found = failures(
        spark,
        payment("f", "2024-01-01 00:00:00", "failed", sid=None),
        payment("ok", "2024-01-02 00:00:00", "success", sid=None),
    )
    assert found == {"f": (None, False, None)}


def test_retention_repeats_activity_per_active_plan(spark):
    df = marts.mart_retention(
        staged(spark, "content_events",
               event(seconds=1000), event(content="c2", seconds=26), event(user="lone", seconds=36)),
        staged(spark, "subscriptions",
               subscription("s1", plan="plan_basic"), subscription("s2", plan="plan_basic"),
               subscription("s3", plan="plan_unlisted"), subscription("s4", plan="plan_free"),
               subscription("s5", plan="plan_basic", user="lone", status="expired"),
               subscription("s6", plan=None)),
        staged(spark, "plans",
               {"plan_id": "plan_basic", "plan_name": "Basic", "billing_cycle": "monthly", "list_price": "9.99"}),
    )
    assert sorted((tuple(r)[4:] for r in df.collect()), key=repr) == sorted([
        ("plan_basic", "basic", "monthly", 9.99, 1026, 2, 0.29),
        ("plan_unlisted", None, None, None, 1026, 2, 0.29),
        (None, None, None, None, 36, 1, 0.01),
    ], key=repr)
    assert {r.activity_month for r in df.collect()} == {ts("2024-01-01 00:00:00")}


def churn(spark, users, events=(), payments=(), subscriptions=(), cases=(), as_of="2024-02-15"):
    df = marts.mart_churn_risk(
        staged(spark, "users", *users), staged(spark, "content_events", *events),
        staged(spark, "payments", *payments), staged(spark, "subscriptions", *subscriptions),
        staged(spark, "support_cases", *cases), as_of,
    )
    return {r.user_id: r for r in df.collect()}


def test_churn_inactivity_bounds(spark):
    found = churn(
        spark, [user("d30"), user("d31"), user("never")],
        [event("d30", at="2024-01-16 00:00:00"), event("d31", at="2024-01-15 23:59:59"), event("ghost")],
    )
    assert {u: (r.days_inactive, r.churn_risk_score) for u, r in found.items()} == {
        "d30": (30, 0), "d31": (31, 1), "never": (999, 1),
    }
    assert found["never"].last_event_ts is None


def test_churn_needs_two_support_cases(spark):
    recent = [event(u, at="2024-02-14 00:00:00") for u in ("one", "two")]
    found = churn(spark, [user("one"), user("two")], recent, cases=[case("a", "one"), case("b", "two"), case("c", "two")])
    assert {u: (r.support_case_count, r.churn_risk_score, r.churn_risk_label) for u, r in found.items()} == {
        "one": (1, 0, "low"), "two": (2, 1, "low"),
    }


def test_churn_all_signals_are_capped(spark):
    found = churn(
        spark, [user("u1", country="in")],
        payments=[payment("f1", "2024-01-01 00:00:00", "failed"), payment("f2", "2024-01-02 00:00:00", "failed")],
        subscriptions=[subscription("s1", status="cancelled"), subscription("s2")],
        cases=[case("a"), case("b")],
    )
    assert tuple(found["u1"]) == ("u1", "IN", "organic", None, 999, 2, 2, True, 3, "high")


def test_churn_medium(spark):
    found = churn(spark, [user("u1")], subscriptions=[subscription("s1", status="cancelled")])
    assert (found["u1"].churn_risk_score, found["u1"].churn_risk_label) == (2, "medium")


def test_churn_defaults_to_today(spark):
    yesterday = dt.datetime.now() - dt.timedelta(days=2)
    found = churn(spark, [user("u1")], [event(at=yesterday.strftime("%Y-%m-%d %H:%M:%S"))], as_of=None)
    assert 1 <= found["u1"].days_inactive <= 3


def test_weeks_start_on_monday_and_follow_activity(spark):
    df = marts.mart_weekly_metrics(
        staged(spark, "content_events",
               event("u1", at="2024-01-07 23:59:59", seconds=1026), event("u2", at="2024-01-07 00:00:00"),
               event("u1", at="2024-01-08 00:00:00"), event("u1", content="c2", at="2024-01-08 00:00:01")),
        staged(spark, "subscriptions",
               subscription("s1", start="2024-01-03 00:00:00"), subscription("s2", start="2024-01-01 00:00:00"),
               subscription("s3", start="2024-01-02 00:00:00", auto_renew_flag="false"),
               subscription("s4", start="2024-01-02 00:00:00", status="cancelled"),
               subscription("s5", start="2024-02-02 00:00:00")),
    )
    assert [tuple(r) for r in df.collect()] == [
        (ts("2024-01-01 00:00:00"), 2, 1086, 0.3, 2),
        (ts("2024-01-08 00:00:00"), 1, 120, 0.03, 0),
    ]


def test_staging_views(spark):
    tables = {
        name: silver(spark, name)
        for name in ("plans", "users", "subscriptions", "payments", "content_events", "support_cases")
    }
    create_staging_views(tables)
    assert spark.table("stg_users").columns == ["user_id", "signup_ts", "country", "channel", "device"]
    for name, df in tables.items():
        assert spark.catalog.tableExists(f"stg_{name}")
        if name != "users":
            assert stage(name, df).columns == df.columns
