"""Every kind of check finds planted failures, and only those."""

import pytest

from subtide.plans.quality import check_table, dq_checks


def results(df):
    return {(r.check, r.table, r.column): (r.failing_rows, r.passed) for r in df.collect()}


@pytest.fixture
def tables(spark):
    return {
        "bronze_content_events": spark.range(3).toDF("x"),
        "silver_content_events": spark.sql(
            "SELECT * FROM VALUES ('u', 'c', 1, 'play', 5), ('u', 'c', 1, 'play', 0), ('u', 'c', 2, 'play', -1)"
            " AS t(user_id, content_id, event_ts, event_type, watch_seconds)"
        ),
        "silver_subscriptions": spark.sql("SELECT * FROM VALUES ('active'), ('odd'), (NULL) AS t(status)"),
        "mart_churn_risk": spark.sql(
            "SELECT * FROM VALUES ('a', 'high', 3), ('a', 'low', 4), (NULL, NULL, NULL), (NULL, 'none', 0)"
            " AS t(user_id, churn_risk_label, churn_risk_score)"
        ),
    }


def test_failures_are_counted(spark, tables):
    found = results(dq_checks(tables, expected=["mart_churn_risk", "mart_retention"]))
    assert found == {
        ("exists", "mart_churn_risk", "*"): (0, True),
        ("exists", "mart_retention", "*"): (1, False),
        ("positive", "silver_content_events", "watch_seconds"): (2, False),
        ("unique", "silver_content_events", "user_id, content_id, event_ts, event_type"): (1, False),
        ("fewer_rows", "silver_content_events", "*"): (1, False),
        ("accepted_values", "silver_subscriptions", "status"): (1, False),
        ("not_null", "mart_churn_risk", "user_id"): (2, False),
        ("not_null", "mart_churn_risk", "churn_risk_label"): (1, False),
        ("not_null", "mart_churn_risk", "churn_risk_score"): (1, False),
        ("accepted_values", "mart_churn_risk", "churn_risk_label"): (1, False),
        ("accepted_values", "mart_churn_risk", "churn_risk_score"): (1, False),
        ("unique", "mart_churn_risk", "user_id"): (1, False),
    }


def test_null_is_a_value_in_the_natural_key_only(spark):
    events = spark.sql(
        "SELECT * FROM VALUES ('u', NULL, 1, 'play', 5), ('u', NULL, 1, 'play', 6) AS t(user_id, content_id, event_ts, event_type, watch_seconds)"
    )
    assert [r.failing_rows for r in check_table("silver_content_events", events).filter("check = 'unique'").collect()] == [1]
    weeks = spark.sql("SELECT * FROM VALUES (NULL, 1), (NULL, 2) AS t(week_start, weekly_active_users)")
    assert [r.failing_rows for r in check_table("mart_weekly_metrics", weeks).filter("check = 'unique'").collect()] == [0]


def test_empty_tables_pass(tables):
    for name in ("silver_content_events", "silver_subscriptions", "mart_churn_risk"):
        found = results(check_table(name, tables[name].limit(0)).selectExpr("*", "failing_rows = 0 AS passed"))
        assert found and all(value == (0, True) for value in found.values())
