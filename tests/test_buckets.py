"""Failed payments and owners stored by subscription: joined without a shuffle, as counted
from the payments themselves."""

import random

from subtide.operators.rows import with_lineage
from subtide.plans import marts, medallion, rollups
from subtide.plans.staging import stage
from subtide.sinks.writers import write_buckets
from subtide.sources.layers import read_table, stored_counts
from subtide.sources.versions import current_version
from tests.helpers import event, payment, raw, silver, subscription
from tests.test_files import extracts  # noqa: F401
from tests.test_scale import conf, final_plan  # noqa: F401


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def some_tables(spark, seed=1):
    """Payments of which a third belong to one subscription, owners with several, repeated rows."""
    rng = random.Random(seed)
    subscriptions = [subscription(f"s{n}", f"u{rng.randrange(9)}") for n in range(30)]
    subscriptions += [subscriptions[3], subscription("s4", "other")]
    payments = [
        payment(f"p{n}", "2024-01-01 00:00:00", rng.choice(["failed", "success"]), sid="s3" if n % 3 == 0 else f"s{rng.randrange(40)}")
        for n in range(300)
    ]
    return stage("payments", silver(spark, "payments", *payments)), stage("subscriptions", silver(spark, "subscriptions", *subscriptions))


def no_broadcast(conf):  # noqa: F811
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


def test_stored_counts_meet_without_a_shuffle(spark, tmp_path, conf):  # noqa: F811
    no_broadcast(conf)
    payments, subscriptions = some_tables(spark)
    base = str(tmp_path / "it's a lake")
    write_buckets(marts.failed_by_subscription(payments), base, "rollups", "failed", "subscription_id", 3)
    write_buckets(rollups.subscription_owners(subscriptions), base, "rollups", "owners", "subscription_id", 3)
    failed, owners = (read_table(spark, base, "rollups", name) for name in ("failed", "owners"))
    joined = rollups.failed_of_owners(failed, owners)
    plan = final_plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in joined._jdf.queryExecution().toString()
    by_user = rollups.failed_by_user(failed, owners)
    assert final_plan(by_user).count("Exchange hashpartitioning") == 1  # on the user
    assert rows_of(by_user) == rows_of(marts.failed_payments_by_user(payments, subscriptions))


def test_a_bucket_is_one_file_and_leaves_no_name(spark, tmp_path):
    before = {t.name for t in spark.catalog.listTables()}
    df = spark.range(100).selectExpr("id % 10 AS k", "concat('x', id) AS v")
    base = str(tmp_path)
    for n in (4, 2):  # written anew, with other buckets
        write_buckets(df, base, "rollups", "t", "k", n)
        table = read_table(spark, base, "rollups", "t")
        assert rows_of(table) == rows_of(df) and table.schema["v"].dataType == df.schema["v"].dataType
        assert len(table.inputFiles()) <= n
    assert stored_counts(spark, base, "rollups", ["t"]) == {"t": 100}
    write_buckets(df.filter("k < 0"), base, "rollups", "t", "k", 4)
    assert read_table(spark, base, "rollups", "t").collect() == []
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    base = str(tmp_path)
    write_buckets(spark.range(5).selectExpr("id AS k"), base, "rollups", "t", "k", 2)
    try:
        write_buckets(spark.range(5).selectExpr("CAST(raise_error('broken') AS int) AS k"), base, "rollups", "t", "k", 2)
        raise AssertionError("the write should have failed")
    except Exception as e:  # noqa: BLE001
        assert "broken" in str(e)
    assert read_table(spark, base, "rollups", "t").count() == 5
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("subtide_")]


def test_the_churn_mart_takes_stored_counts_while_they_hold(spark, extracts, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    medallion.build_all(spark, extracts, base, as_of="2024-02-15")
    expected = rows_of(read_table(spark, base, "gold", "mart_churn_risk"))
    assert any(r.failed_payment_count for r in read_table(spark, base, "gold", "mart_churn_risk").collect())
    assert medallion.stored_failures(spark, base) is None
    medallion.build_failed_counts(spark, base)
    stored = medallion.stored_failures(spark, base)
    assert rows_of(stored) == [(1, "u1")]
    tables = medallion.staging_tables(medallion.silver_layer(spark, base))
    churn = marts.mart_tables(tables, "2024-02-15", stored)["mart_churn_risk"]
    assert not any("payments" in f.rpartition("/rollups/")[0] + f.rpartition("/checked/")[2] for f in churn.inputFiles())
    assert rows_of(churn) == expected
    late = with_lineage(raw(spark, "content_events", event("u3", at="2024-02-08 10:00:00")), "late.json", "2024-03-01 00:00:00")
    medallion.add_events(spark, base, late, as_of="2024-02-15")
    plain = marts.mart_tables(medallion.staging_tables(medallion.silver_layer(spark, base)), "2024-02-15")["mart_churn_risk"]
    assert rows_of(read_table(spark, base, "gold", "mart_churn_risk")) == rows_of(plain)
    # payments written again: the counts no longer hold
    medallion.build_silver(spark, base)
    assert current_version(spark, base, medallion.ROLLUPS, medallion.FAILED) and medallion.stored_failures(spark, base) is None
