"""Plans that must hold at scale: exact joins against brute force, and hot keys."""

import random
import re

import pytest
from pyspark.sql import functions as F

from subtide.operators.joins import first_within_days, hash_join, left_join_from
from subtide.operators.rows import keep_first
from subtide.plans import marts, silver
from subtide.plans.staging import stage
from subtide.schemas import EVENT_KEY, RAW_SCHEMAS


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_all(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffled(conf):
    """No broadcast, and thresholds low enough for small data to count as skewed."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="8",
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def timed_rows(spark, rows, names):
    """Rows of (key, minutes) with minutes turned into timestamps from 1969 on, across the epoch."""
    df = spark.createDataFrame(rows, f"{names[0]} string, m int")
    return df.select(
        names[0], (F.lit("1969-12-20 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins="m")).alias(names[1])
    )


@pytest.mark.parametrize("seed", range(4))
def test_first_within_days_equals_pairing(spark, seed):
    rng = random.Random(seed)
    minutes = 60 * 24 * (20 if seed % 2 else 60)
    step = rng.choice([1, 60, 60 * 24])

    def rows(n):
        return [(rng.choice("abcdef"), rng.randrange(minutes // step) * step) for _ in range(n)]

    opens, hits = rows(25), rows(25)
    df = first_within_days(
        timed_rows(spark, opens, ("k", "o")), timed_rows(spark, hits, ("k", "h")), "k", "o", "h", 7, "first"
    )
    base = timed_rows(spark, [("x", 0)], ("k", "t")).first().t
    got = {r.k: int((r["first"] - base).total_seconds()) // 60 for r in df.collect()}
    week = 7 * 24 * 60
    expected = {}
    for k, h in hits:
        if any(k == ok and o < h <= o + week for ok, o in opens):
            expected[k] = min(h, expected.get(k, h))
    assert got == expected


def test_first_within_days_tasks_grow_with_rows(spark, monkeypatch):
    """A task sorts a bounded number of rows, however many shuffle partitions the session has."""
    from subtide.operators import joins

    monkeypatch.setattr(joins, "ROWS_PER_TASK", 10)
    opens = [(f"k{i % 7}", i * 600) for i in range(100)]
    hits = [(f"k{i % 7}", i * 600 + 30) for i in range(100)]
    df = first_within_days(
        timed_rows(spark, opens, ("k", "o")), timed_rows(spark, hits, ("k", "h")), "k", "o", "h", 7, "first"
    )
    assert df.rdd.getNumPartitions() >= 20
    base = timed_rows(spark, [("x", 0)], ("k", "t")).first().t
    got = {r.k: int((r["first"] - base).total_seconds()) // 60 for r in df.collect()}
    assert got == {f"k{j}": j * 600 + 30 for j in range(7)}


@pytest.mark.parametrize("seed", range(3))
def test_left_join_from_equals_nested_loops(spark, seed):
    rng = random.Random(seed)

    def rows(n):
        return [
            (rng.choice(["a", "b", "c", "d", None]), None if rng.random() < 0.1 else rng.randrange(10), i)
            for i in range(n)
        ]

    left, right = rows(30), rows(20)
    df = left_join_from(
        spark.createDataFrame(left, "k string, l int, li int"),
        spark.createDataFrame(right, "k string, r int, ri int"),
        "k", "l", "r",
    )
    expected = []
    for k, start, li in left:
        hits = [ri for rk, r, ri in right if k is not None and k == rk and None not in (r, start) and r >= start]
        expected += [(li, ri) for ri in hits or [None]]
    assert sorted(((r.li, r.ri) for r in df.collect()), key=repr) == sorted(expected, key=repr)


def hot(spark, n):
    """A third of the rows on one key, the rest spread out."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    ).repartition(8)


def test_hash_join_splits_a_hot_key(spark, conf):
    shuffled(conf)
    many = hot(spark, 20000)
    one = many.groupBy("k").agg(F.count("*").alias("n"))
    df = hash_join(many, one, ["k"])
    assert "skew=true" in final_plan(df)
    assert df.filter("k = 'hot'").agg(F.count("*"), F.min("n")).first() == (6667, 6667)
    assert df.count() == 20000

    plain = many.join(one, "k", "left")
    assert "skew=true" not in final_plan(plain)


def test_hash_join_refuses_keys_of_different_types(spark):
    with pytest.raises(ValueError, match="join key id is bigint and int"):
        hash_join(spark.range(1), spark.range(1).selectExpr("CAST(id AS INT) AS id"), ["id"])


def test_left_join_from_splits_a_hot_right_side(spark, conf):
    shuffled(conf)
    right = hot(spark, 20000)
    left = spark.createDataFrame([("hot", 5), ("hot", 30000), ("none", 1)], "k string, start int")
    df = left_join_from(left, right, "k", "start", "id")
    assert "skew=true" in final_plan(df)
    assert df.filter("id IS NOT NULL").count() == 6665
    assert sorted(r.start for r in df.filter("id IS NULL").collect()) == [1, 30000]


def hot_payments(spark, n):
    """Alternating failures and successes, all of one subscription for a third of the rows."""
    return hot(spark, n).select(
        F.col("id").cast("string").alias("payment_id"),
        F.col("k").alias("subscription_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("payment_ts"),
        F.lit(1.0).alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(F.col("id") % 2 == 0, "failed").otherwise("success").alias("payment_status"),
        F.col("pad").alias("failure_reason"),
    )


def test_recoveries_do_not_pair_rows(spark, conf):
    """One subscription with thousands of failures and successes stays linear: its rows are
    joined with nothing, and dealt to tasks by the hour."""
    shuffled(conf)
    payments = hot_payments(spark, 30000)
    recovered = marts.payment_recoveries(payments)
    plan = final_plan(recovered)
    assert "Join" not in plan
    assert re.search(r"Exchange hashpartitioning\(subscription_id#\d+, _hour#\d+, 8\)", plan)
    assert [(r.subscription_id, str(r.recovered_at)) for r in recovered.collect()] == [("hot", "2024-01-01 00:03:00")]

    mart = marts.mart_payment_failures(payments)
    assert "skew=true" in final_plan(mart)
    assert mart.filter("recovered_within_7_days").count() == 5000
    assert mart.count() == 15000


def test_recoveries_take_one_scan_and_the_mart_four_shuffles(spark, tmp_path, conf):
    shuffled(conf)
    conf(spark__sql__adaptive__enabled="false")
    silver.silver_payments(spark.createDataFrame([], RAW_SCHEMAS["payments"])).write.parquet(f"{tmp_path}/payments")
    payments = stage("payments", spark.read.parquet(f"{tmp_path}/payments"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    recoveries = plan(marts.payment_recoveries(payments))
    assert (recoveries.count("FileScan"), recoveries.count("Exchange hashpartitioning")) == (1, 2)
    assert plan(marts.mart_payment_failures(payments)).count("Exchange hashpartitioning") == 4


def test_deduplication_limits_copies_before_the_shuffle(spark):
    rows = spark.range(0, 20000, 1, 8).select(
        *[
            F.when(F.col("id") % 3 == 0, v).otherwise(F.concat(F.lit(v), F.col("id"))).alias(c) if c == "content_id"
            else F.lit(v).alias(c)
            for c, v in {
                "user_id": "u", "content_id": "c", "event_ts": "2024-01-01 00:00:00", "event_type": "play",
                "watch_seconds": "9", "device_type": "mobile", "category": "kids",
            }.items()
        ]
    )
    df = silver.silver_content_events(rows)
    plan = final_plan(df)
    partial = plan.index("Partial")
    assert plan.index("Exchange") < partial, "the partial limit must sit below the exchange"
    assert df.count() == 20000 - 6667 + 1


def test_keep_first_orders_within_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, v int")
    assert sorted(tuple(r) for r in keep_first(df, ["k"], [F.col("v").desc()]).collect()) == [("a", 3), ("b", 2)]


def test_marts_reach_the_scan_with_filters_and_few_columns(spark, tmp_path, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__maxMetadataStringLength="10000")
    path = str(tmp_path / "subscriptions")
    silver.silver_subscriptions(spark.createDataFrame([], RAW_SCHEMAS["subscriptions"])).write.parquet(path)
    plan = marts.weekly_renewals(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,active)" in plan
    assert re.search(r"ReadSchema: struct<start_ts:timestamp_ntz,status:string,auto_renew_flag:boolean>", plan)


def test_bronze_null_keys_are_pruned_at_the_scan(spark, tmp_path, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__maxMetadataStringLength="10000")
    path = str(tmp_path / "events")
    spark.createDataFrame([], RAW_SCHEMAS["content_events"]).write.parquet(path)
    plan = silver.typed_events(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(user_id)" in plan


def test_churn_signals_take_one_aggregation(spark, conf):
    """All four signals share one shuffle on the user instead of one each."""
    shuffled(conf)
    conf(spark__sql__adaptive__enabled="false")
    schemas = {n: spark.createDataFrame([], RAW_SCHEMAS[n]) for n in RAW_SCHEMAS}
    clean = silver.silver_tables(schemas)
    plan = (
        marts.user_signals(
            silver.typed_events(schemas["content_events"]), clean["payments"], clean["subscriptions"],
            clean["support_cases"],
        )._jdf.queryExecution().executedPlan().toString()
    )
    assert len(re.findall(r"Exchange hashpartitioning\(user_id#\d+, 8\)", plan)) == 1


def test_churn_from_stored_tables_takes_four_shuffles(spark, tmp_path, conf):
    """Payments and subscriptions on the subscription, the signals and the users on the user."""
    shuffled(conf)
    conf(spark__sql__adaptive__enabled="false")
    for name in RAW_SCHEMAS:
        silver.SILVER[name](spark.createDataFrame([], RAW_SCHEMAS[name])).write.parquet(f"{tmp_path}/{name}")
    staged = {n: stage(n, spark.read.parquet(f"{tmp_path}/{n}")) for n in RAW_SCHEMAS}
    plan = marts.mart_tables(staged, "2024-02-15")["mart_churn_risk"]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 4


def test_event_key_is_the_natural_key():
    assert EVENT_KEY == ("user_id", "content_id", "event_ts", "event_type")
