"""Numbers without gaps, bitmaps against plain sets, and rollups kept up to date."""

import random

import pytest

from subtide.operators.bitmaps import bitmaps_of, count_union, number_values
from subtide.plans import medallion, rollups
from tests.helpers import event, silver
from tests.test_files import extracts  # noqa: F401
from tests.test_refresh import batch, some_events


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_numbers_are_dense_and_repeatable(spark, buckets):
    df = spark.range(500).selectExpr("IF(id % 50 = 0, NULL, concat('user-', id % 120)) AS u", "id").repartition(5)
    numbers = [tuple(r) for r in number_values(df, "u", 11, buckets).collect()]
    assert sorted(n for _, n in numbers) == list(range(11, 11 + len(numbers)))
    assert {u for u, _ in numbers} == {r.u for r in df.collect() if r.u}
    again = number_values(df.repartition(2).unionByName(df.limit(9)), "u", 11, buckets)
    assert sorted(numbers) == sorted(tuple(r) for r in again.collect())
    assert number_values(df.filter("u IS NULL"), "u").collect() == []


def test_unions_of_bitmaps_count_sets(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.choice([1, 5, 32768, 32769, 40000, 99999, 3_000_000])) for _ in range(60)]
    df = spark.createDataFrame(rows, "g string, number long")
    bits = bitmaps_of(df, "g")
    assert {r.g: r.n for r in count_union(bits, "g").collect()} == {g: len({n for h, n in rows if h == g}) for g in "abc"}
    assert count_union(bits).first().n == len({n for _, n in rows})


def test_active_users_over_gaps(spark):
    events = silver(
        spark, "content_events", event("a", at="2024-01-01 00:00:00"), event("b", at="2024-01-07 23:59:59"), event("a", at="2024-01-22 00:00:00"),
        event("c", at="2024-01-23 00:00:00"), event("a", at="2024-02-19 00:00:00"), event("a", "c2", at="2024-02-20 00:00:00"),
    )
    found = rollups.active_users(rollups.week_users(events, rollups.user_numbers(events)), 4)
    assert sorted((str(r.week_start.date()), r.weekly_active_users, r.span_active_users) for r in found.collect()) == [
        ("2024-01-01", 2, 2), ("2024-01-22", 2, 3), ("2024-02-19", 1, 1),
    ]


def test_rollups_follow_added_events(spark, extracts, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    medallion.build_all(spark, extracts, base, as_of="2024-02-15")
    medallion.build_rollups(spark, base)
    rng = random.Random(2)
    for n in (30, 5, 0):
        medallion.add_events(spark, base, batch(spark, *some_events(rng, n), *([event("new-user", at="2024-02-08 10:00:00")] if n == 5 else [])), as_of="2024-02-15")
        events = medallion.silver_layer(spark, base)["content_events"]
        expected = rollups.active_users(rollups.week_users(events, rollups.user_numbers(events)))
        counted = medallion.count_active_users(spark, base)
        assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, expected.collect()))
        assert not any("content_events" in f for f in counted.inputFiles())
    weekly = {r.week_start: r.weekly_active_users for r in medallion.read_table(spark, base, "gold", "mart_weekly_metrics").collect()}
    assert {r.week_start: r.weekly_active_users for r in medallion.count_active_users(spark, base).collect()} == weekly
