"""Events that arrive later: only what they touch is written again, as a full rebuild has it."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from subtide.operators.rows import with_lineage
from subtide.plans import medallion
from subtide.schemas import MARTS
from subtide.sinks.writers import append_table, replace_partitions, write_table
from subtide.sinks import writers
from subtide.sources.layers import read_table, stored_counts
from subtide.sources.versions import current_version
from tests.helpers import event, raw
from tests.test_files import extracts  # noqa: F401


def batch(spark, *rows):
    return with_lineage(raw(spark, "content_events", *rows), "late.json", "2024-03-01 00:00:00")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def some_events(rng, n):
    return [
        event(
            rng.choice(["u1", "u3", "u9", None]), rng.choice(["c1", "c2"]),
            rng.choice(["bad", *(f"2024-{m:02d}-{d:02d} {rng.choice(['10:00:00', '23:59:59'])}" for m in (1, 2) for d in (1, 7, 8, 29))]),
            rng.choice(["play", " Pause"]), rng.choice([0, 5, 60, 90]), category=rng.choice(["drama", "kids"]),
        )
        for _ in range(n)
    ]


def test_added_events_equal_a_full_rebuild(spark, extracts, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(writers, "MOST_PARTS", 3)
    rng = random.Random(1)
    base, full = str(tmp_path / "lake"), str(tmp_path / "full")
    for folder in (base, full):
        medallion.build_all(spark, extracts, folder, as_of="2024-02-15", ingested_at="2024-02-15 06:00:00")
    for n in (40, 1, 0, 25, 12):
        late = batch(spark, *some_events(rng, n))
        days = medallion.add_events(spark, base, late, as_of="2024-02-15")
        append_table(late, full, "bronze", "content_events")
        medallion.build_all(spark, "/nowhere", full, as_of="2024-02-15", start="silver")
        for layer, name in [("bronze", "content_events"), ("silver", "content_events"), ("rejects", "content_events"), *(("gold", m) for m in MARTS)]:
            mine = read_table(spark, base, layer, name)
            assert rows_of(mine) == rows_of(read_table(spark, full, layer, name)), (layer, name, n)
            assert stored_counts(spark, base, layer, [name])[name] == mine.count()
        assert days == sorted(set(days))
        assert all(r.balanced for r in medallion.account_layers(spark, base).collect())
    assert medallion.check_layers(spark, base).filter("NOT passed").collect() == []


def test_only_the_days_and_months_touched_are_read_and_written(spark, extracts, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    medallion.build_all(spark, extracts, base, as_of="2024-02-15")
    days = medallion.add_events(spark, base, batch(spark, event(at=f"2024-02-05 10:00:00"), event(at="2024-03-09 01:00:00")), as_of="2024-02-15")
    assert days == [dt.date(2024, 2, 5), dt.date(2024, 3, 9)]
    first = current_version(spark, base, "silver", "content_events").parts
    assert [p.partitions for p in first] == [("event_date=2024-01-01",), ("event_date=2024-02-05", "event_date=2024-03-09")]
    medallion.add_events(spark, base, batch(spark, event("u3", "c9", at="2024-02-05 11:00:00")), as_of="2024-02-15")
    parts = current_version(spark, base, "silver", "content_events").parts
    assert [p.path for p in parts[:2]] == [p.path for p in first]
    assert [p.partitions for p in parts] == [("event_date=2024-01-01",), ("event_date=2024-03-09",), ("event_date=2024-02-05",)]
    assert [p.partitions for p in current_version(spark, base, "gold", "mart_retention").parts] == [
        ("month=2024-01-01",), ("month=2024-03-01",), ("month=2024-02-01",),
    ]
    scan = read_table(spark, base, "silver", "content_events").filter("event_date = DATE '2024-02-05'")
    assert len(scan.inputFiles()) == 3 and scan.count() == 2
    read = [line for line in scan._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters: [isnotnull(event_date" in line]
    assert len(read) == 3, "each part prunes its days"


def test_replaced_partitions(spark, tmp_path):
    base = str(tmp_path)
    df = spark.range(12).select("id", (F.col("id") % 4).cast("int").alias("p"))
    write_table(df, base, "silver", "t", "p")
    replace_partitions(df.filter("p = 1").withColumn("id", F.col("id") + 100), base, "silver", "t", "p", ["1", "2"])
    assert sorted(r.id for r in read_table(spark, base, "silver", "t").collect()) == [0, 3, 4, 7, 8, 11, 101, 105, 109]
    assert stored_counts(spark, base, "silver", ["t"]) == {"t": 9}
    with pytest.raises(ValueError, match="rows of other partitions: .'p=3'"):
        replace_partitions(df.filter("p = 3"), base, "silver", "t", "p", ["0"])
    assert stored_counts(spark, base, "silver", ["t"]) == {"t": 9}
    for value in "013":
        replace_partitions(df.limit(0), base, "silver", "t", "p", [value])
    assert read_table(spark, base, "silver", "t").collect() == []
    assert read_table(spark, base, "silver", "t").dtypes == df.dtypes
