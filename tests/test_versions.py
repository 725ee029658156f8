"""Tables are replaced in one step; rejected rows are kept with their reason."""

import pytest
from pyspark.sql import functions as F

from subtide.plans import medallion, silver
from subtide.schemas import RAW_SCHEMAS, TABLES
from subtide.sinks.writers import write_checked, write_events, write_table
from subtide.sources import versions
from subtide.sources.layers import existing_tables, read_table, stored_counts
from tests.helpers import event, payment, raw, subscription, user
from tests.test_files import extracts  # noqa: F401


def numbers(spark, base, name="t"):
    return sorted(r.id for r in read_table(spark, base, "silver", name).collect())


def failing(spark, n):
    """A table whose last rows cannot be computed."""
    return spark.range(0, n, 1, 4).select(
        F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("no such row")).cast("bigint")).alias("id")
    )


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path)
    write_table(spark.range(3), base, "silver", "t")
    with pytest.raises(Exception, match="no such row"):
        write_table(failing(spark, 100), base, "silver", "t")
    assert numbers(spark, base) == [0, 1, 2]
    assert len(list((tmp_path / "silver" / "t").glob("v-*"))) == 2
    assert versions.remove_unpublished(spark, base, "silver", "t") == [], "it may still be written"
    left = versions.remove_unpublished(spark, base, "silver", "t", older_than_hours=-1)
    assert len(left) == len(list((tmp_path / "silver" / "t").glob("v-*"))) == 1
    assert numbers(spark, base) == [0, 1, 2]
    write_table(spark.range(5), base, "silver", "t")
    assert numbers(spark, base) == [0, 1, 2, 3, 4]


def test_a_write_killed_before_it_is_published_changes_nothing(spark, tmp_path, monkeypatch):
    from subtide.sinks import writers

    def killed(*args):
        raise KeyboardInterrupt

    base = str(tmp_path)
    write_table(spark.range(2), base, "silver", "t")
    monkeypatch.setattr(writers, "publish", killed)
    for first in (True, False):
        with pytest.raises(KeyboardInterrupt):
            write_table(spark.range(9), base, "silver", "t" if first else "new")
    assert numbers(spark, base) == [0, 1]
    assert list(existing_tables(spark, base, "silver", ["t", "new"])) == ["t"]
    with pytest.raises(LookupError, match="silver/new"):
        read_table(spark, base, "silver", "new")


def test_readers_keep_their_version_and_old_ones_go(spark, tmp_path):
    base = str(tmp_path)
    write_table(spark.range(1), base, "silver", "t")
    reader = read_table(spark, base, "silver", "t")
    write_table(read_table(spark, base, "silver", "t").unionByName(spark.range(10, 12)), base, "silver", "t")
    assert [r.id for r in reader.collect()] == [0], "begun before the second version"
    assert numbers(spark, base) == [0, 10, 11]
    for n in (4, 5, 6):
        write_table(spark.range(n), base, "silver", "t")
    assert numbers(spark, base) == list(range(6))
    assert len(list((tmp_path / "silver" / "t").glob("v-*"))) == versions.KEEP
    assert sorted(p.name for p in (tmp_path / "silver" / "t" / "_versions").glob("[0-9]*")) == ["000000003.json", "000000004.json"]


def test_a_version_is_published_once(spark, tmp_path):
    files = versions._Files(spark, str(tmp_path))
    (tmp_path / "x").mkdir()
    files.write_whole(f"{tmp_path}/x/0.json", "first")
    with pytest.raises(RuntimeError, match="someone else"):
        files.write_whole(f"{tmp_path}/x/0.json", "second")
    assert files.read(f"{tmp_path}/x/0.json") == "first"
    assert [n for n in files.names(f"{tmp_path}/x") if not n.endswith(".crc")] == ["0.json"]


def test_schemas_and_empty_tables(spark, tmp_path):
    base = str(tmp_path)
    df = spark.sql("SELECT 'ü' AS a, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS event_ts, 1.5D AS `odd name`")
    write_table(df.limit(0), base, "silver", "t")
    assert read_table(spark, base, "silver", "t").dtypes == df.dtypes
    assert read_table(spark, base, "silver", "t").collect() == []
    write_events(df, base, "silver", "e")
    assert read_table(spark, base, "silver", "e").columns == [*df.columns, "event_date"]
    write_events(df.limit(0), base, "silver", "e")
    assert read_table(spark, base, "silver", "e").collect() == []
    assert stored_counts(spark, base, "silver", ["t", "e", "none"]) == {"t": 0, "e": 0}


def test_one_write_feeds_silver_and_rejects(spark, tmp_path):
    base = str(tmp_path)
    bronze = raw(spark, "payments", payment("p1", "2024-01-01 00:00:00", "failed"), payment("p2", "bad", "failed"), payment(None, None, "x"))
    write_checked(silver.checked("payments", bronze), base, "payments", "silver")
    kept = read_table(spark, base, "silver", "payments")
    assert kept.columns == RAW_SCHEMAS["payments"].names
    assert [tuple(r) for r in kept.collect()] == [tuple(r) for r in silver.silver_payments(bronze).collect()]
    left = read_table(spark, base, "rejects", "payments")
    assert {(r.reason, r.raw.payment_id, r.raw.payment_ts) for r in left.collect()} == {
        ("payment_ts unreadable", "p2", "bad"), ("payment_id missing", None, None),
    }
    assert stored_counts(spark, base, "silver", ["payments"]) == {"payments": 1}
    assert stored_counts(spark, base, "rejects", ["payments"]) == {"payments": 2}
    for _ in range(3):
        write_checked(silver.checked("payments", bronze), base, "payments", "silver")
    assert read_table(spark, base, "silver", "payments").count() == 1
    assert len(list((tmp_path / "checked" / "payments").glob("v-*"))) == versions.KEEP


def test_the_first_broken_rule_is_the_reason(spark):
    def reasons(name, *rows):
        return [r.reason for r in silver.checked(name, raw(spark, name, *rows)).collect()]

    assert reasons(
        "content_events", event(), event(user=None, at="bad"), event(at=None), event(at="bad", seconds=0), event(seconds=None),
        event(seconds="many"), event(seconds=0), event(content=None),
    ) == [
        None, "user_id missing", "event_ts missing", "event_ts unreadable", "watch_seconds missing",
        "watch_seconds unreadable", "watch_seconds not positive", None,
    ]
    assert reasons("users", user(None), user("u"), user("u", signup_ts=None)) == ["user_id missing", None, "signup_ts missing"]
    assert reasons("subscriptions", subscription(start="bad"), subscription(user=None)) == [None, "user_id missing"]
    assert reasons("plans", {}) == [None]


@pytest.mark.parametrize("name", TABLES)
def test_checked_rows_without_a_reason_are_silver(spark, name):
    rows = {
        "users": [user("u"), user(None), user("v", signup_ts="bad")],
        "content_events": [event(), event(seconds=0), event(at="x")],
    }.get(name, [{}])
    bronze = raw(spark, name, *rows)
    checked = silver.checked(name, bronze)
    kept = checked.filter("reason IS NULL").drop("reason", "raw")
    assert kept.schema == silver.typed(name, bronze).schema
    assert kept.collect() == silver.typed(name, bronze).collect()
    assert checked.count() == len(rows)


def test_layers_are_counted_without_reading_them(spark, extracts, tmp_path):  # noqa: F811
    base = str(tmp_path / "lake")
    medallion.build_all(spark, extracts, base, as_of="2024-02-15")
    counts = medallion.count_layers(spark, base)
    assert "FileScan" not in counts._jdf.queryExecution().executedPlan().toString()
    for layer in ("bronze", "silver", "gold"):
        for r in counts.filter(F.col("layer") == layer).collect():
            assert read_table(spark, base, layer, r.table).count() == r.n, (layer, r.table)
    rows = {r.table: r for r in medallion.account_layers(spark, base).collect()}
    assert set(rows) == set(TABLES) and all(r.balanced for r in rows.values())
    events = rows["content_events"]
    assert (events.bronze_rows, events.silver_rows, events.rejected_rows, events.duplicate_rows) == (5, 2, 2, 1)
    assert (rows["users"].rejected_rows, rows["users"].silver_rows) == (1, 2)
    assert {r.reason for r in medallion.rejected_rows(spark, base)["content_events"].collect()} == {"event_ts unreadable", "watch_seconds not positive"}
    accounted = medallion.check_layers(spark, base).filter("check = 'accounted'").collect()
    assert len(accounted) == len(TABLES) and all(r.passed for r in accounted)
    # a silver table that lost a row is noticed
    write_table(read_table(spark, base, "silver", "users").limit(1), base, "silver", "users")
    lost = medallion.check_layers(spark, base).filter("check = 'accounted' AND NOT passed").collect()
    assert [(r.table, r.failing_rows) for r in lost] == [("bronze_users", 1)]


def test_a_run_goes_on_after_a_failure_in_the_middle(spark, extracts, tmp_path, monkeypatch):  # noqa: F811
    base = str(tmp_path / "lake")
    medallion.build_all(spark, extracts, base, as_of="2024-02-15")
    before = medallion.count_layers(spark, base).collect()

    def fail(*args):
        raise ValueError("disk full")

    monkeypatch.setattr(medallion, "write_checked", fail)
    with pytest.raises(ValueError, match="disk full"):
        medallion.build_all(spark, extracts, base, as_of="2024-02-15")
    monkeypatch.undo()
    assert medallion.count_layers(spark, base).collect() == before
    medallion.build_all(spark, "/nowhere", base, as_of="2024-02-15", start="gold")
    assert medallion.count_layers(spark, base).collect() == before


def test_broken_arrays_are_noticed_in_the_one_read(spark, extracts, tmp_path):  # noqa: F811
    from pathlib import Path
    import json

    base, path = str(tmp_path / "lake"), Path(extracts) / "content_events.json"
    medallion.build_bronze(spark, extracts, base, "2024-02-15 06:00:00")
    before = read_table(spark, base, "bronze", "content_events").collect()
    rows = [event(f"u{i}") for i in range(4)]
    compact, indented = json.dumps(rows, separators=(",", ":")), json.dumps(rows, indent=1)
    for broken in (compact[:-1], compact.replace("},", "}", 1), indented.replace("},", "}", 1), "[" + compact):
        path.write_text(broken)
        with pytest.raises(Exception, match="without an end|commas between|MALFORMED"):
            medallion.build_bronze(spark, extracts, base, "2024-02-15 06:00:00")
        assert read_table(spark, base, "bronze", "content_events").collect() == before
    for whole in (compact, indented, "[]", " [\n]\n", "\n".join(map(json.dumps, rows))):
        path.write_text(whole)
        medallion.build_bronze(spark, extracts, base, "2024-02-15 06:00:00")
        assert read_table(spark, base, "bronze", "content_events").count() == (4 if "{" in whole else 0)
    path.unlink()
    path.mkdir()
    (path / "a.json").write_text(compact)
    (path / "b.json").write_text("[]")
    (path / "c.json").write_text(indented)
    medallion.build_bronze(spark, extracts, base, "2024-02-15 06:00:00")
    assert read_table(spark, base, "bronze", "content_events").count() == 8
    (path / "d.json").write_text("\n".join(map(json.dumps, rows)))
    medallion.build_bronze(spark, extracts, base, "2024-02-15 06:00:00")
    assert read_table(spark, base, "bronze", "content_events").count() == 12
    (path / "c.json").write_text(indented[:-2])
    with pytest.raises(ValueError, match="3 begin and 2 end"):
        medallion.build_bronze(spark, extracts, base, "2024-02-15 06:00:00")
