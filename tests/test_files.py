"""Raw file readers, layer tables, exports and the whole flow on hand-written files."""

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from subtide.plans import medallion
from subtide.plans.silver import silver_content_events, silver_payments
from subtide.schemas import MARTS, RAW_SCHEMAS, TABLES
from subtide.sinks.writers import export_csv
from subtide.sources.layers import read_table
from subtide.sources.raw_files import bronze_tables, read_csv, read_json_records, read_raw
from tests.helpers import case, event, payment, subscription, ts, user

EVENTS = RAW_SCHEMAS["content_events"]


def write_csv(path, name, rows, quote_all=False):
    names = RAW_SCHEMAS[name].names
    with open(path, "w", newline="") as f:
        writer = csv.writer(f, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL)
        writer.writerow(names)
        writer.writerows(["" if r.get(c) is None else r[c] for c in names] for r in rows)


@pytest.fixture
def extracts(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_csv(raw / "plans.csv", "plans", [
        {"plan_id": "plan_free", "plan_name": "Free", "billing_cycle": "trial", "list_price": "0.00"},
        {"plan_id": "plan_basic", "plan_name": "Basic", "billing_cycle": "monthly", "list_price": "9.99"},
    ])
    write_csv(raw / "users.csv", "users", [user("u1"), user("u2", signup_ts="bad"), user("u3")])
    write_csv(raw / "subscriptions.csv", "subscriptions", [
        subscription("t1", "u1", "plan_free", "2024-01-01 00:00:00", auto_renew_flag="False"),
        subscription("s1", "u1", "plan_basic", "2024-01-11 00:00:00", auto_renew_flag="True"),
        subscription("t3", "u3", "plan_free", "2024-01-01 00:00:00", status="cancelled"),
    ])
    write_csv(raw / "payments.csv", "payments", [
        payment("p1", "2024-01-11 00:00:00", "failed", failure_reason="card_expired"),
        payment("p2", "2024-01-13 00:00:00", "success"),
    ])
    write_csv(raw / "support_cases.csv", "support_cases", [case("k1"), case("k2", "u3")])
    events = [event(), event(), event("u3", kind=" Pause"), event("u1", "c2", "bad"), event("u1", "c3", seconds=0)]
    (raw / "content_events.json").write_text(json.dumps(events, indent=2))
    return str(raw)


def test_csv_empty_fields_are_null(spark, tmp_path):
    row = payment("p1", "2024-01-01 00:00:00", "failed")
    for quote_all in (False, True):
        write_csv(tmp_path / "payments.csv", "payments", [row], quote_all)
        df = read_raw(spark, str(tmp_path), "payments")
        assert df.schema == RAW_SCHEMAS["payments"]
        assert df.first().failure_reason is None
        assert silver_payments(df).first().failure_reason == "none"


def test_csv_doubled_quotes(spark, tmp_path):
    write_csv(tmp_path / "support_cases.csv", "support_cases", [case("k1", issue_type='say "hi", ok')])
    row = read_raw(spark, str(tmp_path), "support_cases").first()
    assert (row.issue_type, row.resolution_status) == ('say "hi", ok', "resolved")


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    write_csv(tmp_path / "support_cases.csv", "support_cases", [case("k1", issue_type="two\nlines")])
    assert read_raw(spark, str(tmp_path), "support_cases", multiline=True).first().issue_type == "two\nlines"


ROWS = [
    event(), event("u2", 'quoted "c2", [x]', seconds=7), event(None, kind=" Pause\n"),
    event("ü", category=None), {"user_id": "only"},
]


@pytest.mark.parametrize("text", [
    json.dumps(ROWS),
    json.dumps(ROWS, indent=2),
    json.dumps(ROWS, indent=2).replace("\n", "\r\n") + "\r\n",
    json.dumps(ROWS, separators=(",", ":"), ensure_ascii=False),
    "\ufeff" + json.dumps(ROWS),
    "\n".join(json.dumps(row) for row in ROWS),
    "\n".join(json.dumps(row) for row in ROWS) + "\n\n",
], ids=["line", "indented", "crlf", "compact", "bom", "per-line", "per-line-end"])
def test_json_layouts(spark, tmp_path, text):
    path = tmp_path / "e.json"
    path.write_bytes(text.encode())
    df = read_json_records(spark, str(path), EVENTS)
    expected = [tuple(None if row.get(c) is None else str(row[c]) for c in EVENTS.names) for row in ROWS]
    assert [tuple(r) for r in df.collect()] == expected
    assert df.columns == EVENTS.names


def test_json_empty_array(spark, tmp_path):
    (tmp_path / "e.json").write_text("[]\n")
    assert read_json_records(spark, str(tmp_path / "e.json"), EVENTS).count() == 0


def test_json_file_is_read_by_several_tasks(spark, tmp_path):
    rows = [event(f"user-{i}", f"content-{i % 7}", seconds=i) for i in range(5000)]
    (tmp_path / "e.json").write_text(json.dumps(rows))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        df = read_json_records(spark, str(tmp_path / "e.json"), EVENTS)
        assert df.rdd.getNumPartitions() > 8
        assert sorted(int(r.watch_seconds) for r in df.collect()) == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_json_opening_brace_in_text_fails_in_the_array_layout(spark, tmp_path):
    path = str(tmp_path / "e.json")
    (tmp_path / "e.json").write_text(json.dumps([event(content="a{b"), event(content="a}b")]))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_records(spark, path, EVENTS).collect()
    whole = read_json_records(spark, path, EVENTS, layout="whole")
    assert [r.content_id for r in whole.collect()] == ["a{b", "a}b"]
    (tmp_path / "l.json").write_text("\n".join(json.dumps(event(content=c)) for c in ("a{b", "a}b")))
    lines = read_json_records(spark, str(tmp_path / "l.json"), EVENTS, layout="lines")
    assert [r.content_id for r in lines.collect()] == ["a{b", "a}b"]


@pytest.mark.parametrize("cut", range(1, 40, 6))
def test_truncated_json_fails(spark, tmp_path, cut):
    whole = json.dumps([event(), event(seconds=120)])
    (tmp_path / "content_events.json").write_text(whole[: len(whole) - 1 - cut])
    with pytest.raises(Exception, match="MALFORMED_RECORD|without an end"):
        read_raw(spark, str(tmp_path), "content_events").collect()


def test_json_cut_between_records_fails(spark, tmp_path):
    (tmp_path / "content_events.json").write_text(json.dumps([event(), event()])[:-1])
    with pytest.raises(ValueError, match="without an end"):
        read_raw(spark, str(tmp_path), "content_events")


@pytest.mark.parametrize("line", ["k1,u1,2024-01-01,a,b,c", "k1,u1", "k1,u1,2024-01-01,'two\nlines\",b"])
def test_ragged_csv_fails(spark, tmp_path, line):
    text = ",".join(RAW_SCHEMAS["support_cases"].names) + "\n" + line.replace("'", '"') + "\n"
    (tmp_path / "support_cases.csv").write_text(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD|MALFORMED_CSV"):
        read_raw(spark, str(tmp_path), "support_cases").collect()


def test_exports_keep_values(spark, tmp_path):
    odd = [" usd ", 'say ""hi"", "ok"', "two\nlines", "a,b", None, "", "back\\slash"]
    rows = [(str(i), text) for i, text in enumerate(odd)]
    df = spark.createDataFrame(rows, "n string, x string").coalesce(1).selectExpr(
        "n", "x", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS whole", "TIMESTAMP_NTZ '2024-01-01 00:00:00.25' AS part"
    )
    export_csv({"t": df}, str(tmp_path))
    (file,) = (tmp_path / "t.csv").glob("part-*")
    with open(file, newline="") as f:
        header, *read = csv.reader(f)
    assert header == ["n", "x", "whole", "part"]
    assert [r[1] for r in read] == [x or "" for x in odd]
    assert {tuple(r[2:]) for r in read} == {("2024-01-01 00:00:00", "2024-01-01 00:00:00.25")}
    back = read_csv(spark, str(tmp_path / "t.csv"), df.select(*[F.col(c).cast("string") for c in df.columns]).schema, multiline=True)
    assert [r.x for r in back.orderBy("n").collect()] == [x or None for x in odd]


def test_reader_options_reach_the_flow(spark, extracts, tmp_path):
    raw = Path(extracts)
    write_csv(raw / "support_cases.csv", "support_cases", [case("k1", issue_type="two\nlines")])
    (raw / "content_events.json").write_text("\n".join(json.dumps(e) for e in (event(content="a{b"), event())))
    base = str(tmp_path / "lake")
    medallion.build_all(spark, extracts, base, as_of="2024-02-15", multiline=True, layout="lines")
    assert read_table(spark, base, "silver", "support_cases").first().issue_type == "two\nlines"
    assert {r.content_id for r in read_table(spark, base, "silver", "content_events").collect()} == {"a{b", "c1"}
    stamps = {read_table(spark, base, "bronze", t).first()._ingested_at for t in TABLES}
    assert len(stamps) == 1, "one run has one time"


def test_a_run_goes_on_from_a_layer(spark, extracts, tmp_path):
    base = str(tmp_path / "lake")
    medallion.build_all(spark, extracts, base, as_of="2024-02-15")
    before = read_table(spark, base, "gold", "mart_churn_risk").count()
    medallion.build_all(spark, "/nowhere", base, as_of="2024-02-15", start="silver")
    assert read_table(spark, base, "gold", "mart_churn_risk").count() == before


def test_overwrite_is_static(spark, tmp_path):
    from subtide.sinks.writers import write_events

    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for day in (1, 2):
            write_events(spark.sql(f"SELECT 'u' AS user_id, TIMESTAMP_NTZ '2024-01-0{day} 00:00:00' AS event_ts"), str(tmp_path), "silver")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.event_ts.day for r in read_table(spark, str(tmp_path), "silver", "content_events").collect()] == [2]


def test_bronze_keeps_rows_and_adds_lineage(spark, extracts):
    bronze = bronze_tables(spark, extracts, "2024-02-15 06:00:00")
    assert set(bronze) == set(TABLES)
    events = bronze["content_events"]
    assert events.count() == 5
    assert events.columns == [*EVENTS.names, "_ingested_at", "_source_file"]
    first = events.first()
    assert (first._ingested_at, first._source_file) == (ts("2024-02-15 06:00:00"), "content_events.json")
    assert bronze_tables(spark, extracts)["plans"].first()._ingested_at is not None
    assert silver_content_events(events).count() == 2


def test_whole_flow(spark, extracts, tmp_path):
    base, out = str(tmp_path / "lake"), str(tmp_path / "out")
    for _ in range(2):  # a rerun replaces every table
        medallion.build_all(spark, extracts, base, as_of="2024-02-15", exports=out)

    counts = {(r.layer, r.table): r.n for r in medallion.count_layers(spark, base).collect()}
    assert len(counts) == 2 * len(TABLES) + len(MARTS)
    assert counts["bronze", "content_events"] == 5
    assert counts["silver", "content_events"] == 2
    assert counts["silver", "users"] == counts["gold", "mart_churn_risk"] == 2
    assert counts["gold", "mart_trial_conversion"] == 2
    assert counts["gold", "mart_payment_failures"] == 1

    checks = medallion.check_layers(spark, base)
    assert checks.columns == ["check", "table", "column", "failing_rows", "passed"]
    assert checks.filter("NOT passed").collect() == []

    days = read_table(spark, base, "silver", "content_events")
    assert "event_date" in days.columns
    assert medallion.silver_layer(spark, base)["content_events"].columns == EVENTS.names

    exported = spark.read.csv(f"{out}/gold_export/mart_churn_risk.csv", header=True)
    assert {r.user_id: r.churn_risk_label for r in exported.collect()} == {"u1": "medium", "u3": "medium"}
    assert spark.read.csv(f"{out}/silver_export/silver_payments.csv", header=True).count() == 2


def test_missing_tables_fail_their_check(spark, extracts, tmp_path):
    base = str(tmp_path / "lake")
    medallion.build_bronze(spark, extracts, base)
    missing = medallion.check_layers(spark, base).filter("check = 'exists' AND NOT passed").collect()
    assert {r.table for r in missing} == {*(f"silver_{t}" for t in TABLES), *MARTS}


def test_export_keeps_column_order_and_null(spark, tmp_path):
    df = spark.sql("SELECT 'b' AS z, CAST(NULL AS STRING) AS a, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS t")
    export_csv({"x": df}, str(tmp_path))
    back = spark.read.csv(f"{tmp_path}/x.csv", header=True)
    assert back.columns == ["z", "a", "t"]
    assert back.first().a is None


def test_events_are_gathered_by_day(spark, tmp_path):
    """A day is one file although every input task holds rows of every day."""
    from subtide.sinks.writers import write_events

    df = spark.range(0, 400, 1, 8).selectExpr(
        "id AS user_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(id % 5 AS INT)) AS event_ts"
    )
    write_events(df, str(tmp_path), "silver")
    days = sorted((tmp_path / "silver" / "content_events").glob("v-*/event_date=*"))
    assert [day.name for day in days] == [f"event_date=2024-01-0{d}" for d in range(1, 6)]
    assert all(len(list(day.glob("*.parquet"))) == 1 for day in days)
    scan = read_table(spark, str(tmp_path), "silver", "content_events").filter("event_date = DATE '2024-01-03'")
    assert scan.count() == 80
    assert "PartitionFilters: [isnotnull(event_date" in scan._jdf.queryExecution().executedPlan().toString()


def test_failed_write_is_reported(spark, tmp_path):
    from subtide.sinks.writers import run_together

    def fail():
        raise ValueError("disk full")

    written = []
    with pytest.raises(ValueError, match="disk full"):
        run_together([fail, lambda: written.append(1)])
    assert written == [1]
