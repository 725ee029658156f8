"""The whole flow: raw extracts to bronze, silver and gold tables, and CSV exports.

Each layer is written before the next reads it, so no plan grows over more than one
layer, and after a failure ``build_all(start=...)`` goes on from the layers that exist. A
table is replaced in one step once its new files are whole (``sources.versions``); until
then, and if the write fails, readers get the version before.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from subtide.plans import marts, rollups
from subtide.plans.marts import mart_tables
from subtide.plans.quality import accounted_rows, dq_checks, key_copies, row_accounting
from subtide.plans.silver import checked, longest_watch
from subtide.plans.staging import create_staging_views, staging_tables
from subtide.schemas import EVENT_KEY, MARTS, RAW_SCHEMAS, TABLES
from subtide.sinks.writers import (
    EVENT_DATE,
    REJECTS,
    append_table,
    dated,
    export_csv,
    replace_partitions,
    run_together,
    write_buckets,
    write_checked,
    write_events,
    write_table,
)
from subtide.sources.layers import existing_tables, read_layer, read_table, stored_counts
from subtide.sources.raw_files import bronze_tables, require_whole_arrays
from subtide.sources.versions import Part, current_version, read_version, remove_unpublished

LAYERS = {"bronze": TABLES, "silver": TABLES, "gold": MARTS}
#: Valid events before deduplication; every other silver table is valid rows alone.
VALID = "valid"
ROLLUPS = "rollups"
FAILED, OWNERS = "failed_by_subscription", "subscription_owners"
#: Subscriptions of a bucket; some 40 bytes each in either rollup.
BUCKET_ROWS = 4_000_000


def build_bronze(
    spark: SparkSession, raw: str, base: str, ingested_at: str | dt.datetime | None = None,
    multiline: bool = False, layout: str = "array",
) -> None:
    """The raw extracts are read once, JSON arrays too: whether all are whole is seen while
    they are written, and a table of broken ones is not published."""
    watch = Observation() if layout == "array" else None
    bronze = bronze_tables(spark, raw, ingested_at, multiline, layout, watch)
    files = len(bronze["content_events"].inputFiles())

    def whole() -> None:
        require_whole_arrays(watch.get, files)

    run_together(
        partial(write_table, df, base, "bronze", name, check=whole if watch and name == "content_events" else None)
        for name, df in bronze.items()
    )


def build_silver(spark: SparkSession, base: str) -> None:
    """Every bronze table is read once, into silver and rejects. Events lie in between as
    valid ones, which are then deduplicated."""
    bronze = read_layer(spark, base, "bronze", TABLES)
    run_together(
        partial(write_checked, checked(name, df), base, name, VALID if name == "content_events" else "silver")
        for name, df in bronze.items()
    )
    write_events(longest_watch(read_table(spark, base, VALID, "content_events")), base, "silver")


def rejected_rows(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """For each table, (reason, raw) of the bronze rows that broke a rule of silver."""
    return read_layer(spark, base, REJECTS, TABLES)


def silver_layer(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The written silver tables without the folder column of the events."""
    return {
        name: df.select(*RAW_SCHEMAS[name].names)
        for name, df in read_layer(spark, base, "silver", TABLES).items()
    }


def _by_month(retention: DataFrame) -> DataFrame:
    """Retention with its partitions' column."""
    return retention.withColumn("month", F.to_date("activity_month")).hint("rebalance", "month")


def build_gold(spark: SparkSession, base: str, as_of: str | dt.date | None = None) -> None:
    built = mart_tables(staging_tables(silver_layer(spark, base)), as_of, stored_failures(spark, base))
    retention = built.pop("mart_retention")
    run_together([
        partial(write_table, _by_month(retention), base, "gold", "mart_retention", "month", columns=retention.columns),
        *(partial(write_table, df, base, "gold", name) for name, df in built.items()),
    ])


def add_events(spark: SparkSession, base: str, bronze_events: DataFrame, as_of: str | dt.date | None = None) -> list[dt.date]:
    """Adds bronze rows of viewing events to all layers, and returns the days they touch.

    Only these days of silver, and their months and weeks of gold, are written again, so the
    work follows the days that changed and not the history; the result is that of a full
    rebuild. Days may be long past. The churn mart, which weighs each user's last event, is
    the one table computed anew.

    Run again after a failure it may add the rows to bronze, valid and rejects once more;
    silver and gold then stay right, as copies of an event are one event there.
    """
    # read from the files from here on, so that every step sees the same rows
    before = {part.path for part in _parts(spark, base, "bronze")}
    append_table(bronze_events, base, "bronze", "content_events")
    added = _new_part(spark, base, "bronze", before)
    before = {part.path for part in _parts(spark, base, "checked")}
    write_checked(checked("content_events", added), base, "content_events", VALID, append=True)
    fresh = _new_part(spark, base, "checked", before).filter(F.col("reason").isNull()).select(*RAW_SCHEMAS["content_events"].names)
    days = sorted(r.day for r in fresh.select(F.to_date("event_ts").alias("day")).distinct().collect())  # bounded by the calendar
    if not days:
        return days

    silver = read_table(spark, base, "silver", "content_events")
    touched = silver.filter(F.col(EVENT_DATE).isin(days)).drop(EVENT_DATE)
    # keeping the first of each key again changes nothing for rows that were kept before
    again = longest_watch(touched.unionByName(fresh))
    replace_partitions(dated(again), base, "silver", "content_events", EVENT_DATE, [str(day) for day in days])

    tables = staging_tables(silver_layer(spark, base))
    dated_events = read_table(spark, base, "silver", "content_events")
    months = sorted({day.replace(day=1) for day in days})
    mondays = sorted({day - dt.timedelta(days=day.weekday()) for day in days})
    day = F.col(EVENT_DATE)
    retention = marts.mart_retention(
        dated_events.filter(F.trunc(day, "month").isin(months) & day.between(months[0], _month_after(months[-1]))),
        tables["subscriptions"], tables["plans"],
    )
    weekly = marts.mart_weekly_metrics(
        dated_events.filter(F.trunc(day, "week").isin(mondays) & day.between(mondays[0], mondays[-1] + dt.timedelta(days=6))),
        tables["subscriptions"],
    )
    other_weeks = read_table(spark, base, "gold", "mart_weekly_metrics").filter(~F.to_date("week_start").isin(mondays))
    churn = mart_tables(tables, as_of, stored_failures(spark, base))["mart_churn_risk"]
    run_together([
        partial(replace_partitions, _by_month(retention), base, "gold", "mart_retention", "month", [str(m) for m in months]),
        partial(write_table, weekly.unionByName(other_weeks).orderBy("week_start"), base, "gold", "mart_weekly_metrics"),
        partial(write_table, churn, base, "gold", "mart_churn_risk"),
    ])
    if current_version(spark, base, ROLLUPS, "week_users"):
        build_rollups(spark, base, mondays)
    return days


def _month_after(month: dt.date) -> dt.date:
    return (month + dt.timedelta(days=32)).replace(day=1)


def _parts(spark: SparkSession, base: str, layer: str) -> tuple[Part, ...]:
    return current_version(spark, base, layer, "content_events").parts


def _new_part(spark: SparkSession, base: str, layer: str, before: set[str]) -> DataFrame:
    """The rows of the one part of the events that was not there before."""
    version = current_version(spark, base, layer, "content_events")
    return read_version(spark, base, replace(version, parts=tuple(p for p in version.parts if p.path not in before)))


def build_rollups(spark: SparkSession, base: str, weeks: list[dt.date] | None = None) -> None:
    """Users' numbers and weekly bitmaps (``plans.rollups``) from the silver events. With
    ``weeks``, their Mondays, only these are made again, and new users numbered after the
    others."""
    events = read_table(spark, base, "silver", "content_events")
    if weeks is None:
        write_table(rollups.user_numbers(events), base, ROLLUPS, "user_numbers")
    else:
        events = events.filter(F.trunc(EVENT_DATE, "week").isin(weeks) & F.col(EVENT_DATE).between(weeks[0], weeks[-1] + dt.timedelta(days=6)))
        known = current_version(spark, base, ROLLUPS, "user_numbers").rows
        numbers = read_table(spark, base, ROLLUPS, "user_numbers")
        append_table(rollups.new_user_numbers(events, numbers, known + 1), base, ROLLUPS, "user_numbers")
    users = rollups.week_users(events, read_table(spark, base, ROLLUPS, "user_numbers"))
    by_week = users.withColumn("week", F.to_date("week_start")).hint("rebalance", "week")
    if weeks is None:
        write_table(by_week, base, ROLLUPS, "week_users", "week", columns=users.columns)
    else:
        replace_partitions(by_week, base, ROLLUPS, "week_users", "week", [str(week) for week in weeks])


def count_active_users(spark: SparkSession, base: str, span: int = rollups.SPAN_WEEKS) -> DataFrame:
    """Users of each week and of the weeks up to it (``rollups.active_users``), from the
    bitmaps: no event is read."""
    return rollups.active_users(read_table(spark, base, ROLLUPS, "week_users"), span)


def _origin(spark: SparkSession, base: str) -> tuple[str, ...]:
    """The files that payments and subscriptions consist of now."""
    versions = [current_version(spark, base, "silver", name) for name in ("payments", "subscriptions")]
    return tuple(part.path for version in versions if version for part in version.parts)


def build_failed_counts(spark: SparkSession, base: str) -> None:
    """Failed payments of each subscription and its owners, both in buckets by subscription.
    However many payments a subscription has, it is one row, so no bucket is hot. Their
    number follows the subscriptions, as counted when they were written."""
    origin = _origin(spark, base)
    subscriptions = current_version(spark, base, "silver", "subscriptions").rows
    buckets = max(1, -(-subscriptions // BUCKET_ROWS))
    tables = staging_tables(silver_layer(spark, base))
    made = {
        FAILED: marts.failed_by_subscription(tables["payments"].filter(F.col("subscription_id").isNotNull())),
        OWNERS: rollups.subscription_owners(tables["subscriptions"]),
    }
    run_together(
        partial(write_buckets, df, base, ROLLUPS, name, "subscription_id", buckets, origin) for name, df in made.items()
    )


def stored_failures(spark: SparkSession, base: str) -> DataFrame | None:
    """(user_id, failed) from the rollups: no payment is read, and nothing shuffled. None if
    they were not built, or payments or subscriptions were written again after them."""
    versions = {name: current_version(spark, base, ROLLUPS, name) for name in (FAILED, OWNERS)}
    origin = _origin(spark, base)
    if not all(version and version.origin == origin for version in versions.values()):
        return None
    return rollups.failed_of_owners(*(read_version(spark, base, versions[name]) for name in (FAILED, OWNERS)))


def export_layers(spark: SparkSession, base: str, folder: str) -> None:
    folder = folder.rstrip("/")
    silver = silver_layer(spark, base)
    export_csv({f"silver_{name}": df for name, df in silver.items()}, f"{folder}/silver_export")
    gold = read_layer(spark, base, "gold", MARTS)
    gold["mart_weekly_metrics"] = gold["mart_weekly_metrics"].orderBy("week_start")
    export_csv(gold, f"{folder}/gold_export")


def written_tables(spark: SparkSession, base: str) -> dict[str, dict[str, DataFrame]]:
    return {layer: existing_tables(spark, base, layer, names) for layer, names in LAYERS.items()}


def count_layers(spark: SparkSession, base: str) -> DataFrame:
    """Rows of every written table, as they were counted while it was written: no table is
    read."""
    rows = [
        (layer, name, n) for layer, names in LAYERS.items()
        for name, n in stored_counts(spark, base, layer, names).items()
    ]
    return spark.createDataFrame(rows, "layer string, table string, n bigint")


def account_layers(spark: SparkSession, base: str) -> DataFrame:
    """Where the rows of each bronze table went (see ``quality.row_accounting``). Only the
    valid events are read, to count the copies of each."""
    counted = [("bronze", "bronze"), ("silver", "silver"), (REJECTS, "rejected")]
    rows = [(role, name, n) for layer, role in counted for name, n in stored_counts(spark, base, layer, TABLES).items()]
    copies = key_copies(read_table(spark, base, VALID, "content_events"), EVENT_KEY)
    duplicates = copies.select(F.lit("duplicate").alias("role"), F.lit("content_events").alias("table"), "n")
    return row_accounting(spark.createDataFrame(rows, "role string, table string, n bigint").unionByName(duplicates))


def check_layers(spark: SparkSession, base: str) -> DataFrame:
    written = {layer: existing_tables(spark, base, layer, names) for layer, names in LAYERS.items()}
    named = {
        name if layer == "gold" else f"{layer}_{name}": df
        for layer, tables in written.items()
        for name, df in tables.items()
    }
    checks = dq_checks(named)
    return checks.unionByName(accounted_rows(account_layers(spark, base))) if written["silver"] else checks


def remove_unfinished(spark: SparkSession, base: str, older_than_hours: float = 24) -> list[str]:
    """Deletes what writes that failed have left, and returns the folders."""
    layers = {**LAYERS, VALID: ("content_events",), REJECTS: TABLES, "checked": TABLES, ROLLUPS: ("user_numbers", "week_users", FAILED, OWNERS)}
    return [
        folder for layer, names in layers.items() for name in names
        for folder in remove_unpublished(spark, base, layer, name, older_than_hours)
    ]


def build_all(
    spark: SparkSession,
    raw: str,
    base: str,
    as_of: str | dt.date | None = None,
    ingested_at: str | dt.datetime | None = None,
    exports: str | None = None,
    start: str = "bronze",
    multiline: bool = False,
    layout: str = "array",
) -> None:
    """Builds from the layer ``start`` on; those before it must have been written.
    ``multiline`` (CSV) and ``layout`` (JSON) are the readers' options."""
    steps = list(LAYERS)[list(LAYERS).index(start):]
    if "bronze" in steps:
        build_bronze(spark, raw, base, ingested_at, multiline, layout)
    if "silver" in steps:
        build_silver(spark, base)
    create_staging_views(silver_layer(spark, base))
    build_gold(spark, base, as_of)
    if exports is not None:
        export_layers(spark, base, exports)
