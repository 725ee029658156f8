"""Writers: layer tables as Parquet, in versions, and exports as CSV. Both replace what is
there; a table is replaced in one step once all of it has been written."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.sources.versions import Part, Version, catalog_name, current_version, new_folder, partitions_of, publish, read_version

EVENT_DATE = "event_date"
REJECTS = "rejects"
#: Parts that a table may be made of before it is written as one.
MOST_PARTS = 16


def run_together(writes: Iterable[Callable[[], None]]) -> None:
    """Start independent writes at once, so small tables fill the gaps of large ones."""
    with ThreadPoolExecutor() as pool:
        for done in [pool.submit(write) for write in writes]:
            done.result()


def _write_files(df: DataFrame, base: str, path: str, counts: Mapping[str, Column], *by: str) -> dict[str, int]:
    """Writes Parquet files and returns the counts, taken from the rows as they pass."""
    seen = Observation()
    watched = df.observe(seen, *[count.alias(name) for name, count in counts.items()])
    watched.write.partitionBy(*by).parquet(f"{base.rstrip('/')}/{path}")
    return {name: seen.get.get(name, 0) for name in counts}


def _stored(schema: T.StructType, *names: str) -> T.StructType:
    """The schema, or some of its columns, as Parquet gives it back."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema if not names or f.name in names])


def _only(df: DataFrame, columns: Sequence[str] | None) -> tuple[str, ...] | None:
    return tuple(columns) if columns and list(columns) != df.columns else None


def write_table(
    df: DataFrame, base: str, layer: str, name: str, *by: str,
    columns: Sequence[str] | None = None, check: Callable[[], None] | None = None,
) -> None:
    """The table anew; of the columns written it shows those listed, or all. ``check`` runs
    once the files are there; if it raises, the table stays as it was."""
    path = new_folder(layer, name)
    counts = _write_files(df, base, path, {"rows": F.count(F.lit(1))}, *by)
    if check is not None:
        check()
    publish(df.sparkSession, base, layer, name, Version((Part(path),), counts["rows"], _stored(df.schema), columns=_only(df, columns)))


def write_buckets(df: DataFrame, base: str, layer: str, name: str, key: str, buckets: int, origin: Sequence[str] = ()) -> None:
    """The table anew, its rows dealt by the hash of ``key`` to so many files, each written by
    one task. Tables with equal buckets are joined and grouped by the key without a shuffle;
    nothing can split a bucket, so a key should have few rows."""
    spark, path, table = df.sparkSession, new_folder(layer, name), catalog_name()
    seen = Observation()
    dealt = df.repartition(buckets, key).observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{base.rstrip('/')}/{path}").saveAsTable(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay
    version = Version((Part(path),), seen.get.get("rows", 0), _stored(df.schema), buckets=(key, buckets), origin=tuple(origin))
    publish(spark, base, layer, name, version)


def append_table(df: DataFrame, base: str, layer: str, name: str) -> None:
    """Adds the rows to a table; its files stay."""
    spark = df.sparkSession
    old = current_version(spark, base, layer, name)
    path = new_folder(layer, name)
    counts = _write_files(df.select(*old.schema.names), base, path, {"rows": F.count(F.lit(1))})
    publish(spark, base, layer, name, replace(old, parts=(*old.parts, Part(path)), rows=old.rows + counts["rows"]))


def replace_partitions(df: DataFrame, base: str, layer: str, name: str, by: str, values: Collection[str]) -> None:
    """Replaces the partitions of the given values, as they are in folders' names, by the
    rows of ``df``, which must have no others. Partitions that get no rows go. Once many
    writes have left parts in the table, it is written as one again."""
    spark = df.sparkSession
    old = current_version(spark, base, layer, name)
    gone = {f"{by}={value}" for value in values}
    path = new_folder(layer, name)
    counts = _write_files(df.select(*old.schema.names), base, path, {"rows": F.count(F.lit(1))}, by)
    found = partitions_of(spark, base, path)
    if not set(found) <= gone:
        raise ValueError(f"rows of other partitions: {sorted(set(found) - gone)[:5]}")
    kept = [
        Part(p.path, tuple(d for d in (partitions_of(spark, base, p.path) if p.partitions is None else p.partitions) if d not in gone))
        for p in old.parts
    ]
    parts = tuple(p for p in (*kept, Part(path, found)) if p.partitions)
    # counts come from the files' footers
    rows = read_version(spark, base, replace(old, parts=tuple(p for p in kept if p.partitions))).count()
    version = replace(old, parts=parts, rows=rows + counts["rows"])
    if len(parts) > MOST_PARTS:
        whole = read_version(spark, base, replace(version, columns=None))
        write_table(whole.hint("rebalance", by), base, layer, name, by, columns=version.columns)
    else:
        publish(spark, base, layer, name, version)


def _views(df: DataFrame, parts: tuple[Part, ...], kept: int, rejected: int) -> tuple[Version, Version]:
    """Checked rows without a reason, and those with one."""
    columns = tuple(c for c in df.columns if c not in ("reason", "raw"))
    return (
        Version(parts, kept, _stored(df.schema, *columns, "reason"), "reason IS NULL", columns),
        Version(parts, rejected, _stored(df.schema, "reason", "raw"), "reason IS NOT NULL"),
    )


def write_checked(df: DataFrame, base: str, name: str, layer: str, append: bool = False) -> None:
    """One write for two tables: rows of ``df`` without a ``reason`` become the table of
    ``layer``, or are added to it, the others the rejects. Both are views of the files in
    the layer ``checked``."""
    spark = df.sparkSession
    path = new_folder("checked", name)
    seen = _write_files(df, base, path, {
        "kept": F.count_if(F.col("reason").isNull()), "rejected": F.count_if(F.col("reason").isNotNull()),
    })
    old = {part: current_version(spark, base, part, name) if append else None for part in (layer, REJECTS, "checked")}
    parts = (*(old["checked"].parts if append else ()), Part(path))
    kept = seen["kept"] + (old[layer].rows if append else 0)
    rejected = seen["rejected"] + (old[REJECTS].rows if append else 0)
    views = _views(df, parts, kept, rejected)
    # the files belong to the table published last: older ones go with it
    publish(spark, base, layer, name, views[0])
    publish(spark, base, REJECTS, name, views[1])
    publish(spark, base, "checked", name, Version(parts, kept + rejected, _stored(df.schema)))


def dated(events: DataFrame) -> DataFrame:
    """Events with their day, gathered so that a write task opens few files; adaptive
    execution splits a day that is larger than the advisory size."""
    return events.withColumn(EVENT_DATE, F.to_date("event_ts")).hint("rebalance", EVENT_DATE)


def write_events(df: DataFrame, base: str, layer: str, name: str = "content_events") -> None:
    """Events in one folder per day."""
    write_table(dated(df), base, layer, name, EVENT_DATE)


def write_csv(df: DataFrame, path: str) -> None:
    """Values as they are: spaces stay, quotes are doubled, timestamps have a fraction only
    where there is one. NULL is an empty field, an empty text a quoted one."""
    plain = [
        F.col(f"`{name}`").cast("string").alias(name) if kind == "timestamp_ntz" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ]
    df.select(*plain).write.mode("overwrite").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def export_csv(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Each table as a folder of CSV part files with a header, written by the executors."""
    folder = folder.rstrip("/")
    run_together(partial(write_csv, df, f"{folder}/{name}.csv") for name, df in tables.items())
