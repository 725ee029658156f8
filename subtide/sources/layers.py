"""Tables of one layer under a base path, and their existence."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from subtide.sources.versions import current_version, read_version, table_path


def read_table(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """The table's version of this moment; later writes do not change what is read."""
    version = current_version(spark, base, layer, name)
    if version is None:
        raise LookupError(f"no table has been written to {table_path(base, layer, name)}")
    return read_version(spark, base, version)


def read_layer(spark: SparkSession, base: str, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, base, layer, name) for name in names}


def existing_tables(spark: SparkSession, base: str, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The tables of a layer that have been written."""
    versions = {name: current_version(spark, base, layer, name) for name in names}
    return {name: read_version(spark, base, version) for name, version in versions.items() if version}


def stored_counts(spark: SparkSession, base: str, layer: str, names: Iterable[str]) -> dict[str, int]:
    """The number of rows of each written table, as counted while it was written."""
    versions = {name: current_version(spark, base, layer, name) for name in names}
    return {name: version.rows for name, version in versions.items() if version}
