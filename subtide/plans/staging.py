"""Staging: the silver tables under the column names the marts use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from subtide.schemas import RAW_SCHEMAS, TABLES

USER_RENAMES = {"acquisition_channel": "channel", "device_preference": "device"}


def stage(name: str, silver: DataFrame) -> DataFrame:
    staged = silver.select(*RAW_SCHEMAS[name].names)
    return staged.withColumnsRenamed(USER_RENAMES) if name == "users" else staged


def staging_tables(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage(name, silver[name]) for name in TABLES}


def create_staging_views(silver: Mapping[str, DataFrame]) -> None:
    """Register ``stg_<table>`` as temporary views for SQL users."""
    for name, df in staging_tables(silver).items():
        df.createOrReplaceTempView(f"stg_{name}")
