"""A local session for tests and measurements; clusters bring their own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", name: str = "subtide", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "7g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
