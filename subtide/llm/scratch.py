"""Tables kept between the jobs of one operator, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="subtide-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def store(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Writes df once, in folders ``by`` columns if any, and reads it back: later jobs neither recompute it nor depend on
    an executor that held it. Who runs the job clears the folder when its result has been
    used; results are read from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    """The session's number of shuffle partitions."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def free_name(df: DataFrame, wanted: str) -> str:
    """The name, or one like it, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
