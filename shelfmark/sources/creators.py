"""Creator name lookup kept as a Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "creator_id bigint, name string"


def load_creators(spark: SparkSession, path: str) -> DataFrame:
    """One name per creator, from a table that is only appended to; the first entry stays."""
    return (
        spark.read.schema(f"{SCHEMA}, batch bigint")
        .option("recursiveFileLookup", True)
        .parquet(path)
        .groupBy("creator_id")
        .agg(F.min_by("name", F.struct("batch", "name")).alias("name"))
    )


def append_creators(new: DataFrame, path: str, batch: int) -> None:
    """Append names under a batch number, so that a rerun replaces its own part only."""
    (
        new.select(F.col("creator_id").cast("bigint"), "name", F.lit(batch).cast("bigint").alias("batch"))
        .write.mode("overwrite")
        .parquet(f"{path.rstrip('/')}/part_{batch}")
    )
