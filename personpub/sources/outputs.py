"""Statistics rows, properties, snapshots and marks."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.session import is_missing

MARK = "mark string, saved long"


def append_statistics(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").parquet(path)


def write_properties(df: DataFrame, path: str) -> None:
    """One directory per property type, so that a search by type reads only its own."""
    df.hint("rebalance", F.col("type")).write.mode("overwrite").partitionBy("type").parquet(path)


def snapshot(df: DataFrame, root: str, name: str, run: datetime) -> str:
    """A dated copy; a second one of the same second is refused."""
    path = f"{root}/{name}/run={run:%Y%m%d_%H%M%S}"
    df.write.mode("error").parquet(path)
    return path


def restore(spark: SparkSession, root: str, name: str, run: datetime) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}/run={run:%Y%m%d_%H%M%S}")


def load_mark(spark: SparkSession, path: str) -> str | None:
    try:
        marks = spark.read.schema(MARK).parquet(path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None
    rows = marks.orderBy(F.col("saved").desc()).limit(1).collect()
    return rows[0]["mark"] if rows else None


def save_mark(spark: SparkSession, path: str, mark: str) -> None:
    """Add a mark; the one saved last is in force. Call it after the work is done."""
    try:
        marks = spark.read.schema(MARK).parquet(path)
        saved = (marks.agg(F.max("saved")).collect()[0][0] or 0) + 1
    except AnalysisException as error:
        if not is_missing(error):
            raise
        saved = 1
    row = spark.range(1, numPartitions=1).select(
        F.lit(mark).alias("mark"), F.lit(saved).cast("long").alias("saved")
    )
    row.write.mode("append").parquet(path)
