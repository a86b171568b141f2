"""Column helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays. Null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no classifier learns from. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def drawn(key: Column, rows: int, total: int) -> Column:
    """True for about `rows` of `total` different keys (longs or texts), by their hash alone.

    The share is a bound of the 64-bit hash, so that it holds for any total.
    """
    if total <= rows:
        return F.lit(True)
    return F.xxhash64(key) < F.lit((1 << 64) * rows // total - (1 << 63))


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names; whatever else the table carries is left behind."""
    return df.select(*[F.col(f"`{name}`").alias(to) for to, name in columns.items()])


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of so few rows that very long texts fit a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
