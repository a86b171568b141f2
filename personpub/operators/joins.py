"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join many rows to a table with one row per key.

    Both sides get a second key, so that whatever made them both are dealt anew for this
    join; only then can the rows of any frequent key be split at run time. It is one lazy
    plan: nothing is counted before. Keys that a collation takes for equal have different
    hashes, so such a key is joined on alone.
    """
    kind = rows.schema[key].dataType
    if isinstance(kind, T.StringType) and kind.collation != "UTF8_BINARY":
        return rows.join(table, key, how)
    right = table.withColumn("_k", F.xxhash64(key))
    return rows.withColumn("_k", F.xxhash64(key)).join(right, [key, "_k"], how).drop("_k")
