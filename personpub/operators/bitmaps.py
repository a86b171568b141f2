"""Conjunctions of property values, as bitmaps over dense entity numbers."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.operators.ranks import with_rank

#: bytes of a bitmap of Spark's bitmap functions
SIZE = 4096


class PropertyTable(NamedTuple):
    """Stored property values by type and entity number, and the entities' keys by number."""

    spark: SparkSession
    path: str

    def keys(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/keys")

    def values(self) -> DataFrame:
        return self.spark.read.schema("no long, value string, type string").parquet(f"{self.path}/values")


def store_properties(props: DataFrame, path: str) -> PropertyTable:
    """Number the entities from 1 in the order of their keys, and keep values by type.

    Every entity has one `_type` property. This is where property rows are shuffled, once.
    """
    spark = props.sparkSession
    keys = with_rank(props.filter("type = '_type'").select("entity_key").distinct(), ["entity_key"], "no")
    keys.repartitionByRange("no").sortWithinPartitions("no").write.parquet(f"{path}/keys")
    value = F.coalesce("string_value", "reference_value", F.col("boolean_value").cast("string"))
    rows = props.select("entity_key", "type", value.alias("value")).join(
        spark.read.parquet(f"{path}/keys"), "entity_key"
    )
    (
        rows.select("no", "value", "type")
        .hint("rebalance", F.col("type"))
        .sortWithinPartitions("type", "value")
        .write.partitionBy("type")
        .parquet(f"{path}/values")
    )
    return PropertyTable(spark, path)


def _bitmaps(rows: DataFrame) -> DataFrame:
    """(bucket, bits): one bitmap for every 32,768 entities that have a row."""
    return rows.groupBy(F.bitmap_bucket_number("no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("no")).alias("bits")
    )


def _byte(bits: Column, at: Column) -> Column:
    """A byte of a bitmap as a number, from its hexadecimal digits."""
    return F.conv(F.substring(bits, at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def find_entities(table: PropertyTable, conditions: dict[str, str]) -> DataFrame:
    """Keys of the entities having every given property value; '' means the property is empty.

    Each condition becomes bitmaps where its rows are read; only these are shuffled, and put
    together bucket by bucket. A property is empty where no row has a value, so those bits are
    taken away.
    """
    values = table.values()
    positive = {name: v for name, v in conditions.items() if v != ""}
    if not positive:
        wanted = [values.filter("type = '_type'")]
    else:
        wanted = [values.filter((F.col("type") == n) & (F.col("value") == v)) for n, v in positive.items()]
    every = reduce(DataFrame.unionByName, [_bitmaps(rows) for rows in wanted])
    met = every.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    met = met.filter((F.col("n") == len(wanted)) & (F.bitmap_count("bits") > 0)).select("bucket", "bits")
    named = [n for n, v in conditions.items() if v == ""]
    some = values.filter(F.col("type").isin(named) & (F.col("value") != ""))
    taken = _bitmaps(some).select("bucket", F.hex("bits").alias("_not"))
    both = met.select("bucket", F.hex("bits").alias("_hex")).join(taken, "bucket", "left")
    byte = F.transform(
        F.sequence(F.lit(0), F.lit(SIZE - 1)),
        lambda i: _byte(F.col("_hex"), i).bitwiseAND(
            F.bitwise_not(F.coalesce(_byte(F.col("_not"), i), F.lit(0)))
        ),
    )
    bytes_ = both.select("bucket", F.posexplode(byte).alias("_at", "_byte")).filter("_byte <> 0")
    bit = F.explode(F.sequence(F.lit(0), F.lit(7)))
    bits = bytes_.withColumn("_bit", bit).filter("(_byte >> _bit) & 1 = 1")
    numbers = bits.select(((F.col("bucket") - 1) * SIZE * 8 + F.col("_at") * 8 + F.col("_bit") + 1).alias("no"))
    return table.keys().join(numbers, "no", "left_semi").select("entity_key")
