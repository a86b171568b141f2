"""Global order numbers without a one-task window, and tables kept in order."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = 10_000
#: rows of a range, sampled rows for each range, and ranges at most
RANGE_ROWS, DRAWN, MOST_RANGES = 1_000_000, 40, 4_096


def _ranges(n: int, rows: int) -> int:
    return min(MOST_RANGES, max(1, math.ceil(n / rows)))


def _in_ranges(df: DataFrame, order: list[str], parts: int, n: int) -> DataFrame:
    """With `_range`, the number of a row's range, a function of its place in the order alone.

    The ranges' bounds come from a sample drawn by a hash of the rows, and are looked up in
    two steps: in every 64th of them, then in the 64 that follow.
    """
    place = F.struct(*order)
    bound = min((1 << 64) * parts * DRAWN // n, (1 << 64) - 1) - (1 << 63)
    drawn = df.filter(F.xxhash64(F.lit("range"), *order) <= F.lit(bound))
    found = drawn.select(place.alias("b")).agg(F.sort_array(F.collect_list("b")).alias("all"))  # parts * DRAWN or so
    step = F.greatest(F.lit(1), F.floor(F.size("all") / parts).cast("int"))
    picked = F.filter(F.col("all"), lambda b, i: (i > 0) & (i % step == 0))
    bounds = found.select(F.array_distinct(picked).alias("fine"))
    bounds = bounds.select(F.struct("fine", F.filter("fine", lambda b, i: i % 64 == 0).alias("coarse")).alias("s"))
    beside = df.withColumn("_bounds", bounds.scalar())

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= place))

    block = F.greatest(below(F.col("_bounds.coarse")) - 1, F.lit(0))
    beside = beside.withColumn("_block", block)
    within = below(F.slice("_bounds.fine", F.col("_block") * 64 + 1, F.lit(64)))
    return beside.withColumn("_range", F.col("_block") * 64 + within).drop("_bounds", "_block")


def with_rank(df: DataFrame, order: list[str], name: str = "rank", rows: int = RANGE_ROWS) -> DataFrame:
    """Number the rows from 1 by a total order.

    Rows are split into ranges of about `rows`; a row's number is its place in its range plus
    the sizes of the ranges before. Nothing is written: a row's range depends on the row and
    the bounds only, so that sizes and places agree however often they are computed.
    """
    n = df.count()
    parts = _ranges(n, rows)
    if parts == 1:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long"))
    placed = _in_ranges(df, order, parts, n)
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(starts), "_range")  # a row a range, MOST_RANGES at most
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_range", "_place", "_start")
    )


class OrderedTable(NamedTuple):
    """A table kept in ranges of a total order, with the number of rows before each."""

    spark: SparkSession
    path: str
    order: list[str]
    schema: T.StructType

    def index(self) -> DataFrame:
        """One row per range: range, n (rows), start (rows before it)."""
        return self.spark.read.schema("range int, n long, start long").parquet(f"{self.path}/index")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def page(self, size: int, offset: int, name: str = "rank") -> DataFrame:
        """Rows offset + 1 to offset + size with their numbers, from the ranges that hold them."""
        held = (F.col("start") < offset + size) & (F.col("start") + F.col("n") > offset)
        starts = {r["range"]: r["start"] for r in self.index().filter(held).collect()}  # those of a page
        rows = self.rows().filter(F.col("range").isin(list(starts)))
        before = F.lit(0).cast("long")
        for number, start in starts.items():
            before = F.when(F.col("range") == number, F.lit(start)).otherwise(before)
        place = F.row_number().over(Window.partitionBy("range").orderBy(*self.order))
        rank = F.col(name)
        return rows.withColumn(name, before + place).drop("range").filter((rank > offset) & (rank <= offset + size))


def store_ordered(df: DataFrame, order: list[str], path: str, rows: int = RANGE_ROWS) -> OrderedTable:
    """Keep a table in ranges of about `rows` rows, sorted, and their sizes beside them."""
    parts = _ranges(df.count(), rows)
    (
        df.repartitionByRange(parts, *order)
        .withColumn("range", F.spark_partition_id())
        .sortWithinPartitions("range", *order)
        .write.partitionBy("range")
        .parquet(f"{path}/rows")
    )
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField("range", T.IntegerType())])
    kept = spark.read.schema(schema).parquet(f"{path}/rows")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = kept.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    start = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    sizes.select("range", "n", start).coalesce(1).write.parquet(f"{path}/index")
    return OrderedTable(spark, path, order, schema)


def running_sums(df: DataFrame, step: str, columns: list[str]) -> DataFrame:
    """Running sums of `columns` over dense step numbers from 0.

    Sums run within blocks of steps; only the block totals go through one task.
    """
    blocks = df.withColumn("_block", F.floor(F.col(step) / STEP))
    totals = blocks.groupBy("_block").agg(*[F.sum(c).alias(c) for c in columns])
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_block",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in columns],
    )
    inside = (
        Window.partitionBy("_block").orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        blocks.join(starts, "_block")
        .select(
            step, *[(F.col(f"_{c}") + F.sum(c).over(inside)).alias(c) for c in columns]
        )
    )
