"""A filter of fixed size over ids, to leave most rows out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: longs in the filter: 2 MB, and no more for any number of ids
SLOTS = 1 << 18


def id_bits(hashes: DataFrame, slots: int = SLOTS) -> Column:
    """The column `h` (longs) as one array of `slots` longs with a bit set for each hash."""
    marked = hashes.groupBy(F.pmod(F.shiftright("h", 6), F.lit(slots)).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63L AS int))")).alias("b")
    )
    every = hashes.sparkSession.range(slots).select(F.col("id").alias("slot"))
    entry = F.struct("slot", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    return (
        every.join(marked, "slot", "left")
        .agg(F.sort_array(F.collect_list(entry)).alias("l"))
        .select(F.col("l.b").alias("bits"))
        .scalar()
    )


def passes(h: Column, bits: Column, slots: int = SLOTS) -> Column:
    """Whether the hash may be in the filter; never false for one that is."""
    long = F.get(bits, F.pmod(F.shiftright(h, 6), F.lit(slots)).cast("int"))
    return F.getbit(long, h.bitwiseAND(F.lit(63)).cast("int")) == 1


def row_id(last: bool = True, doc_id: str = "doc_id", text: str = "text") -> Column:
    """The id as a long; a row without one gets a number from its text's hash, above 2^62, or
    below -2^62 if such rows shall come first."""
    own = F.lit(1 << 62) + F.pmod(F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(1 << 61))
    return F.coalesce(F.col(f"`{doc_id}`").cast("long"), own if last else -own)


def without(docs: DataFrame, dropped: DataFrame, key: Column, mark: Column | None = None) -> DataFrame:
    """The rows of `docs`, all columns, whose `key` (never null) is not in the column `key` of
    `dropped`; with `mark`, whose key and mark are not there together.

    Rows that miss the filter of dropped keys are kept where they are read; only the others
    get a mark and are shuffled to be compared.
    """
    names = ["key"] if mark is None else ["key", "mark"]
    out = dropped.select(*[F.col(n).alias(f"_dropped_{n}") for n in names]).distinct()
    suspect = passes(F.xxhash64(key), id_bits(out.select(F.xxhash64("_dropped_key").alias("h"))))
    compared = _named(docs.filter(suspect), key, F.lit(0) if mark is None else mark)
    same = F.col("_key") == F.col("_dropped_key")
    if mark is not None:
        same = same & (F.col("_mark") == F.col("_dropped_mark"))
    return docs.filter(~suspect).unionByName(compared.join(out, same, "left_anti").select("_row.*"))


def _named(docs: DataFrame, key: Column, mark: Column) -> DataFrame:
    """Key and mark beside the whole row, so that no name of its columns is in the way."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("_row"), key.alias("_key"), mark.alias("_mark"))


def once(docs: DataFrame, again: DataFrame, key: Column, mark: Column) -> DataFrame:
    """The rows of `docs`, of those whose key and mark are in `again` the first by their columns' values."""
    listed = again.select(F.col("key").alias("_key"), F.col("mark").alias("_mark")).distinct()
    suspect = passes(F.xxhash64(key), id_bits(listed.select(F.xxhash64("_key").alias("h"))))
    compared = _named(docs.filter(suspect), key, mark)
    place = Window.partitionBy("_key", "_mark").orderBy(F.to_json("_row"))
    found = compared.join(listed, ["_key", "_mark"], "left_semi").withColumn("_place", F.row_number().over(place))
    rest = compared.join(listed, ["_key", "_mark"], "left_anti")
    kept = found.filter("_place = 1").select("_row.*").unionByName(rest.select("_row.*"))
    return docs.filter(~suspect).unionByName(kept)
