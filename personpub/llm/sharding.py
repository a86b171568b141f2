"""Sharding: the smallest largest shard over ordered atoms, by binary search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from personpub.llm.common import only, table

SHARDS = 40
ATOMS = 65_536
PARTS = 64

#: Greedy check from the left: the number of shards that `cap` bytes each lead to.
_NEEDED = """
aggregate(sizes, named_struct('k', 1, 'fill', 0L),
  (a, x) -> if(a.fill + x <= mid, named_struct('k', a.k, 'fill', a.fill + x),
                                  named_struct('k', a.k + 1, 'fill', x)),
  a -> a.k)
"""

#: Binary search between what any split needs and what a greedy one always manages.
_CAPACITY = f"""
aggregate(sequence(1, 62),
  named_struct('lo', greatest(array_max(sizes), cast(ceil(total / {{shards}}) AS bigint)),
               'hi', array_max(sizes) + cast(ceil(total / {{shards}}) AS bigint)),
  (b, i) -> if(b.lo >= b.hi, b,
    element_at(transform(array((b.lo + b.hi) div 2), mid ->
      if({_NEEDED} <= {{shards}}, named_struct('lo', b.lo, 'hi', mid),
                                  named_struct('lo', mid + 1, 'hi', b.hi))), 1)),
  b -> b.hi)
"""

#: Greedy from the right: position j of the reversed list is the least start of the last j shards.
_LATEST = """
aggregate(sequence(size(sizes), 1), named_struct('fill', 0L, 'at', cast(array() AS array<int>)),
  (a, i) -> if(a.fill + element_at(sizes, i) <= cap,
    named_struct('fill', a.fill + element_at(sizes, i), 'at', a.at),
    named_struct('fill', element_at(sizes, i), 'at', array_append(a.at, i + 1))),
  a -> a.at)
"""

#: The cuts: a shard ends when it is full, or when it has its share of what is left and the
#: rest still fits into the other shards.
_CUTS = """
aggregate(sequence(1, size(sizes)),
  named_struct('k', 1, 'fill', 0L, 'left', total, 'cuts', cast(array() AS array<int>)),
  (a, i) -> if(a.fill > 0 AND a.k < {shards} AND (
      a.fill + element_at(sizes, i) > cap
      OR ((a.fill + element_at(sizes, i) / 2) * ({shards} - a.k + 1) > a.left
          AND i >= coalesce(get(latest, {shards} - a.k - 1), 1))),
    named_struct('k', a.k + 1, 'fill', element_at(sizes, i), 'left', a.left - a.fill,
                 'cuts', array_append(a.cuts, i)),
    named_struct('k', a.k, 'fill', a.fill + element_at(sizes, i), 'left', a.left, 'cuts', a.cuts)),
  a -> a.cuts)
"""


def cut_points(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Add to a row with an array `sizes` (longs) `cap`, the smallest feasible
    capacity, and `cuts`, the positions (from 1) at which shards 1, 2, ... begin.

    The list is bounded (ATOMS entries), so it fits one row. No shard exceeds `cap`;
    within that bound each shard is cut near its share of the bytes left, so that the
    last ones do not stay empty. An empty list has no cuts.
    """
    row = sizes.withColumn("total", F.expr("aggregate(sizes, 0L, (a, x) -> a + x)"))
    row = row.withColumn("cap", F.expr(f"if(size(sizes) = 0, 0L, {_CAPACITY.format(shards=shards)})"))
    row = row.withColumn("latest", F.expr(f"if(size(sizes) = 0, cast(array() AS array<int>), {_LATEST})"))
    return row.withColumn(
        "cuts",
        F.expr(f"if(size(sizes) = 0, cast(array() AS array<int>), {_CUTS.format(shards=shards)})"),
    ).drop("latest", "total")


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    atoms: int = ATOMS,
    parts: int = PARTS,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `bytes`: equal texts are never parted and the capacity is the least for the
    ordered atoms, not for the single groups. The order is that of the texts' hash: an atom holds the groups of equal
    texts of one of `atoms` hash ranges, so a group is never split, and the list to
    be searched stays bounded however many documents there are (up to some thousand
    texts an atom is nearly always one group). A document counts its UTF-8 bytes and 16.
    Slots number a shard's rows from 0, by atom, by part and by (doc_id, text hash).
    A null text is an empty one; null ids come first; rows repeated are rows of their
    own. An empty table gives no rows.

    Rows of one atom are numbered in `parts` parts by the hash of the id, with the
    counts of the parts before them added, so that a large group of copies is not
    sorted in one task.
    """
    body = F.coalesce(F.col("body"), F.lit(""))
    rows = only(docs, doc_id=id_col, body=text_col).select(
        "doc_id",
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(body), F.lit(atoms)).cast("int").alias("atom"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(parts)).cast("int").alias("part"),
    )
    cells = rows.groupBy("atom", "part").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")
    )
    heads = cells.groupBy("atom").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    # at most `atoms` entries
    listed = heads.agg(F.sort_array(F.collect_list(F.struct("atom", "bytes", "n"))).alias("all"))
    placed = cut_points(listed.withColumn("sizes", F.col("all.bytes")), shards).select("cuts", F.posexplode("all").alias("at", "a")).select(
        F.col("a.atom").alias("atom"),
        F.expr("size(filter(cuts, c -> c <= at + 1))").alias("shard"),
        F.col("a.n").alias("n"),
    )
    before = W.partitionBy("shard").orderBy("atom").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.select("atom", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    earlier = W.partitionBy("atom").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("atom", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    cells = cells.join(placed, "atom").select(
        "atom", "part", "shard", (F.col("first") + F.col("skip")).alias("offset")
    )
    within = W.partitionBy("atom", "part").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("i", F.row_number().over(within))
        .join(cells, ["atom", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("offset") + F.col("i") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
