"""Exact dedup: local, salted and global combining, by whole content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import UPPER, ascii_lower, only, table

SALTS = 16


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest_chars: int = 64,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; a null text
    counts as empty, so null and empty texts form one group. The largest doc_id
    of a group stays. Null ids never win over an id; a group of null ids only
    keeps null. Rows that repeat an id and its text share one decision.
    An empty table gives no rows. Other columns of `docs` are not read.

    A row is combined three times, always under its digest and its whole text:
    in its task by the partial aggregate, then with the other rows of its salt,
    then with the winners of all salts. A group of any size is so at most one row
    per salt in the last step. Only digests, with a second hash beside them, travel
    back to the documents. Should two different texts ever agree in both, the job stops
    with an error. `digest_chars` shortens the digest used for grouping, so that
    tests can see clashes resolved.
    """
    rows = only(docs, doc_id=id_col, body=text_col).select(
        "doc_id",
        ascii_lower(F.col("body")).alias("body"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    )
    rows = rows.withColumn("sha", F.coalesce(F.sha2("body", 256), F.lit(""))).withColumn(
        "digest", F.substring("sha", 1, digest_chars)
    )
    salted = rows.groupBy("digest", "salt", "body").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    whole = salted.groupBy("digest", "body").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")
    )
    second = F.xxhash64("body").cast("string")
    clash = F.raise_error(F.lit("different texts with one digest and one hash"))
    # a key of its own, so that both sides of the join are dealt anew and large groups split
    winners = (
        whole.select("digest", second.alias("second"), "keep_id", "group_size")
        .groupBy("digest", "second")
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        )
        .select(
            F.concat("digest", "second").alias("key"),
            "keep_id",
            F.when(F.col("texts") > 1, clash.cast("long")).otherwise(F.col("group_size")).alias("group_size"),
        )
    )
    members = rows.select("doc_id", "sha", F.concat("digest", second).alias("key"))
    return members.join(winners, "key").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = f"""
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
