"""Counts over records, persons and loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators.persons import REASONS, classify, empty_names, in_register, live, representatives
from personpub.operators.ranks import running_sums, with_rank

LOAD_FLAGS = ("isperson", "wwii", "mv", "emem", "kivi")
BATCH_ROWS = 2_500  # fixed value: documents per batch


def count_representatives(record: DataFrame) -> DataFrame:
    found = representatives(record, numbered=False)
    return found.agg(F.count("*").alias("isikuid_baasis"))


def live_counts(person: DataFrame) -> DataFrame:
    """All counts over live persons in one pass."""
    return live(person).agg(
        F.count("*").alias("isikuid_veebis"),
        F.count_if("emem").alias("e_memoriaalil"),
        F.count_if("kivi").alias("kivis"),
        F.count_if("wwiiref").alias("pogenikke"),
        F.count_if(F.col("synd") == "").alias("synd_teadmata"),
    )


def refugees_registered(person: DataFrame, register: DataFrame) -> DataFrame:
    refugees = live(person).filter("wwiiref").select("persoon")
    return in_register(refugees, register).agg(F.count("*").alias("prga_pogenikke"))


def statistics(record: DataFrame, person: DataFrame, register: DataFrame) -> DataFrame:
    """The statistics row, put together from three rows of counts."""
    rows = (
        count_representatives(record)
        .unionByName(live_counts(person), allowMissingColumns=True)
        .unionByName(refugees_registered(person, register), allowMissingColumns=True)
    )
    return rows.agg(*[F.max(c).alias(c) for c in STATISTICS])


STATISTICS = (
    "isikuid_baasis",
    "isikuid_veebis",
    "e_memoriaalil",
    "kivis",
    "pogenikke",
    "prga_pogenikke",
    "synd_teadmata",
)


def _signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """The images of changed rows: -1 for what they were, 1 for what they are."""
    return before.withColumn("_n", F.lit(-1)).unionByName(after.withColumn("_n", F.lit(1)))


def statistics_change(
    before: DataFrame,
    after: DataFrame,
    register: DataFrame,
    records_before: DataFrame | None = None,
    records_after: DataFrame | None = None,
) -> DataFrame:
    """What changed persons and records add to the statistics row, from their images before
    and after the change; new ones have none before, removed ones none after.

    Persons and records that did not change are not read.
    """

    def net(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))

    moved = live(_signed(before, after)).select("persoon", "emem", "kivi", "wwiiref", "synd", "_n")
    rows = moved.agg(
        net(F.lit(True)).alias("isikuid_veebis"),
        net(F.col("emem")).alias("e_memoriaalil"),
        net(F.col("kivi")).alias("kivis"),
        net(F.col("wwiiref")).alias("pogenikke"),
        net(F.col("synd") == "").alias("synd_teadmata"),
    )
    refugees = in_register(moved.filter("wwiiref"), register)
    rows = rows.unionByName(refugees.agg(net(F.lit(True)).alias("prga_pogenikke")), allowMissingColumns=True)
    if records_before is not None and records_after is not None:
        found = representatives(_signed(records_before, records_after), numbered=False)
        rows = rows.unionByName(found.agg(net(F.lit(True)).alias("isikuid_baasis")), allowMissingColumns=True)
    known = [F.col(c) if c in rows.columns else F.lit(0).alias(c) for c in STATISTICS]
    return rows.select(*known).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in STATISTICS])


def add_statistics(row: DataFrame, change: DataFrame) -> DataFrame:
    """A statistics row brought up to date by a change of it."""
    both = row.select(*STATISTICS).unionByName(change.select(*STATISTICS))
    return both.agg(*[F.sum(c).alias(c) for c in STATISTICS])


def high_water(df: DataFrame, column: str = "updated") -> DataFrame:
    return df.agg(F.max(column).alias("ts"))


def load_totals(doc: DataFrame) -> DataFrame:
    return doc.agg(
        F.count("*").alias("all"), *[F.sum(c).cast("bigint").alias(c) for c in LOAD_FLAGS]
    )


def load_result(person: DataFrame, null_deletes: bool = True) -> DataFrame:
    """What a load does with each row: deleted, failed with a reason, or indexed."""
    return with_result(person, null_deletes).select("status", "reason")


def with_result(person: DataFrame, null_deletes: bool = True) -> DataFrame:
    """The rows with `status` and `reason`."""
    judged = classify(person)
    gone = fn.tombstone(F.col("kirje"), null_deletes)
    failed = F.col("outcome") == "rejected"
    status = F.when(gone, F.lit("deleted")).when(failed, F.lit("failed")).otherwise(F.lit("indexed"))
    return judged.withColumn("status", status).withColumn("reason", F.when(~gone, F.col("reject_reason")))


class Account:
    """Rows per status and reason, counted by the pass that writes the rows.

    `counted` goes onto the rows of that pass, which must not shuffle them, so that every row is
    counted once however often its task runs; `rows` waits until they are written.
    """

    def __init__(self, reasons: tuple[str, ...] = REASONS):
        self.kinds = [("indexed", None), ("deleted", None), *[("failed", r) for r in reasons]]
        self.seen = Observation()

    def counted(self, rows: DataFrame, status: Column, reason: Column) -> DataFrame:
        def is_kind(kind: tuple[str, str | None]) -> Column:
            return (status == kind[0]) & reason.eqNullSafe(F.lit(kind[1]).cast("string"))

        counts = [F.count_if(is_kind(k)).alias(f"n{i}") for i, k in enumerate(self.kinds)]
        return rows.observe(self.seen, *counts)

    def rows(self, spark: SparkSession) -> DataFrame:
        found = self.seen.get
        rows = [(*k, found[f"n{i}"]) for i, k in enumerate(self.kinds) if found[f"n{i}"]]
        return spark.createDataFrame(rows, "status string, reason string, n long")


def load_account(result: DataFrame) -> DataFrame:
    """Rows per status (indexed, deleted, failed) and reason."""
    return result.groupBy("status", "reason").agg(F.count("*").alias("n"))


def load_summary(result: DataFrame) -> DataFrame:
    return result.agg(
        F.count("*").alias("read"),
        F.count_if(F.col("status") == "indexed").alias("indexed"),
        F.count_if(F.col("status") == "deleted").alias("deleted"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") != "failed").alias("uploaded"),
    )


def count_empty(person: DataFrame) -> DataFrame:
    return empty_names(person).agg(F.count("*").alias("empty_persons"))


def running_totals(
    doc: DataFrame, order: list[str], flags: list[str], n: int = BATCH_ROWS
) -> DataFrame:
    """Rows and flags so far, after each batch of n rows in the given order."""
    ranked = with_rank(doc.select(*order, *flags), order)
    batches = (
        ranked.withColumn("batch", F.floor((F.col("rank") - 1) / n))
        .groupBy("batch")
        .agg(F.count("*").alias("all"), *[F.sum(c).alias(c) for c in flags])
    )
    return running_sums(batches, "batch", ["all", *flags])
