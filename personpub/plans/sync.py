"""One run of the property synchronisation over stored tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personpub.operators.persons import json_failures
from personpub.operators.properties import sync_step
from personpub.operators.stats import load_account
from personpub.schemas import JSON_COLUMNS
from personpub.sources.targets import Target, current, publish, read_target


def sync_targets(root: str, buckets: int | None = None) -> tuple[Target, Target, Target]:
    """(entities, sync state, rejected persons)"""
    return (
        Target(f"{root}/entities", "entity_key", "updated", buckets=buckets),
        Target(f"{root}/state", "persoon", "sync_ts", buckets=buckets),
        Target(f"{root}/rejects", "persoon", "updated", buckets=buckets),
    )


class SyncAccount(NamedTuple):
    """Rows per status and reason, and the JSON cells that do not parse."""

    account: DataFrame
    failures: DataFrame


def run_sync(
    person: DataFrame,
    entities: Target,
    state: Target,
    rejects: Target,
    names: dict[str, str],
    type_ref: str,
    parent_ref: str,
    now: Column,
    n: int | None,
    **options: bool,
) -> SyncAccount:
    """Merge the entities of the next n pending persons; None drains the pending set.

    The sync state is written last: a run that fails before is done again and
    replaces the same entities.
    """
    spark = person.sparkSession
    if current(spark, state) is None:
        empty = "persoon string, entu_id string, sync_ts timestamp_ntz"
        sync = spark.createDataFrame([], empty)
    else:
        sync = read_target(spark, state)
    known = read_target(spark, rejects) if current(spark, rejects) is not None else None
    step = sync_step(person, sync, names, type_ref, parent_ref, now, n, known, **options)
    publish(step.entities, entities, "update")
    publish(step.rejects, rejects, "update")
    publish(step.done, state, "update")
    results = step.done.select(F.lit("indexed").alias("status"), F.lit(None).cast("string").alias("reason"))
    failed = step.rejects.select(F.lit("failed").alias("status"), F.col("reject_reason").alias("reason"))
    cells = [c for c in JSON_COLUMNS if c in step.batch.columns]
    return SyncAccount(load_account(results.unionByName(failed)), json_failures(step.batch, cells))
