"""Persons whose lists have to be written anew because somebody else changed."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personpub.operators.persons import relations_json
from personpub.session import settle
from personpub.sources.targets import Target, publish, read_keys

LIST_KEY = ("persoon", "list", "code")


class Dependants(NamedTuple):
    """List rows to be written, (persoon, list, code) of those to be taken away, and their owners."""

    rows: DataFrame
    gone: DataFrame
    owners: DataFrame


def dependants(
    persons: Target, changed: DataFrame, relation: DataFrame, added: DataFrame, removed: DataFrame
) -> Dependants:
    """What changes in the lists of relations.

    `persons` already holds the new state; `changed` has the keys of persons that are new, renamed
    or gone; `relation` is the table after its own changes, `added` and `removed` those changes.
    Touched are the relations of changed persons, whichever side they are on, and changed relations
    of all persons. Names are read for the persons in touched relations only.
    """
    spark = changed.sparkSession
    keys = changed.select(F.col("persoon").alias("_changed")).distinct()
    known = relation.select("persoon", "other", "kind")
    by_other = known.join(keys, F.col("other") == F.col("_changed"), "left_semi")
    by_owner = known.join(keys, F.col("persoon") == F.col("_changed"), "left_semi")
    new = added.select("persoon", "other", "kind")
    touched = settle(by_other.unionByName(by_owner).unionByName(new).distinct())
    ends = touched.select("persoon").unionByName(touched.select(F.col("other").alias("persoon")))
    names = settle(read_keys(spark, persons, ends).select("persoon", "eesnimi", "perenimi"))
    rows = relations_json(names, touched).join(names.select("persoon"), "persoon", "left_semi")
    rows = settle(rows.select(*LIST_KEY, "element"))
    code = F.concat_ws("/", "other", "kind").alias("code")
    before = touched.unionByName(removed.select("persoon", "other", "kind")).distinct()
    before = before.select("persoon", F.lit("pereseosed").alias("list"), code)
    gone = before.join(rows, list(LIST_KEY), "left_anti")
    return Dependants(rows, gone, before.select("persoon").distinct())


def list_target(root: str, buckets: int | None = None) -> Target:
    """The table of list elements, by owner, list and code."""
    return Target(root, "id", "updated", buckets=buckets)


def publish_lists(
    lists: Target, rows: DataFrame, gone: DataFrame | None, now: Column, mode: str = "update"
) -> None:
    """Write list rows, and tombstones for those that are gone."""
    if gone is not None:
        taken = gone.select(*LIST_KEY, F.lit(None).cast("string").alias("element"), F.lit(True).alias(lists.deleted))
        rows = rows.withColumn(lists.deleted, F.lit(False)).unionByName(taken)
    publish(rows.withColumn("id", F.concat_ws("|", *LIST_KEY)).withColumn("updated", now), lists, mode)
