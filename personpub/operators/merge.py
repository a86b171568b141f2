"""Keeping one row per key up to date."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from personpub.session import settle

#: tasks that the versions of one key are dealt over, at most
SPREAD = 64


def latest(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """The last row per key, `order` given first to last.

    Rows are dealt first, by key and version, so that a task sorts its part of them and not all
    that its file holds. Spark then cuts each task's rows to one per key before the shuffle, so
    a key with very many versions is not gathered in one place.
    """
    dealt = F.xxhash64(*[c for c in order if isinstance(c, str)])
    newest_first = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    w = Window.partitionBy(key).orderBy(*newest_first)
    rows = df.repartition(F.col(key), F.pmod(dealt, F.lit(SPREAD)))
    return rows.withColumn("_row", F.row_number().over(w)).filter("_row = 1").drop("_row")


def insert_ignore(
    target: DataFrame, rows: DataFrame, key: str, order: list[str | Column]
) -> DataFrame:
    """Add rows whose key is new; of several with one key the first in `order`."""
    first_last = Window.partitionBy(key).orderBy(*order)
    first = (
        rows.withColumn("_row", F.row_number().over(first_last))
        .filter("_row = 1")
        .drop("_row")
    )
    return target.unionByName(first.join(target.select(key), key, "left_anti"))


def upsert(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows (one per key) replace those of the same key."""
    return target.join(rows.select(key), key, "left_anti").unionByName(rows)


def apply_changes(
    target: DataFrame, changes: DataFrame, key: str, order: list[str | Column], deleted: str
) -> DataFrame:
    """Merge a batch: the last change of a key replaces its row or removes it."""
    last = latest(changes, key, order)
    kept = target.join(last.select(key), key, "left_anti")
    return kept.unionByName(last.filter(~F.col(deleted)).select(*target.columns))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; unknown counts as not true."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def row_digest(columns: list[str]) -> Column:
    """128 bits of the values of some columns, as 32 digits; a null differs from every value."""
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), *parts)), 16, "0") for seed in (1, 2)]
    return F.concat(*halves)


def with_digest(df: DataFrame, key: str) -> DataFrame:
    """With `digest`, of all columns but the key and the change time. A kept table holds it, so
    that the next comparison reads two columns of it."""
    values = sorted(c for c in df.columns if c not in (key, "updated", "digest"))
    return df.withColumn("digest", row_digest(values))


class Differences(NamedTuple):
    """Keys of rows that are new or differ, and keys of kept rows that are replaced or gone."""

    changed: DataFrame
    stale: DataFrame


def differences(old: DataFrame, new: DataFrame, key: str) -> Differences:
    """Compare a kept table with new rows by key and digest alone.

    Only these two columns are shuffled, and only keys that differ are kept. A table that does not
    hold its digests is read whole for them.
    """
    kept = old if "digest" in old.columns else with_digest(old, key)
    before = kept.select(key, F.col("digest").alias("_old"))
    after = with_digest(new, key).select(key, F.col("digest").alias("_new"))
    both = settle(before.join(after, key, "full").filter("NOT (_old <=> _new)"))
    return Differences(
        both.filter("_new IS NOT NULL").select(key), both.filter("_old IS NOT NULL").select(key)
    )


def real_changes(old: DataFrame, new: DataFrame, key: str, now: Column) -> DataFrame:
    """The new rows that are not in the kept table as they are, with the change time `now`."""
    changed = differences(old, new, key).changed
    return new.join(changed, key, "left_semi").withColumn("updated", now).select(*new.columns)


def stamp_changes(old: DataFrame, new: DataFrame, key: str, now: Column) -> DataFrame:
    """The new rows; `updated` moves only where some column differs.

    `old` is the kept table with its digests (`with_digest`). Rows that are equal are taken
    from it as they lie there; whole rows are only fetched for real changes.
    """
    found = differences(old, new, key)
    fresh = new.join(found.changed, key, "left_semi").withColumn("updated", now)
    same = old.join(found.stale, key, "left_anti")
    return same.select(*new.columns).unionByName(fresh.select(*new.columns))
