"""A keyed table in hash partitions; an update rewrites the partitions that its keys are in.

There is one row per key, and its partition is a hash of the key. An update reads only the
partitions it touches, puts its changes over their rows, and writes those partitions by Spark's
dynamic partition overwrite; the others keep their files. With n partitions, a batch of
k keys reads and writes at most k of them, so a table with small batches wants many.

<root>/rows/_bucket=<b>/   the rows
<root>/about.json          key, version column, partitions, columns, mark, last batches
<root>/next/<run>/         the new rows of touched partitions, until they are in place
<root>/writer              the run that writes now

One run writes at a time: the second one is refused. A run that dies leaves its `writer` file;
`recover` then finishes it if its rows were complete, or drops it. A reader that reads while
partitions are exchanged may see some before and some after the update.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personpub.operators.merge import latest
from personpub.session import settle
from personpub.sources.files import create_text, exists, read_text, remove, replace_text

BUCKETS = 32


@dataclass(frozen=True)
class Target:
    """`version` orders the states of one key; `deleted` marks tombstones.

    The number of partitions is fixed when the table is made. None takes the table's;
    another number than the table's is refused, and so are another key and version column.
    """

    root: str
    key: str
    version: str
    deleted: str = "_deleted"
    buckets: int | None = None

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def about(self) -> str:
        return f"{self.root}/about.json"

    @property
    def writer(self) -> str:
        return f"{self.root}/writer"


class About(NamedTuple):
    """What is known of a table besides its rows."""

    key: str
    ordered_by: str
    buckets: int
    schema: str
    mark: str | None
    batches: dict[str, int]


class Published(NamedTuple):
    """Whether the batch had been there before, and the partitions that were written."""

    skipped: bool
    buckets: list[int]


class Busy(RuntimeError):
    """Another run writes this table, or one died while it did."""


def current(spark: SparkSession, target: Target) -> About | None:
    """What is known of the table, None before the first rows and after a drop."""
    text = read_text(spark, target.about)
    if text is None:
        return None
    about = About(**json.loads(text))
    kept = (about.key, about.ordered_by, about.buckets)
    asked = (target.key, target.version, target.buckets or about.buckets)
    if kept != asked:
        raise ValueError(f"the table at {target.root} is kept by {kept}, not by {asked}")
    return about


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, target: Target, about: About) -> DataFrame:
    files = T.StructType.fromJson(json.loads(about.schema)).add("_bucket", T.IntegerType())
    return spark.read.schema(files).parquet(target.rows)


def read_target(
    spark: SparkSession, target: Target, with_tombstones: bool = False, key: str | None = None
) -> DataFrame:
    """The table; with `key` only that row, read from its partition."""
    about = current(spark, target)
    if about is None:
        raise ValueError(f"no table at {target.root}")
    rows = _stored(spark, target, about)
    if key is not None:
        rows = rows.filter(F.col("_bucket") == _bucket(F.lit(key), about.buckets)).filter(F.col(target.key) == key)
    rows = rows.drop("_bucket")
    return rows if with_tombstones else rows.filter(~F.col(target.deleted)).drop(target.deleted)


def read_keys(spark: SparkSession, target: Target, keys: DataFrame, with_tombstones: bool = False) -> DataFrame:
    """The rows whose key is in the column of that name of `keys`, from their partitions alone."""
    about = current(spark, target)
    if about is None:
        raise ValueError(f"no table at {target.root}")
    wanted = keys.select(target.key, _bucket(F.col(target.key), about.buckets).alias("_bucket")).distinct()
    buckets = [r[0] for r in wanted.select("_bucket").distinct().collect()]  # at most the table's
    rows = _stored(spark, target, about).filter(F.col("_bucket").isin(buckets))
    rows = rows.join(wanted, [target.key, "_bucket"], "left_semi").drop("_bucket")
    return rows if with_tombstones else rows.filter(~F.col(target.deleted)).drop(target.deleted)


def _last(rows: DataFrame, target: Target, order: list[str] | None) -> DataFrame:
    """The last row of each key by version, then `order`, then the row's whole content, so
    that equal versions give the same winner every time."""
    return latest(rows, target.key, [target.version, *(order or []), F.to_json(F.struct(*rows.columns))])


def _seen(about: About | None, batch: str | None) -> bool:
    """Whether the batch `name:number` is not above the last one of its name."""
    if about is None or batch is None:
        return False
    name, number = _numbered(batch)
    return number <= about.batches.get(name, -1)


def _numbered(batch: str) -> tuple[str, int]:
    name, _, number = batch.rpartition(":")
    return (name, int(number)) if number.isdigit() else (batch, 0)


@contextmanager
def _writing(spark: SparkSession, target: Target) -> Iterator[str]:
    """The right to write the table; kept if the run dies while it exchanges partitions."""
    run = uuid.uuid4().hex
    if not create_text(spark, target.writer, json.dumps({"run": run})):
        raise Busy(f"{target.writer} is there: another run writes, or died; see recover()")
    try:
        yield run
    except BaseException:
        if "about" not in json.loads(read_text(spark, target.writer) or "{}"):
            remove(spark, target.writer)
        raise
    remove(spark, target.writer)


def publish(
    rows: DataFrame,
    target: Target,
    mode: str,
    batch: str | None = None,
    mark: str | None = None,
    order: list[str] | None = None,
    late: bool = True,
) -> Published:
    """Bring rows into the table.

    recreate: `rows` are the whole table; of several with one key the last stays.
    update: `rows` are changes; the last one of a key, by version and then
    `order`, goes over the table's row. With `late`, it does so only if the
    table's row has no higher version, so that late and repeated changes do no
    harm; leave that out only for changes known to be newer than the table.
    Tombstones stay in the table, hidden. A batch `name:number` that is not above the
    last of its name is skipped. The mark and the batch are known from the moment all rows
    are in place.
    """
    if mode not in ("recreate", "update"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = rows.sparkSession
    with _writing(spark, target) as run:
        known = read_text(spark, target.about)
        about = current(spark, target) if mode == "update" else None
        if _seen(About(**json.loads(known)) if known else None, batch):
            return Published(True, [])
        if target.deleted not in rows.columns:
            rows = rows.withColumn(target.deleted, F.lit(False))
        kind = rows.schema[target.key].dataType
        if isinstance(kind, T.StringType) and kind.collation != "UTF8_BINARY":
            raise ValueError("partitions are told by the bytes of a key, so it cannot be collated")
        batches = dict(about.batches) if about else {}
        if batch is not None:
            name, number = _numbered(batch)
            batches[name] = number
        if about is None:
            buckets = target.buckets or BUCKETS
            about = About(target.key, target.version, buckets, rows.schema.json(), mark, batches)
            remove(spark, target.about)
            _write(_in_buckets(_last(rows, target, order), target, about), target, target.rows, "static")
            replace_text(spark, target.about, json.dumps(about._asdict()))
            return Published(False, list(range(buckets)))
        known = T.StructType.fromJson(json.loads(about.schema)).names
        if set(known) != set(rows.columns):
            raise ValueError(f"columns {rows.columns} do not fit the table's {known}")
        changes = settle(_in_buckets(_last(rows.select(*known), target, order), target, about))
        touched = sorted(r[0] for r in changes.select("_bucket").distinct().collect())  # at most the table's
        about = about._replace(mark=mark or about.mark, batches=batches)
        if touched:
            before = _stored(spark, target, about).filter(F.col("_bucket").isin(touched))
            _write(_over(before, changes, target, late), target, f"{target.root}/next/{run}", "static")
        _finish(spark, target, run, about, bool(touched))
        return Published(False, touched)


def _in_buckets(rows: DataFrame, target: Target, about: About) -> DataFrame:
    return rows.withColumn("_bucket", _bucket(F.col(target.key), about.buckets))


def _over(before: DataFrame, changes: DataFrame, target: Target, late: bool) -> DataFrame:
    """One row per key. All of a partition meets in one place, so it is shuffled once."""
    both = before.withColumn("_new", F.lit(False)).unionByName(changes.withColumn("_new", F.lit(True)))
    order = [F.desc(target.version), F.desc("_new")] if late else [F.desc("_new")]
    of_key = Window.partitionBy("_bucket", target.key).orderBy(*order)
    ranked = both.repartition("_bucket").withColumn("_row", F.row_number().over(of_key))
    return ranked.filter("_row = 1").drop("_row", "_new")


def _write(rows: DataFrame, target: Target, path: str, overwrite: str) -> None:
    """Sorted by key. Rebalancing splits a partition that is large for one task over several."""
    (
        rows.hint("rebalance", F.col("_bucket"))
        .sortWithinPartitions("_bucket", target.key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .partitionBy("_bucket")
        .parquet(path)
    )


def _finish(spark: SparkSession, target: Target, run: str, about: About, rows: bool, whole: bool = False) -> None:
    """Exchange the partitions for the run's; may be done again until it succeeds."""
    intent = {"run": run, "rows": rows, "whole": whole, "about": about._asdict()}
    replace_text(spark, target.writer, json.dumps(intent))
    if rows:
        files = T.StructType.fromJson(json.loads(about.schema)).add("_bucket", T.IntegerType())
        fresh = spark.read.schema(files).parquet(f"{target.root}/next/{run}")
        _write(fresh, target, target.rows, "static" if whole else "dynamic")
    replace_text(spark, target.about, json.dumps(about._asdict()))
    remove(spark, f"{target.root}/next/{run}")


def recover(spark: SparkSession, target: Target) -> bool:
    """After a run has died: finish it if its rows were complete, else drop it. Whether it was finished.

    Only for a run that is known to be dead.
    """
    text = read_text(spark, target.writer)
    if text is None:
        return False
    intent = json.loads(text)
    if "about" in intent:
        rows = intent["rows"] and exists(spark, f"{target.root}/next/{intent['run']}")
        _finish(spark, target, intent["run"], About(**intent["about"]), rows, intent["whole"])
    else:
        remove(spark, f"{target.root}/next/{intent['run']}")
    remove(spark, target.writer)
    return "about" in intent


def forget(spark: SparkSession, target: Target, before: Column) -> None:
    """Write the table without the tombstones of versions below `before`."""
    with _writing(spark, target) as run:
        about = current(spark, target)
        if about is None:
            raise ValueError(f"no table at {target.root}")
        old = F.col(target.deleted) & (F.col(target.version) < before)
        rows = _stored(spark, target, about).filter(~F.coalesce(old, F.lit(False)))
        _write(rows, target, f"{target.root}/next/{run}", "static")
        _finish(spark, target, run, about, True, whole=True)


def drop_target(spark: SparkSession, target: Target) -> None:
    """Take the table away with its mark and batches."""
    if current(spark, target) is None:
        return
    with _writing(spark, target):
        remove(spark, target.about)
        remove(spark, target.rows)
