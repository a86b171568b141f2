"""One incremental run: mark, window, projection, merge, new mark."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators.changes import changed_between
from personpub.operators.documents import to_document
from personpub.operators.paging import oldest
from personpub.operators.persons import export_projection, json_failures, wrong_kinds
from personpub.operators.stats import Account, high_water, with_result
from personpub.session import settle
from personpub.sources.targets import Published, Target, current, publish


class Outcome(NamedTuple):
    """What a run did; `account` has its rows per status and reason, `failures` the JSON
    cells that do not parse, `wrong_kinds` those that are no list (or object)."""

    status: str  # published or no news
    last: str | None
    new: str
    written: Published | None
    account: DataFrame | None = None
    failures: DataFrame | None = None
    wrong_kinds: DataFrame | None = None


KINDS = {"kirjed": "list", "pereseosed": "list", "episoodid": "list", "tahvlikirje": "object"}


def republish_batch(person: DataFrame, last: str | None, new: str, n: int) -> DataFrame:
    """The n persons of a window that were changed first."""
    return oldest(changed_between(person, last, new), n)


def document_changes(
    person: DataFrame, deleted: str = "_deleted", null_deletes: bool = True, now=None
) -> DataFrame:
    """Documents with their change time and the mark of a tombstone."""
    rows = export_projection(person, keep=["updated"])
    return to_document(rows, now, keep=["updated"]).withColumn(
        deleted, fn.tombstone(F.col("kirje"), null_deletes)
    )


def export_documents(rows: DataFrame, deleted: str = "_deleted", null_deletes: bool = True):
    """Documents of a stream of exports, ordered by the time of their export."""
    return to_document(rows, keep=["stamp"]).withColumn(
        deleted, fn.tombstone(F.col("kirje"), null_deletes)
    )


def run_increment(
    person: DataFrame,
    target: Target,
    overlap: int = 0,
    null_deletes: bool = True,
    mode: str = "update",
    first_mark: str | None = None,
) -> Outcome:
    """Bring the document table up to the newest change.

    The mark is kept with the target and moves only when the merge is done. Nothing is written
    when the mark has not moved; an unreadable mark is an error. A window can only
    update a table, never replace it.

    The source is read twice: its newest change, then the window, which is kept. That pass
    counts the account, and changes and failures are those of the kept rows, whatever the source
    does meanwhile.
    """
    row = current(person.sparkSession, target)
    last = row.mark if row is not None else first_mark
    if mode != "update" and last is not None:
        raise ValueError("a change window must not replace the whole table")
    new = high_water(person).select(F.col("ts").cast("string")).collect()[0][0]
    if new is None:
        raise RuntimeError("the source has no change time")
    if new == last:
        return Outcome("no news", last, new, None)
    account = Account()
    judged = with_result(changed_between(person, last, new, overlap=overlap), null_deletes)
    counted = account.counted(judged, F.col("status"), F.col("reason"))
    window = settle(counted.select(*person.columns))
    changes = document_changes(window, target.deleted, null_deletes)
    # without an overlap the window is newer than all the table holds
    written = publish(changes, target, mode, mark=new, late=overlap > 0)
    failures = json_failures(window, list(KINDS))
    rows = account.rows(person.sparkSession)
    return Outcome("published", last, new, written, rows, failures, wrong_kinds(window, KINDS))
