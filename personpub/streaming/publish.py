"""The continuous form: micro-batches merged by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from personpub.operators.stats import Account
from personpub.session import settle
from personpub.sources.targets import Target, publish


def stream_publish(
    stream: DataFrame,
    target: Target,
    checkpoint: str,
    name: str,
    order: list[str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    account: str | None = None,
) -> StreamingQuery:
    """Merge what has arrived, batch by batch, then stop.

    A batch may be run again after a failure; the target knows its number together with its
    data, so it is merged once. With the path `account` each batch leaves its counts of
    indexed and deleted rows there, one directory per batch; its rows are then kept
    first, by a pass that counts them.
    """

    def merge(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        done = Account(())
        if account is not None:
            gone = F.col(target.deleted) if target.deleted in rows.columns else F.lit(False)
            status = F.when(gone, F.lit("deleted")).otherwise(F.lit("indexed"))
            rows = settle(done.counted(rows, status, F.lit(None).cast("string")))
        publish(rows, target, "update", batch=f"{name}:{number}", order=order)
        if account is not None:
            done.rows(batch.sparkSession).write.mode("overwrite").parquet(f"{account}/batch={number}")

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
