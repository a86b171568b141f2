"""The change window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from personpub.functions import scalars as fn


def changed_between(
    df: DataFrame,
    last: datetime | str | None,
    new: datetime | str,
    lag: int = 1,
    overlap: int = 0,
    column: str = "updated",
) -> DataFrame:
    """Rows changed from `last` plus `lag` seconds up to `new`, both included.

    `overlap` reads that many seconds before again. Both bounds are constants
    of the column's own type, so they reach the file scan.
    """
    ts, kind = F.col(column), df.schema[column].dataType
    rows = df.filter(ts <= F.lit(str(new)).cast(kind))
    if last is None:
        return rows
    return rows.filter(ts >= fn.later(F.lit(str(last)).cast(kind), lag - overlap))
