"""The daily run: statistics, then snapshots of the source tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from personpub.operators.stats import statistics
from personpub.sources.outputs import append_statistics, snapshot


def backup(
    record: DataFrame,
    person: DataFrame,
    register: DataFrame,
    tables: dict[str, DataFrame],
    root: str,
    run: datetime,
) -> dict[str, str]:
    """Add a statistics row and copy the named tables; returns their paths."""
    append_statistics(statistics(record, person, register), f"{root}/statistics")
    return {name: snapshot(df, root, name, run) for name, df in tables.items()}
