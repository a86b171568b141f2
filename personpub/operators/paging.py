"""First rows, pages and exact order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personpub.operators.ranks import OrderedTable


def first_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first n rows by a total order, in that order; all rows, unsorted, for None.

    Each task keeps its own first n, so what meets in one place are those.
    """
    return df if n is None else df.orderBy(*order).limit(n)


def head_rows(df: DataFrame, n: int | None, key: str) -> DataFrame:
    return first_rows(df, [key], n)


def oldest(df: DataFrame, n: int | None) -> DataFrame:
    return first_rows(df, ["updated", "persoon"], n)


def page(df: DataFrame, order: list[str | Column], size: int, offset: int = 0) -> DataFrame:
    """For the first pages; go deep with `page_after`."""
    return df.orderBy(*order).offset(offset).limit(size)


def page_after(df: DataFrame, order: str, last: str | int | None, size: int) -> DataFrame:
    """The page after the given key; the skipped rows are not read in order."""
    rest = df if last is None else df.filter(F.col(order) > F.lit(last))
    return rest.orderBy(order).limit(size)


def sort_exact(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


def skip_to(table: OrderedTable, size: int, offset: int) -> DataFrame:
    """A deep page by number: rows offset+1 to offset+size of a table kept in order."""
    return table.page(size, offset)
