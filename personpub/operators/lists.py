"""A person's lists as rows, one per element.

Whatever a person's share of the elements, no group grows with it: a list is a child
table (owner, list, code, element) that is joined, filtered and unfolded by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_rows(items: DataFrame, owner: str, code: str, element: Column, name: str) -> DataFrame:
    """Elements of the list `name`; their order in the list is that of their codes."""
    return items.select(
        owner, F.lit(name).alias("list"), F.col(code).alias("code"), element.alias("element")
    )


def with_owners(owners: DataFrame, lists: DataFrame, owner: str) -> DataFrame:
    """The elements of the given owners; one row without an element for an empty list."""
    rows = lists.select(F.xxhash64(owner).alias("_k"), F.col(owner).alias("_owner"), "code", "element")
    keys = owners.select(owner).withColumn("_k", F.xxhash64(owner))
    same = (keys["_k"] == rows["_k"]) & (keys[owner] == rows["_owner"])
    return keys.join(rows, same, "left").select(owner, "code", "element")


def cells(lists: DataFrame, owner: str, name: str) -> DataFrame:
    """The list `name` as one JSON text per owner, for files whose format has it in a cell.

    A cell is as long as its owner's list; only such files should need it.
    """
    items = F.sort_array(F.collect_list(F.struct("code", "element")))
    texts = F.transform("_items", lambda x: x["element"])
    return (
        lists.filter(F.col("list") == name)
        .groupBy(owner)
        .agg(items.alias("_items"))
        .select(owner, F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias(name))
    )
