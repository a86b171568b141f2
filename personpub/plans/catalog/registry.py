"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from personpub.plans.catalog.views import with_views

Query = Callable[[SparkSession, str], DataFrame]


class Case(NamedTuple):
    query: Query
    sql: str | None


CASES: dict[str, Case] = {}


def case(sql: str | None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if query.__name__ in CASES:
            raise ValueError(f"query {query.__name__} is registered twice")
        CASES[query.__name__] = Case(query, None if sql is None else with_views(sql))
        return query

    return add
