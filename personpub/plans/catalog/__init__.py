"""All registered queries."""

from personpub.plans.catalog import (  # noqa: F401
    collated,
    deltas,
    filters,
    increments,
    joins,
    merges,
    projections,
    properties,
    runs,
    scans,
    search,
    statistics,
)
from personpub.plans.catalog.registry import CASES

__all__ = ["CASES"]
