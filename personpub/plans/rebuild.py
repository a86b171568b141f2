"""The full rebuild of the person table as one lazy plan."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personpub.operators.persons import (
    attach_plate,
    cut_report,
    enrich_text,
    fill_defaults,
    fit_widths,
    json_failures,
    records_json,
    relations_json,
    representatives,
    resolve_person,
)
from personpub.schemas import DEFAULTS, FLAGS, PERSON_COLUMNS

# List flags of a source record and the person's columns they fill.
RECORD_FLAGS = {
    "pub_isperson": "isperson",
    "pub_emem": "emem",
    "pub_kivi": "kivi",
    "pub_wwiiref": "wwiiref",
    "pub_evo": "evo",
    "pub_mv": "mv",
    "ylikoolis_oppinud": "ylikoolis_oppinud",
}


def person_rows(record: DataFrame, now: Column) -> DataFrame:
    """Representative records in the shape of the person table."""
    flags = {v: k for k, v in RECORD_FLAGS.items()}

    def column(c: str) -> Column:
        if c in FLAGS:
            source = flags[c]
            value = F.col(source) if source in record.columns else F.lit(None).cast("boolean")
        elif c == "updated":
            value = now
        elif c in record.columns:
            value = F.col(c)
        else:
            value = F.lit(DEFAULTS.get(c)).cast("string")
        return value.alias(c)

    found = representatives(record)  # one per person: record codes are unique
    return fill_defaults(found.select(*[column(c) for c in PERSON_COLUMNS]))


class Rebuilt(NamedTuple):
    """The person table, its lists by element, and what did not fit.

    `failures` are JSON cells that do not parse, `cuts` texts longer than their column.
    """

    persons: DataFrame
    lists: DataFrame
    failures: DataFrame
    cuts: DataFrame


def rebuild(
    record: DataFrame, evo: DataFrame, stone: DataFrame, relation: DataFrame, now: Column
) -> Rebuilt:
    """Names for the families come from the records themselves, before any enrichment."""
    wide = person_rows(record, now)
    found = fit_widths(wide)
    persons = attach_plate(enrich_text(found, evo), resolve_person(stone, record))
    lists = records_json(record).unionByName(relations_json(found, relation))
    lists = lists.join(found.select("persoon"), "persoon", "left_semi")
    return Rebuilt(persons, lists, json_failures(persons, ["tahvlikirje"]), cut_report(wide))
