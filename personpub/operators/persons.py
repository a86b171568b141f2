"""Selecting, checking, completing and projecting persons."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators.joins import lookup
from personpub.operators.lists import list_rows, with_owners
from personpub.schemas import DEFAULTS, FLAGS, LAYOUTS, WIDTHS
from personpub.session import settle

# -- filters ---------------------------------------------------------------


def representatives(record: DataFrame, numbered: bool = True) -> DataFrame:
    """Records that stand for their person."""
    found = record.filter(F.col("persoon") == F.col("kirjekood"))
    return found.filter(fn.number(F.col("persoon")) > 0) if numbered else found


def live(person: DataFrame) -> DataFrame:
    return person.filter((fn.number(F.col("persoon")) > 0) & (F.col("redirect") == ""))


def birth_unknown(person: DataFrame) -> DataFrame:
    return person.filter(F.col("synd") == "")


def missing_text(record: DataFrame) -> DataFrame:
    return record.filter(F.col("kirje").isNull())


def empty_names(person: DataFrame) -> DataFrame:
    return person.filter(
        (F.coalesce("perenimi", F.lit("")) == "") & (F.coalesce("eesnimi", F.lit("")) == "")
    )


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


#: why a person is rejected, first reason first
REASONS = ("no code", "no text", "no letter in text", "no name")


def classify(person: DataFrame, letters: str = fn.LETTERS) -> DataFrame:
    """Add `outcome` (published, redirected, rejected) and `reject_reason`."""
    reason = (
        F.when(~_filled("persoon"), F.lit(REASONS[0]))
        .when(_filled("redirect"), F.lit(None))
        .when(~_filled("kirje"), F.lit(REASONS[1]))
        .when(~fn.has_letter(F.col("kirje"), letters), F.lit(REASONS[2]))
        .when(~_filled("eesnimi") & ~_filled("perenimi"), F.lit(REASONS[3]))
    )
    outcome = (
        F.when(F.col("reject_reason").isNotNull(), F.lit("rejected"))
        .when(_filled("redirect"), F.lit("redirected"))
        .otherwise(F.lit("published"))
    )
    return person.withColumn("reject_reason", reason).withColumn("outcome", outcome)


def split_publishable(person: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(published and redirected, rejected)"""
    judged = classify(person)
    rejected = F.col("outcome") == "rejected"
    return judged.filter(~rejected), judged.filter(rejected)


def json_valid_split(person: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose JSON columns all parse, the others)"""
    valid = F.lit(True)
    for c in columns:
        valid = valid & fn.is_json(F.col(c))
    marked = person.withColumn("_valid", valid)
    return (
        marked.filter("_valid").drop("_valid"),
        marked.filter("not _valid").drop("_valid"),
    )


def json_failures(person: DataFrame, columns: list[str]) -> DataFrame:
    """One row (persoon, field, text) per JSON cell that does not parse."""
    checks = F.array(
        *[
            F.when(
                ~fn.is_json(F.col(c)),
                F.struct(F.lit(c).alias("field"), F.col(c).alias("text")),
            )
            for c in columns
        ]
    )
    failed = F.filter(checks, lambda x: x.isNotNull())
    return person.select("persoon", F.inline(failed))


def wrong_kinds(person: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """One row (persoon, field, text) per JSON cell that parses but is not of its kind,
    `list` or `object`; such a cell becomes null in a document."""

    def wrong(c: str, kind: str) -> Column:
        start = r"^\s*\[" if kind == "list" else r"^\s*\{"
        return F.col(c).isNotNull() & fn.is_json(F.col(c)) & ~F.col(c).rlike(start)

    checks = F.array(
        *[
            F.when(wrong(c, kind), F.struct(F.lit(c).alias("field"), F.col(c).alias("text")))
            for c, kind in kinds.items()
        ]
    )
    return person.select("persoon", F.inline(F.filter(checks, lambda x: x.isNotNull())))


# -- projections -----------------------------------------------------------


def export_projection(
    person: DataFrame, layout: str = "v2", keep: list[str] = ()
) -> DataFrame:
    """The named columns of an export file: dates cut to 10, flags as 1 and 0."""

    def value(c: str) -> Column:
        if c in FLAGS:
            return fn.bit(F.col(c)).alias(c)
        if c in ("synd", "surm"):
            return fn.first_chars(F.col(c), 10).alias(c)
        return F.col(c)

    return person.select(*[value(c) for c in LAYOUTS[layout]], *keep)


def fill_defaults(person: DataFrame) -> DataFrame:
    present = {c: v for c, v in DEFAULTS.items() if c in person.columns}
    flags = {c: False for c in FLAGS if c in person.columns}
    return person.na.fill({**present, **flags})


def fit_widths(person: DataFrame) -> DataFrame:
    """Cut texts to their declared widths."""
    return person.withColumns(
        {c: fn.first_chars(F.col(c), n) for c, n in WIDTHS.items() if c in person.columns}
    )


def cut_report(person: DataFrame) -> DataFrame:
    """One row (persoon, field, length) per text longer than its column."""
    checks = F.array(
        *[
            F.when(
                F.length(c) > n, F.struct(F.lit(c).alias("field"), F.length(c).alias("length"))
            )
            for c, n in WIDTHS.items()
            if c in person.columns
        ]
    )
    cut = F.filter(checks, lambda x: x.isNotNull())
    return person.select("persoon", F.inline(cut))


# -- record text -----------------------------------------------------------


def person_text() -> Column:
    """A record text made of names, parents, dates and places, as far as known."""
    return F.concat_ws(
        ", ",
        fn.absent(F.col("perenimi")),
        fn.absent(F.col("eesnimi")),
        fn.absent(F.col("isanimi")),
        fn.absent(F.col("emanimi")),
        fn.absent(F.col("synd")),
        fn.absent(F.col("synnikoht")),
        fn.absent(F.col("surm")),
        fn.absent(F.col("surmakoht")),
    )


def repair_text(record: DataFrame) -> DataFrame:
    """Compose missing texts, then put every text on one line."""
    text = F.coalesce(F.col("kirje"), person_text())
    return record.withColumn("kirje", fn.one_line(text))


# -- joins -----------------------------------------------------------------


def enrich_text(person: DataFrame, evo: DataFrame) -> DataFrame:
    """Text of the side list for flagged persons; the smallest of several."""
    texts = evo.groupBy("persoon").agg(F.min("kirje").alias("_text"))
    return (
        person.join(texts, "persoon", "left")
        .withColumn(
            "evokirje",
            F.when(F.col("evo") & F.col("_text").isNotNull(), F.col("_text")).otherwise(
                F.col("evokirje")
            ),
        )
        .drop("_text")
    )


def resolve_person(stone: DataFrame, record: DataFrame) -> DataFrame:
    """Person of each plate's record, null when there is no such record."""
    codes = record.select("kirjekood", F.col("persoon").alias("_persoon"))
    return (
        stone.join(codes, "kirjekood", "left")
        .withColumn("persoon", F.col("_persoon"))
        .drop("_persoon")
    )


def in_register(person: DataFrame, register: DataFrame) -> DataFrame:
    """Repeats in the register are folded before they are shuffled."""
    return person.join(distinct_keys(register), "persoon", "left_semi")


def distinct_keys(register: DataFrame) -> DataFrame:
    return register.select("persoon").distinct()


def prune_orphans(person: DataFrame, record: DataFrame) -> DataFrame:
    codes = record.select(F.col("kirjekood").alias("persoon"))
    return person.join(codes, "persoon", "left_semi")


def rekey(person: DataFrame, code_changes: DataFrame) -> DataFrame:
    """Put new codes for old: `code_changes` has one row (old, new) per code, see `resolve_codes`."""
    return (
        person.join(code_changes, F.col("persoon") == F.col("old"), "left")
        .withColumn("persoon", F.coalesce("new", "persoon"))
        .drop("old", "new")
    )


class Resolved(NamedTuple):
    """Codes with the one they end at, and changes that end nowhere, with the reason."""

    changes: DataFrame
    rejects: DataFrame


def resolve_codes(code_changes: DataFrame) -> Resolved:
    """Follow chains of changed codes (old, new) to their ends: a to b and b to c is a to c.

    Each round doubles the steps taken, so a chain of n changes needs about log2(n) rounds. Codes
    in a circle, or on the way into one, never end: once a round brings no code to its end,
    they are what is left. A code that is changed into two others is rejected too, and so is what
    leads to it. A change of a code into itself is none.
    """
    moves = code_changes.filter("old <> new").select("old", "new").distinct()
    moves = moves.groupBy("old").agg(F.min("new").alias("new"), (F.count(F.lit(1)) > 1).alias("torn"))
    first = now = settle(moves.select("old", "new", "torn"))
    left = -1
    while True:
        ahead = now.select(F.col("old").alias("_at"), F.col("new").alias("_next"), F.col("torn").alias("_torn"))
        now = settle(
            now.join(ahead, now["new"] == ahead["_at"], "left").select(
                "old",
                F.coalesce("_next", "new").alias("new"),
                (F.col("torn") | F.coalesce("_torn", F.lit(False))).alias("torn"),
                F.col("_at").isNotNull().alias("open"),
            )
        )
        still = now.filter("open").count()
        if still == left:
            break
        left = still
    reason = F.when(F.col("torn"), F.lit("several codes")).otherwise(F.lit("circle"))
    bad = now.filter("open OR torn").select("old", reason.alias("reason"))
    rejects = first.select("old", "new").join(bad, "old").select("old", "new", "reason")
    return Resolved(now.filter("NOT open AND NOT torn").select("old", "new"), rejects)


def records_json(record: DataFrame) -> DataFrame:
    """The record list of every person, see `lists`."""
    element = F.to_json(F.struct("kirjekood"))
    return list_rows(record, "persoon", "kirjekood", element, "kirjed")


def attach_records(person: DataFrame, record: DataFrame) -> DataFrame:
    """Rows (persoon, code, element): the records of the given persons."""
    return with_owners(person, records_json(record), "persoon")


def attach_plate(person: DataFrame, stone: DataFrame) -> DataFrame:
    """Plate of flagged persons, `{}` when there is none; the smallest of several."""
    plates = (
        stone.filter(F.col("persoon").isNotNull())
        .groupBy("persoon")
        .agg(F.min("kirjekood").alias("kirjekood"))
        .select("persoon", F.to_json(F.struct("kirjekood")).alias("_plate"))
    )
    return (
        person.join(plates, "persoon", "left")
        .withColumn(
            "tahvlikirje",
            F.when(F.col("kivi"), F.coalesce("_plate", F.lit("{}"))).otherwise(
                F.col("tahvlikirje")
            ),
        )
        .drop("_plate")
    )


def relations_json(person: DataFrame, relation: DataFrame) -> DataFrame:
    """Per person the list of related persons with kind and name, see `lists`.

    A person may stand in several kinds of relation to another; the code says which.
    """
    names = person.select(
        F.col("persoon").alias("other"),
        fn.full_name(F.col("eesnimi"), F.col("perenimi")).alias("nimi"),
    )
    pairs = relation.select("persoon", "other", "kind").distinct()
    named = lookup(pairs, names, "other", "inner").withColumn(
        "_code", F.concat_ws("/", "other", "kind")
    )
    element = F.to_json(F.struct(F.col("other").alias("persoon"), F.col("kind"), F.col("nimi")))
    return list_rows(named, "persoon", "_code", element, "pereseosed")


def attach_relations(
    person: DataFrame, relation: DataFrame, keys: DataFrame | None = None
) -> DataFrame:
    """Rows (persoon, code, element): the families of all persons, or of those in `keys`."""
    if keys is None:
        return with_owners(person, relations_json(person, relation), "persoon")
    wanted = keys.select("persoon").distinct()
    chosen = relation.join(wanted, "persoon", "left_semi")
    return with_owners(wanted, relations_json(person, chosen), "persoon")
