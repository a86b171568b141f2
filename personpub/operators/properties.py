"""Entities as rows of properties, and their synchronisation."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators.joins import lookup
from personpub.operators.paging import first_rows
from personpub.operators.persons import split_publishable
from personpub.schemas import FLAGS, JSON_LISTS
from personpub.session import settle

PROPERTY = (
    "struct<pos:int,item:bigint,type:string,value_kind:string,"
    "string_value:string,boolean_value:boolean,reference_value:string>"
)
EMPTY = {"tahvlikirje": ("", "{}"), "pereseosed": ("", "[]"), "episoodid": ("", "[]")}


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _property(pos: int, name: str, kind: str, value: str, item: str = "0") -> str:
    """One property as an SQL struct; `value` is an SQL expression."""
    texts = {k: value if k == kind else "null" for k in ("string", "boolean", "reference")}
    return (
        f"named_struct('pos', {pos}, 'item', cast({item} as bigint), 'type', {_text(name)},"
        f" 'value_kind', '{kind}', 'string_value', cast({texts['string']} as string),"
        f" 'boolean_value', cast({texts['boolean']} as boolean),"
        f" 'reference_value', cast({texts['reference']} as string))"
    )


def _when(condition: str, value: str) -> str:
    return f"case when {condition} then {value} end"


def _entities(
    person: DataFrame,
    names: dict[str, str],
    type_ref: str,
    parent_ref: str,
    explode: bool = True,
    indent: bool = False,
    cells: bool = True,
) -> tuple[DataFrame, str]:
    """The publishable persons, and the SQL array of a person's properties.

    Without `cells` the list columns are left out: the lists are rows of their own, see
    `list_properties`.

    Empty values give no property. `pos` is the place of the property in the
    mapping, `item` the place of a list element in its list; with `indent` an
    element has one field per line. A redirected person has its type, code and
    redirect only, and no parent.
    """
    good, _ = split_publishable(person)
    live = "outcome = 'published'"
    single = [
        _property(0, "_type", "reference", _text(type_ref)),
        _property(1, "persoon", "string", "persoon"),
        _when("outcome = 'redirected'", _property(2, "redirect", "string", "redirect")),
        _when(live, _property(len(names) + 3, "_parent", "reference", _text(parent_ref))),
    ]
    lists, repeated = {}, []
    for pos, (column, name) in enumerate(names.items(), start=3):
        if column not in person.columns or (column in JSON_LISTS and not cells):
            continue
        if column in FLAGS:
            value = _property(pos, name, "boolean", "true")
            single.append(_when(f"{live} and {column}", value))
        elif column in JSON_LISTS and explode:
            elements = fn.elements(F.col(column))
            lists[f"_{column}"] = F.transform(elements, fn.pretty) if indent else elements
            value = _property(pos, name, "string", "x", "i")
            found = _when(live, f"transform(_{column}, (x, i) -> {value})")
            repeated.append(f"coalesce({found}, cast(array() as array<{PROPERTY}>))")
        else:
            empties = ", ".join(_text(e) for e in EMPTY.get(column, ("",)))
            value = _property(pos, name, "string", column)
            single.append(
                _when(f"{live} and cast({column} as string) not in ({empties})", value)
            )
    present = f"filter(array({', '.join(single)}), p -> p is not null)"
    return good.withColumns(lists), f"concat({', '.join([present, *repeated])})"


def to_properties(
    person: DataFrame,
    names: dict[str, str],
    type_ref: str,
    parent_ref: str,
    lists: DataFrame | None = None,
    indent: bool = False,
    **options: bool,
) -> DataFrame:
    """Property rows of publishable persons.

    One array per row is built and unfolded once. With `lists` the elements come from that
    table instead of the persons' cells.
    """
    good, array = _entities(
        person, names, type_ref, parent_ref, indent=indent, cells=lists is None, **options
    )
    rows = good.selectExpr("persoon as entity_key", f"inline({array})")
    if lists is None:
        return rows
    published = good.filter("outcome = 'published'").select("persoon")
    return rows.unionByName(list_properties(published, lists, names, indent))


def list_properties(
    owners: DataFrame, lists: DataFrame, names: dict[str, str], indent: bool = False
) -> DataFrame:
    """A property row per list element of the owners (persoon); `item` is the number in
    the element's code, which orders the list."""
    element = fn.pretty(F.col("element")) if indent else F.col("element")
    item = fn.number(fn.first_chars(F.col("code"), 10))
    rows = lookup(lists, owners, "persoon", "inner").select(
        "persoon", "list", F.coalesce(item, F.lit(0)).alias("i"), element.alias("x")
    )
    wanted = [(pos, c, n) for pos, (c, n) in enumerate(names.items(), start=3) if c in JSON_LISTS]
    found = [
        _when(f"list = {_text(column)}", _property(pos, name, "string", "x", "i"))
        for pos, column, name in wanted
    ]
    kept = rows.filter(F.col("list").isin([c for _, c, _ in wanted]))
    return kept.selectExpr("persoon as entity_key", f"inline(array(coalesce({', '.join(found)})))")


def to_entities(
    person: DataFrame, names: dict[str, str], type_ref: str, parent_ref: str, **options: bool
) -> DataFrame:
    """One row per publishable person with the array of its properties, for keeping."""
    good, array = _entities(person, names, type_ref, parent_ref, **options)
    return good.selectExpr("persoon as entity_key", f"{array} as properties", "updated")


def unfold(
    entities: DataFrame,
    lists: DataFrame | None = None,
    names: dict[str, str] | None = None,
    indent: bool = False,
) -> DataFrame:
    """Property rows of stored entities, with those of the lists kept beside them."""
    rows = entities.selectExpr("entity_key", "inline(properties)")
    if lists is None:
        return rows
    published = entities.filter("exists(properties, p -> p.type = '_parent')")
    owners = published.select(F.col("entity_key").alias("persoon"))
    return rows.unionByName(list_properties(owners, lists, names, indent))


def entity_select(props: DataFrame, types: list[str]) -> DataFrame:
    return props.filter(F.col("type").isin(types))


def _value() -> Column:
    return F.coalesce("string_value", "reference_value", F.col("boolean_value").cast("string"))


def entity_find(props: DataFrame, conditions: dict[str, str]) -> DataFrame:
    """Entities having every given property value; '' means the property is empty.

    Only rows of the named properties, or the one `_type` row every entity has,
    are shuffled, folded to one row per entity and task before.
    """
    rows = props.filter(F.col("type").isin("_type", *conditions))
    tests = []
    for i, (name, value) in enumerate(conditions.items()):
        of_type = F.col("type") == name
        if value == "":
            tests.append((f"_c{i}", ~F.bool_or(of_type & (_value() != ""))))
        else:
            tests.append((f"_c{i}", F.bool_or(of_type & (_value() == value))))
    met = reduce(lambda a, b: a & b, [F.coalesce(F.col(n), F.lit(False)) for n, _ in tests])
    return (
        rows.groupBy("entity_key")
        .agg(*[t.alias(n) for n, t in tests])
        .filter(met)
        .select("entity_key")
    )


def patch_properties(pending_sync: DataFrame, name: str, value: bool) -> DataFrame:
    """The same property for every pending entity."""
    constant = _property(0, name, "boolean", str(value).lower())
    return pending_sync.filter(F.col("sync_ts").isNull()).selectExpr(
        "entu_id as entity_key", f"inline(array({constant}))"
    )


class SyncStep(NamedTuple):
    """What one run gives: entities, their new sync rows, and rejected persons."""

    batch: DataFrame
    entities: DataFrame
    done: DataFrame
    rejects: DataFrame


def pending(
    person: DataFrame, sync: DataFrame, rejects: DataFrame | None = None
) -> DataFrame:
    """Persons never synchronised, or marked to be synchronised again.

    A person rejected before comes back only once changed after that.
    """
    found = person.join(
        sync.select("persoon", "entu_id", "sync_ts"), "persoon", "left"
    ).filter(F.col("sync_ts").isNull())
    if rejects is None:
        return found
    seen = rejects.groupBy("persoon").agg(F.max("updated").alias("_seen"))
    unchanged = F.col("_seen").isNotNull() & (F.col("updated") <= F.col("_seen"))
    return found.join(seen, "persoon", "left").filter(~unchanged).drop("_seen")


def synced_rows(sync: DataFrame, batch: DataFrame) -> DataFrame:
    return sync.join(batch.select("persoon"), "persoon", "left_semi")


def sync_step(
    person: DataFrame,
    sync: DataFrame,
    names: dict[str, str],
    type_ref: str,
    parent_ref: str,
    now: Column,
    n: int | None,
    rejects: DataFrame | None = None,
    **options: bool,
) -> SyncStep:
    """One run over the n pending persons that were changed first, or over all for None.

    `options` are those of the properties (`indent`, `cells`, `explode`). A known entity id is kept. Rejected persons are given with the reason and,
    passed in again as `rejects`, leave the pending set until they change.
    """
    found = first_rows(pending(person, sync, rejects), ["updated", "persoon"], n)
    batch = settle(found.repartition("persoon"))
    good, bad = split_publishable(batch)
    done = good.select(
        "persoon",
        F.coalesce("entu_id", F.md5("persoon")).alias("entu_id"),
        now.alias("sync_ts"),
    )
    return SyncStep(
        batch,
        to_entities(batch, names, type_ref, parent_ref, **options),
        done,
        bad.select("persoon", "reject_reason", "updated"),
    )
