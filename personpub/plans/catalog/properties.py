"""Entity properties and their synchronisation."""

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators import properties as pr
from personpub.operators.bitmaps import find_entities, store_properties
from personpub.operators.merge import upsert
from personpub.plans.catalog.registry import case
from personpub.plans.sync import run_sync, sync_targets
from personpub.schemas import FLAGS, JSON_LISTS, NAMES_ENG, NAMES_EST
from personpub.session import kept, scratch
from personpub.sources.bindings import load
from personpub.sources.targets import publish, read_target

TYPE_REF, PARENT_REF = "type-person", "folder-published"


def properties_sql(
    names: dict[str, str], explode: bool, view: str = "v_judged_json", lists: bool = False
) -> str:
    """One select per property of the mapping; `lists` come from cells or from their own table."""

    def part(pos: int, name: str, kind: str, value: str, where: str, item: str = "0") -> str:
        values = {
            "string": f"cast({value} as varchar), cast(null as boolean), cast(null as varchar)",
            "boolean": f"cast(null as varchar), {value}, cast(null as varchar)",
            "reference": f"cast(null as varchar), cast(null as boolean), {value}",
        }[kind]
        return (
            f"select persoon as entity_key, cast({pos} as integer) as pos,"
            f" cast({item} as bigint) as item, '{name}' as type, '{kind}' as value_kind,"
            f" {', '.join(f'{v} as {n}' for v, n in zip(_split(values), _VALUES))}"
            f" from {where}"
        )

    _VALUES = ("string_value", "boolean_value", "reference_value")

    def _split(values: str) -> list[str]:
        found, depth, start = [], 0, 0
        for i, ch in enumerate(values):
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 0:
                found.append(values[start:i])
                start = i + 1
        return [*found, values[start:]]

    live = f"{view} where outcome = 'published'"
    parts = [
        part(0, "_type", "reference", f"'{TYPE_REF}'", f"{view} where outcome <> 'rejected'"),
        part(1, "persoon", "string", "persoon", f"{view} where outcome <> 'rejected'"),
        part(2, "redirect", "string", "redirect", f"{view} where outcome = 'redirected'"),
        part(len(names) + 3, "_parent", "reference", f"'{PARENT_REF}'", live),
    ]
    for pos, (column, name) in enumerate(names.items(), start=3):
        if column in FLAGS:
            parts.append(part(pos, name, "boolean", "true", f"{live} and {column}"))
        elif column in JSON_LISTS and lists:
            rows = (
                f"(select l.persoon, l.element, coalesce(try_cast(left(l.code, 10) as bigint), 0) as i"
                f" from v_list l join {view} j on j.persoon = l.persoon"
                f" where j.outcome = 'published' and l.list = '{column}')"
            )
            parts.append(part(pos, name, "string", "element", rows, "i"))
        elif column in JSON_LISTS and explode:
            rows = (
                f"(select persoon, {column}, unnest(range("
                f"cast(json_array_length({column}) as bigint))) as i"
                f" from {live} and json_valid({column}) and json_type({column}) = 'ARRAY')"
            )
            parts.append(
                part(pos, name, "string", f"{column} ->> ('$[' || i || ']')", rows, "i")
            )
        else:
            empty = {"tahvlikirje": "'', '{}'", "pereseosed": "'', '[]'", "episoodid": "'', '[]'"}
            where = f"{live} and cast({column} as varchar) not in ({empty.get(column, chr(39) * 2)})"
            parts.append(part(pos, name, "string", f"cast({column} as varchar)", where))
    return " union all ".join(parts)


def est(spark, sf_dir):
    person, lists = load(spark, sf_dir, "v_person"), load(spark, sf_dir, "v_list")
    return pr.to_properties(person, NAMES_EST, TYPE_REF, PARENT_REF, lists)


EST = properties_sql(NAMES_EST, explode=True, view="v_judged", lists=True)
PLAIN = properties_sql(NAMES_EST, explode=True, view="v_judged")


def plain(spark, sf_dir):
    person = load(spark, sf_dir, "v_person")
    return pr.to_properties(person, NAMES_EST, TYPE_REF, PARENT_REF)


@case(EST)
def properties_est(spark, sf_dir):
    return est(spark, sf_dir)


@case(properties_sql(NAMES_EST, explode=True))
def properties_in_cells(spark, sf_dir):
    person = load(spark, sf_dir, "v_person_json")
    return pr.to_properties(person, NAMES_EST, TYPE_REF, PARENT_REF)


@case(
    """select persoon, code, '{\n  "kirjekood": "' || code || '"\n}' as element,
              '{\n  "list": [\n    {\n      "kirjekood": "' || code
              || '"\n    },\n    {},\n    1\n  ],\n  "empty": []\n}' as deep
       from v_list where list = 'kirjed'"""
)
def pretty_elements(spark, sf_dir):
    rows = load(spark, sf_dir, "v_list").filter("list = 'kirjed'")
    deep = F.concat(F.lit('{"list":['), "element", F.lit(',{},1],"empty":[]}'))
    return rows.select("persoon", "code", fn.pretty(F.col("element")).alias("element"), fn.pretty(deep).alias("deep"))


@case(properties_sql(NAMES_ENG, explode=False))
def properties_eng(spark, sf_dir):
    person = load(spark, sf_dir, "v_person_json")
    return pr.to_properties(person, NAMES_ENG, TYPE_REF, PARENT_REF, explode=False)


@case(f"select * from ({PLAIN}) where type in ('persoon', 'redirect')")
def entity_select(spark, sf_dir):
    return pr.entity_select(plain(spark, sf_dir), ["persoon", "redirect"])


@case(
    f"""select entity_key from ({PLAIN}) group by entity_key
        having bool_or(type = '_type' and reference_value = '{TYPE_REF}')
           and bool_or(type = 'perenimi' and string_value = 'BUILDING')
           and bool_or(type = 'kivi' and boolean_value)
           and not bool_or(type = 'eesnimi' and string_value <> '')"""
)
def entity_find(spark, sf_dir):
    wanted = {"_type": TYPE_REF, "perenimi": "BUILDING", "kivi": "true", "eesnimi": ""}
    props = plain(spark, sf_dir)
    return find_entities(kept(spark, f"properties {sf_dir}", lambda path: store_properties(props, path)), wanted)


@case(
    """select entu_id as entity_key, cast(0 as integer) as pos, cast(0 as bigint) as item,
              '_inheritrights' as type, 'boolean' as value_kind,
              cast(null as varchar) as string_value, true as boolean_value,
              cast(null as varchar) as reference_value
       from v_sync where sync_ts is null"""
)
def patch_properties(spark, sf_dir):
    return pr.patch_properties(load(spark, sf_dir, "v_sync"), "_inheritrights", True)


_NOW = "timestamp '2024-03-01 00:00:00'"
_BATCH = """(select j.*, s.entu_id from v_judged j left join v_sync s on s.persoon = j.persoon
             where s.sync_ts is null)"""


def _step(spark, sf_dir):
    return pr.sync_step(
        load(spark, sf_dir, "v_person"),
        load(spark, sf_dir, "v_sync"),
        NAMES_EST,
        TYPE_REF,
        PARENT_REF,
        F.expr("timestamp_ntz'2024-03-01 00:00:00'"),
        n=None,
    )


@case(
    """select j.persoon, j.updated from v_judged j left join v_sync s on s.persoon = j.persoon
       where s.sync_ts is null order by j.updated, j.persoon limit 50"""
)
def sync_batch(spark, sf_dir):
    """A run of a given size takes the persons changed first."""
    step = pr.sync_step(
        load(spark, sf_dir, "v_person"), load(spark, sf_dir, "v_sync"), NAMES_EST, TYPE_REF,
        PARENT_REF, F.current_timestamp(), n=50,
    )
    return step.batch.select("persoon", "updated")


_STATE = f"""select persoon, coalesce(entu_id, md5(persoon)) as entu_id, {_NOW} as sync_ts
             from {_BATCH} where outcome <> 'rejected'
             union all
             select * from v_sync where persoon not in
                 (select persoon from {_BATCH} where outcome <> 'rejected')"""


@case(_STATE)
def sync_state(spark, sf_dir):
    sync = load(spark, sf_dir, "v_sync")
    return upsert(sync, _step(spark, sf_dir).done, "persoon")


@case(f"select persoon, reject_reason, updated from {_BATCH} where outcome = 'rejected'")
def sync_rejects(spark, sf_dir):
    return _step(spark, sf_dir).rejects


@case(f"select * from ({PLAIN}) where entity_key in (select persoon from {_BATCH})")
def sync_properties(spark, sf_dir):
    batch = _step(spark, sf_dir).batch
    return pr.to_properties(batch, NAMES_EST, TYPE_REF, PARENT_REF)


def _run(spark, sf_dir):
    """A persisted run over the pending persons of a stored sync table."""
    entities, state, rejects = sync_targets(scratch(spark, "sync"))
    publish(load(spark, sf_dir, "v_sync"), state, "recreate")
    account = run_sync(
        load(spark, sf_dir, "v_person"), entities, state, rejects, NAMES_EST, TYPE_REF,
        PARENT_REF, F.expr("timestamp_ntz'2024-03-01 00:00:00'"), None, cells=False,
    )
    return entities, state, account


@case(_STATE)
def sync_run_state(spark, sf_dir):
    return read_target(spark, _run(spark, sf_dir)[1])


@case(f"select * from ({EST}) where entity_key in (select persoon from {_BATCH})")
def sync_run_properties(spark, sf_dir):
    entities = read_target(spark, _run(spark, sf_dir)[0])
    return pr.unfold(entities, load(spark, sf_dir, "v_list"), NAMES_EST)


@case(
    f"""select case when outcome = 'rejected' then 'failed' else 'indexed' end as status,
               reject_reason as reason, count(*) as n
        from {_BATCH} group by all"""
)
def sync_account(spark, sf_dir):
    return _run(spark, sf_dir)[2].account
