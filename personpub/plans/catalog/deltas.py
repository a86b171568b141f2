"""Results brought up to date from changes alone, against full recounts and rebuilds."""

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators import persons as p
from personpub.operators import stats as st
from personpub.plans.catalog.filters import LIVE
from personpub.plans.catalog.registry import case
from personpub.plans.catalog.views import code
from personpub.plans.dependants import dependants, list_target, publish_lists
from personpub.session import scratch, settle
from personpub.sources.bindings import code as code_of
from personpub.sources.bindings import load, table
from personpub.sources.targets import Target, publish, read_keys, read_target

_N = "cast(persoon as bigint)"
_AFTER = f"""(select * replace (
    case when {_N} % 10 = 3 then '0000000001' when {_N} % 8 = 5 then '' else redirect end as redirect,
    case when {_N} % 9 = 2 then not emem else emem end as emem,
    case when {_N} % 9 = 2 then not kivi else kivi end as kivi,
    case when {_N} % 9 = 4 then not wwiiref else wwiiref end as wwiiref,
    case when {_N} % 9 = 4 then '' else synd end as synd) from v_person where {_N} % 21 <> 0)"""


@case(
    f"""select (select count(*) from v_record where persoon = kirjekood
                and cast(kirjekood as bigint) % 50 <> 2) as isikuid_baasis,
               count(*) as isikuid_veebis, count(*) filter (where emem) as e_memoriaalil,
               count(*) filter (where kivi) as kivis, count(*) filter (where wwiiref) as pogenikke,
               count(*) filter (where wwiiref and persoon in (select persoon from v_register)) as prga_pogenikke,
               count(*) filter (where synd = '') as synd_teadmata
        from {_AFTER} where {LIVE}"""
)
def statistics_from_changes(spark, sf_dir):
    """A statistics row, then redirects, deletions and changed flags that bring it up to date."""
    record, person, register = (load(spark, sf_dir, v) for v in ("v_record", "v_person", "v_register"))
    target = Target(scratch(spark, "persons"), "persoon", "updated")
    publish(person, target, "recreate")
    row = settle(st.statistics(record, read_target(spark, target), register))
    n = F.col("persoon").cast("bigint")
    touched = person.filter((n % 21 == 0) | (n % 10 == 3) | (n % 8 == 5) | (n % 9).isin(2, 4))
    redirect = F.when(n % 10 == 3, F.lit("0000000001")).when(n % 8 == 5, F.lit("")).otherwise(F.col("redirect"))
    changes = touched.withColumns(
        {
            "redirect": redirect,
            "emem": F.when(n % 9 == 2, ~F.col("emem")).otherwise(F.col("emem")),
            "kivi": F.when(n % 9 == 2, ~F.col("kivi")).otherwise(F.col("kivi")),
            "wwiiref": F.when(n % 9 == 4, ~F.col("wwiiref")).otherwise(F.col("wwiiref")),
            "synd": F.when(n % 9 == 4, F.lit("")).otherwise(F.col("synd")),
            "updated": F.col("updated") + F.expr("interval 1 day"),
            target.deleted: n % 21 == 0,
        }
    )
    removed = record.filter(fn.number(F.col("kirjekood")) % 50 == 2)
    before = read_keys(spark, target, changes)
    after = changes.filter(~F.col(target.deleted)).drop(target.deleted)
    change = settle(st.statistics_change(before, after, register, removed, removed.limit(0)))
    publish(changes, target, "update")
    return st.add_statistics(row, change)


_RENAMED = f"""(select * replace (case when {_N} % 7 = 3 then 'RENAMED' else perenimi end as perenimi)
    from v_person where {_N} % 31 <> 0)"""
_RELATED = f"""(select persoon, other, kind from v_relation where {_N} % 12 <> 0
    union all select persoon, {code(_N + ' + 5')}, 'sibling' from v_person where {_N} % 10 = 0)"""
_FAMILIES = f"""select r.persoon, 'pereseosed' as list, r.other || '/' || r.kind as code,
        '{{"persoon":"' || r.other || '","kind":"' || r.kind || '","nimi":"' ||
        concat_ws(' ', nullif(o.eesnimi, ''), nullif(o.perenimi, '')) || '"}}' as element
    from {_RELATED} r join {_RENAMED} o on o.persoon = r.other
    where r.persoon in (select persoon from {_RENAMED})"""


def _relatives(spark, sf_dir):
    """Persons and their lists as kept, then names, persons and relations that change."""
    person = load(spark, sf_dir, "v_person").select("persoon", "eesnimi", "perenimi", "updated")
    relation = load(spark, sf_dir, "v_relation")
    persons = Target(scratch(spark, "persons"), "persoon", "updated")
    lists = list_target(scratch(spark, "lists"))
    publish(person, persons, "recreate")
    now = F.expr("timestamp_ntz'2024-03-01 00:00:00'")
    publish_lists(lists, p.relations_json(person, relation), None, now, "recreate")
    n = F.col("persoon").cast("bigint")
    changed = person.filter((n % 7 == 3) | (n % 31 == 0)).withColumns(
        {
            "perenimi": F.when(n % 7 == 3, F.lit("RENAMED")).otherwise(F.col("perenimi")),
            "updated": F.col("updated") + F.expr("interval 1 day"),
            persons.deleted: n % 31 == 0,
        }
    )
    publish(changed, persons, "update")
    removed = relation.filter(n % 12 == 0)
    added = person.filter(n % 10 == 0).select("persoon", code_of(n + 5).alias("other"), F.lit("sibling").alias("kind"))
    known = settle(relation.filter(n % 12 != 0).unionByName(added))
    return lists, dependants(persons, changed, known, added, removed), now


@case(_FAMILIES)
def relatives_republished(spark, sf_dir):
    """The lists after the change are those of a full rebuild."""
    lists, found, now = _relatives(spark, sf_dir)
    publish_lists(lists, found.rows, found.gone, now + F.expr("interval 1 day"))
    return read_target(spark, lists).select("persoon", "list", "code", "element")


@case(
    f"""select distinct persoon from (
            select r.persoon from {_RELATED} r where cast(r.other as bigint) % 7 = 3 or cast(r.other as bigint) % 31 = 0
                or {_N} % 7 = 3 or {_N} % 31 = 0
            union all select persoon from v_relation where {_N} % 12 = 0
            union all select persoon from v_person where {_N} % 10 = 0)"""
)
def relatives_touched(spark, sf_dir):
    """Persons that are published again because they or their relatives changed."""
    return _relatives(spark, sf_dir)[1].owners


_TO = """case when c_custkey % 10 in (1, 2, 3, 5, 6) then c_custkey + 1
              when c_custkey % 10 = 7 then c_custkey - 1 else c_custkey end"""
_STEPS = f"""with recursive moves as (
        select {code('c_custkey')} as old, {code(_TO)} as new from customer where c_custkey % 10 in (1, 2, 3, 5, 6, 7)),
    steps as (select old, new as spot, 1 as n from moves
        union all select s.old, m.new, n + 1 from steps s join moves m on m.old = s.spot where n < 12)"""


def _changes(spark, sf_dir):
    """Chains of three, circles of two, a code before a circle, and codes changed into themselves."""
    key, last = F.col("c_custkey"), F.col("c_custkey") % 10
    to = F.when(last.isin(1, 2, 3, 5, 6), key + 1).when(last == 7, key - 1).otherwise(key)
    customer = table(spark, sf_dir, "customer").filter(last.isin(1, 2, 3, 5, 6, 7, 8))
    return customer.select(code_of(key).alias("old"), code_of(to).alias("new"))


@case(f"{_STEPS} select old, spot as new from steps where spot not in (select old from moves)")
def codes_resolved(spark, sf_dir):
    return p.resolve_codes(_changes(spark, sf_dir)).changes


@case(
    f"""{_STEPS} select old, new, 'circle' as reason from moves
        where old not in (select old from steps where spot not in (select old from moves))"""
)
def codes_rejected(spark, sf_dir):
    return p.resolve_codes(_changes(spark, sf_dir)).rejects
