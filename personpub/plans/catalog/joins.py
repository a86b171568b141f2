"""Enrichment joins and lists."""

from pyspark.sql import functions as F

from personpub.operators import persons as p
from personpub.operators import properties as pr
from personpub.plans.catalog.registry import case
from personpub.plans.catalog.views import RECORD_ELEMENT, code
from personpub.plans.rebuild import rebuild
from personpub.sources.bindings import code as code_of
from personpub.sources.bindings import load, table


@case(
    """select p.persoon, case when p.evo and e.kirje is not null then e.kirje
                              else p.evokirje end as evokirje
       from v_person p left join (select persoon, min(kirje) as kirje from v_evo
                                  group by persoon) e on e.persoon = p.persoon"""
)
def enrich_text(spark, sf_dir):
    person, evo = load(spark, sf_dir, "v_person"), load(spark, sf_dir, "v_evo")
    return p.enrich_text(person, evo).select("persoon", "evokirje")


@case(
    "select s.kirjekood, r.persoon from v_stone s left join v_record r"
    " on r.kirjekood = s.kirjekood"
)
def resolve_person(spark, sf_dir):
    return p.resolve_person(load(spark, sf_dir, "v_stone"), load(spark, sf_dir, "v_record"))


@case(
    """select p.persoon, p.updated, s.entu_id from v_person p
       left join v_sync s on s.persoon = p.persoon where s.sync_ts is null"""
)
def pending(spark, sf_dir):
    found = pr.pending(load(spark, sf_dir, "v_person"), load(spark, sf_dir, "v_sync"))
    return found.select("persoon", "updated", "entu_id")


@case(
    "select persoon, perenimi from v_person"
    " where persoon in (select persoon from v_register)"
)
def in_register(spark, sf_dir):
    person = load(spark, sf_dir, "v_person").select("persoon", "perenimi")
    return p.in_register(person, load(spark, sf_dir, "v_register"))


@case("select distinct persoon from v_register")
def distinct_keys(spark, sf_dir):
    return p.distinct_keys(load(spark, sf_dir, "v_register"))


@case(
    "select persoon, kirje from v_person"
    " where persoon in (select kirjekood from v_record where pub_emem)"
)
def prune_orphans(spark, sf_dir):
    record = load(spark, sf_dir, "v_record").filter("pub_emem")
    return p.prune_orphans(load(spark, sf_dir, "v_person").select("persoon", "kirje"), record)


@case(
    f"""select coalesce(c.new, p.persoon) as persoon, p.kirje from v_person p
        left join (select {code('c_custkey')} as old, {code('c_custkey + 5000000')} as new
                   from customer where c_acctbal < 0) c on c.old = p.persoon"""
)
def rekey(spark, sf_dir):
    key = F.col("c_custkey")
    moved = (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal < 0")
        .select(code_of(key).alias("old"), code_of(key + 5000000).alias("new"))
    )
    return p.rekey(load(spark, sf_dir, "v_person").select("persoon", "kirje"), moved)


_RECORDS = f"select persoon, 'kirjed' as list, kirjekood as code, {RECORD_ELEMENT} as element from v_record"


@case(_RECORDS)
def records_json(spark, sf_dir):
    return p.records_json(load(spark, sf_dir, "v_record"))


@case(
    f"""select p.persoon, l.code, l.element from v_person p
        left join ({_RECORDS}) l on l.persoon = p.persoon"""
)
def attach_records(spark, sf_dir):
    person = load(spark, sf_dir, "v_person").select("persoon")
    return p.attach_records(person, load(spark, sf_dir, "v_record"))


_PLATES = """(select r.persoon, min(s.kirjekood) as kirjekood from v_stone s
              join v_record r on r.kirjekood = s.kirjekood group by r.persoon)"""


@case(
    f"""select p.persoon, case when p.kivi then coalesce('{{"kirjekood":"' || s.kirjekood
               || '"}}', '{{}}') else p.tahvlikirje end as tahvlikirje
        from v_person p left join {_PLATES} s on s.persoon = p.persoon"""
)
def attach_plate(spark, sf_dir):
    stone = p.resolve_person(load(spark, sf_dir, "v_stone"), load(spark, sf_dir, "v_record"))
    person = load(spark, sf_dir, "v_person").select("persoon", "kivi", "tahvlikirje")
    return p.attach_plate(person, stone).select("persoon", "tahvlikirje")


_RELATION_ELEMENT = """'{"persoon":"' || other || '","kind":"' || kind || '","nimi":"' || nimi
                       || '"}'"""


def _relations(persons: str) -> str:
    return f"""select persoon, 'pereseosed' as list, other || '/' || kind as code,
                      {_RELATION_ELEMENT} as element
               from (select r.persoon, r.other, r.kind, concat_ws(' ', nullif(o.eesnimi, ''),
                            nullif(o.perenimi, '')) as nimi
                     from v_relation r join {persons} o on o.persoon = r.other)"""


@case(
    f"""select p.persoon, l.code, l.element from v_person p
        left join ({_relations('v_person')}) l on l.persoon = p.persoon"""
)
def attach_relations(spark, sf_dir):
    person = load(spark, sf_dir, "v_person").select("persoon", "eesnimi", "perenimi")
    return p.attach_relations(person, load(spark, sf_dir, "v_relation"))


@case("select * from v_sync where persoon in (select persoon from v_evo)")
def synced_rows(spark, sf_dir):
    return pr.synced_rows(load(spark, sf_dir, "v_sync"), load(spark, sf_dir, "v_evo"))


_FOUND = """(select persoon, left(coalesce(perenimi, ''), 50) as perenimi,
                    left(coalesce(eesnimi, ''), 50) as eesnimi, kirje,
                    pub_kivi as kivi, pub_emem as emem, pub_evo as evo
             from v_record where persoon = kirjekood and try_cast(persoon as bigint) > 0)"""


@case(
    f"""select p.persoon, p.kirje, p.perenimi, p.eesnimi, p.kivi, p.emem, p.evo,
               case when p.evo then e.kirje end as evokirje,
               case when p.kivi then coalesce('{{"kirjekood":"' || s.kirjekood || '"}}', '{{}}')
                    else '[]' end as tahvlikirje,
               timestamp '2024-03-01 00:00:00' as updated
        from {_FOUND} p
        left join (select persoon, min(kirje) as kirje from v_evo group by persoon) e
               on e.persoon = p.persoon
        left join {_PLATES} s on s.persoon = p.persoon"""
)
def full_rebuild(spark, sf_dir):
    return _rebuilt(spark, sf_dir).persons.select(
        "persoon", "kirje", "perenimi", "eesnimi", "kivi", "emem", "evo", "evokirje",
        "tahvlikirje", "updated",
    )


@case(
    f"""select l.* from ({_RECORDS} union all {_relations(_FOUND)}) l
        where l.persoon in (select persoon from {_FOUND})"""
)
def full_rebuild_lists(spark, sf_dir):
    return _rebuilt(spark, sf_dir).lists


def _rebuilt(spark, sf_dir):
    views = [load(spark, sf_dir, v) for v in ("v_record", "v_evo", "v_stone", "v_relation")]
    return rebuild(*views, F.expr("timestamp_ntz'2024-03-01 00:00:00'"))
