"""Filters and the publishing test."""

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators import persons as p
from personpub.operators.changes import changed_between
from personpub.operators.search import orphans as orphan_documents
from personpub.plans.catalog.registry import case
from personpub.sources.bindings import load, table

LIVE = "try_cast(persoon as bigint) > 0 and redirect = ''"


@case("select * from v_record where persoon = kirjekood and try_cast(persoon as bigint) > 0")
def representatives(spark, sf_dir):
    return p.representatives(load(spark, sf_dir, "v_record"))


@case(f"select persoon, kirje, updated from v_person where {LIVE}")
def live(spark, sf_dir):
    return p.live(load(spark, sf_dir, "v_person")).select("persoon", "kirje", "updated")


@case(f"select persoon, emem, kivi, wwiiref from v_person where {LIVE} and emem")
def live_on_list(spark, sf_dir):
    found = p.live(load(spark, sf_dir, "v_person")).filter("emem")
    return found.select("persoon", "emem", "kivi", "wwiiref")


@case("select persoon, synd from v_person where synd = ''")
def birth_unknown(spark, sf_dir):
    return p.birth_unknown(load(spark, sf_dir, "v_person")).select("persoon", "synd")


@case(
    "select * from events where ts >= timestamp '2024-01-05 00:00:00' + interval 1 second"
    " and ts <= timestamp '2024-01-20 12:00:00'"
)
def window_of_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return changed_between(events, "2024-01-05 00:00:00", "2024-01-20 12:00:00", column="ts")


@case(
    "select persoon, updated from v_person"
    " where updated between timestamp '2024-01-01 00:05:01' and timestamp '2024-01-01 00:15:00'"
)
def window_of_persons(spark, sf_dir):
    person = load(spark, sf_dir, "v_person")
    window = changed_between(person, "2024-01-01 00:05:00", "2024-01-01 00:15:00")
    return window.select("persoon", "updated")


@case("select kirjekood, persoon from v_record where kirje is null")
def missing_text(spark, sf_dir):
    return p.missing_text(load(spark, sf_dir, "v_record")).select("kirjekood", "persoon")


@case("select persoon, outcome, reject_reason from v_judged")
def publishing_test(spark, sf_dir):
    judged = p.classify(load(spark, sf_dir, "v_person"))
    return judged.select("persoon", "outcome", "reject_reason")


@case("select persoon, kirje, redirect, outcome from v_judged where outcome <> 'rejected'")
def publishable(spark, sf_dir):
    good, _ = p.split_publishable(load(spark, sf_dir, "v_person"))
    return good.select("persoon", "kirje", "redirect", "outcome")


@case("select persoon, kirje, reject_reason from v_judged where outcome = 'rejected'")
def rejected(spark, sf_dir):
    _, bad = p.split_publishable(load(spark, sf_dir, "v_person"))
    return bad.select("persoon", "kirje", "reject_reason")


@case("select persoon, kirje from v_person where perenimi = '' and eesnimi = ''")
def empty_names(spark, sf_dir):
    return p.empty_names(load(spark, sf_dir, "v_person")).select("persoon", "kirje")


@case("select * from v_change where tombstone")
def tombstones(spark, sf_dir):
    return load(spark, sf_dir, "v_change").filter("tombstone")


@case("select persoon from v_person where kirje = ''")
def tombstone_persons(spark, sf_dir):
    person = load(spark, sf_dir, "v_person")
    return person.filter(fn.tombstone(F.col("kirje"))).select("persoon")


@case(
    """select persoon from v_person where redirect = ''
       and persoon not in (select persoon from v_list where list = 'kirjed')"""
)
def orphans(spark, sf_dir):
    person = load(spark, sf_dir, "v_person").select("persoon", "redirect")
    return orphan_documents(person, load(spark, sf_dir, "v_list")).select("persoon")


@case(
    """select persoon, kirjed from v_person_json
       where redirect = '' and not (json_valid(kirjed) and coalesce(len(list_filter(
                 from_json(case when json_valid(kirjed) then kirjed else '[]' end,
                           '[{"kirjekood":"VARCHAR"}]'),
                 lambda x: x.kirjekood is not null)), 0) > 0)"""
)
def orphans_in_cells(spark, sf_dir):
    return orphan_documents(load(spark, sf_dir, "v_person_json")).select("persoon", "kirjed")


@case(
    "select persoon, kirjed, episoodid from v_person_json"
    " where json_valid(kirjed) and json_valid(episoodid)"
)
def json_valid_rows(spark, sf_dir):
    person = load(spark, sf_dir, "v_person_json").select("persoon", "kirjed", "episoodid")
    return p.json_valid_split(person, ["kirjed", "episoodid"])[0]


@case(
    "select persoon, kirjed, episoodid from v_person_json"
    " where not (json_valid(kirjed) and json_valid(episoodid))"
)
def json_invalid_rows(spark, sf_dir):
    person = load(spark, sf_dir, "v_person_json").select("persoon", "kirjed", "episoodid")
    return p.json_valid_split(person, ["kirjed", "episoodid"])[1]


@case(
    """select persoon, 'kirjed' as field, kirjed as text from v_person_json
       where not json_valid(kirjed)
       union all
       select persoon, 'episoodid', episoodid from v_person_json where not json_valid(episoodid)"""
)
def json_failures(spark, sf_dir):
    return p.json_failures(load(spark, sf_dir, "v_person_json"), ["kirjed", "episoodid"])
