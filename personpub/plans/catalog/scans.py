"""Scans of the source tables."""

from personpub.operators.paging import head_rows
from personpub.plans.catalog.registry import case
from personpub.sources.bindings import load, table

PERSON = (
    "persoon, kirje, evokirje, perenimi, eesnimi, isanimi, emanimi, synd, surm, synnikoht,"
    " surmakoht, kirjed, pereseosed, tahvlikirje, episoodid, isperson, kivi, emem, evo,"
    " wwiiref, mv, ylikoolis_oppinud, redirect, updated"
)


@case("select * from v_record")
def scan_record(spark, sf_dir):
    return load(spark, sf_dir, "v_record")


@case(f"select {PERSON} from v_person")
def scan_person(spark, sf_dir):
    return load(spark, sf_dir, "v_person")


@case(f"select {PERSON} from v_person_json")
def scan_person_json(spark, sf_dir):
    return load(spark, sf_dir, "v_person_json")


@case("select * from v_evo")
def scan_evo(spark, sf_dir):
    return load(spark, sf_dir, "v_evo")


@case("select * from v_stone")
def scan_stone(spark, sf_dir):
    return load(spark, sf_dir, "v_stone")


@case("select * from v_register")
def scan_register(spark, sf_dir):
    return load(spark, sf_dir, "v_register")


@case("select * from v_sync")
def scan_sync(spark, sf_dir):
    return load(spark, sf_dir, "v_sync")


@case("select * from v_relation")
def scan_relation(spark, sf_dir):
    return load(spark, sf_dir, "v_relation")


@case("select * from customer order by c_custkey limit 10")
def head_customers(spark, sf_dir):
    return head_rows(table(spark, sf_dir, "customer"), 10, "c_custkey")


@case("select * from v_sync")
def head_sync(spark, sf_dir):
    return head_rows(load(spark, sf_dir, "v_sync"), None, "persoon")
