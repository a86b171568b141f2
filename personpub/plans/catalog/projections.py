"""Projections and scalar functions."""

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators import persons as p
from personpub.operators.documents import to_document
from personpub.plans.catalog.registry import case
from personpub.sources.bindings import load, table
from personpub.sources.exports import export_lines

TEXTS = (
    "persoon, kirje, evokirje, perenimi, eesnimi, isanimi, emanimi,"
    " left(synd, 10) as synd, left(surm, 10) as surm, synnikoht, surmakoht,"
    " kirjed, pereseosed, tahvlikirje"
)
FLAGS = ", ".join(
    f"cast(case when {c} is true then 1 else 0 end as integer) as {c}"
    for c in ("isperson", "kivi", "emem", "evo", "wwiiref", "mv", "ylikoolis_oppinud")
)


@case(f"select {TEXTS}, episoodid, {FLAGS}, redirect from v_person")
def export_projection(spark, sf_dir):
    return p.export_projection(load(spark, sf_dir, "v_person"))


@case(f"select {TEXTS}, {FLAGS} from v_person")
def export_projection_old(spark, sf_dir):
    return p.export_projection(load(spark, sf_dir, "v_person"), layout="v1")


def _quoted(c: str) -> str:
    return (
        f"""coalesce('"' || replace(replace(cast({c} as varchar), '\\', '\\\\'), '"', '\\"')"""
        f""" || '"', '\\N')"""
    )


_LINE = " || ',' || ".join(
    _quoted(c)
    for c in (
        "persoon", "kirje", "evokirje", "perenimi", "eesnimi", "isanimi", "emanimi", "synd",
        "surm", "synnikoht", "surmakoht", "kirjed", "pereseosed", "tahvlikirje", "episoodid",
        "isperson", "kivi", "emem", "evo", "wwiiref", "mv", "ylikoolis_oppinud", "redirect",
    )
)


@case(
    f"select {_LINE} as value"
    f" from (select {TEXTS}, episoodid, {FLAGS}, redirect from v_person_json)"
)
def export_text(spark, sf_dir):
    return export_lines(p.export_projection(load(spark, sf_dir, "v_person_json")))


DOCUMENT = (
    "persoon as id, kirje, evokirje, perenimi, eesnimi, isanimi, emanimi,"
    " nullif(left(synd, 10), '') as synd, nullif(left(surm, 10), '') as surm,"
    " nullif(synnikoht, '') as synnikoht, nullif(surmakoht, '') as surmakoht, "
    + ", ".join(
        f"cast(case when {c} then 1 else 0 end as integer) as {n}"
        for c, n in (
            ("isperson", "isperson"), ("kivi", "kivi"), ("emem", "emem"), ("evo", "evo"),
            ("wwiiref", "wwii"), ("mv", "mv"),
        )
    )
    + ", redirect"
)
SCALARS = (
    "id", "kirje", "evokirje", "perenimi", "eesnimi", "isanimi", "emanimi", "synd", "surm",
    "synnikoht", "surmakoht", "isperson", "kivi", "emem", "evo", "wwii", "mv", "redirect",
)


@case(f"select {DOCUMENT} from v_person")
def document_scalars(spark, sf_dir):
    rows = p.export_projection(load(spark, sf_dir, "v_person"))
    return to_document(rows).select(*SCALARS)


@case(
    """select persoon as id,
              cast(case when json_valid(kirjed) and json_type(kirjed) = 'ARRAY'
                   then json_array_length(kirjed) end as integer) as n_kirjed,
              case when json_valid(kirjed) then kirjed ->> '$[0]' end as first_record,
              cast(case when json_valid(episoodid) and json_type(episoodid) = 'ARRAY'
                   then json_array_length(episoodid) end as integer) as n_episoodid,
              case when json_valid(episoodid) then episoodid ->> '$[0].nimetus' end
                  as first_episode
       from v_person_json"""
)
def document_json(spark, sf_dir):
    doc = to_document(p.export_projection(load(spark, sf_dir, "v_person_json")))
    known = F.col("kirjed").isNotNull()
    return doc.select(
        "id",
        F.when(known, F.size("kirjed")).alias("n_kirjed"),
        F.get("kirjed", F.lit(0)).alias("first_record"),
        F.when(F.col("episoodid").isNotNull(), F.size("episoodid")).alias("n_episoodid"),
        F.get("episoodid", F.lit(0))["nimetus"].alias("first_episode"),
    )


@case(
    """select persoon, coalesce(nullif(eesnimi, ''), '') as eesnimi, perenimi,
              coalesce(redirect, '') as redirect, coalesce(isperson, false) as isperson,
              coalesce(evo, false) as evo, coalesce(tahvlikirje, '[]') as tahvlikirje
       from (select persoon, case when kivi then '{}' end as tahvlikirje, nullif(eesnimi, '') as eesnimi, perenimi,
                    nullif(redirect, '') as redirect, case when isperson then true end
                    as isperson, case when evo then true end as evo from v_person)"""
)
def fill_defaults(spark, sf_dir):
    person = load(spark, sf_dir, "v_person")
    gaps = person.select(
        "persoon",
        fn.absent(F.col("eesnimi")).alias("eesnimi"),
        "perenimi",
        fn.absent(F.col("redirect")).alias("redirect"),
        F.when(F.col("isperson"), F.lit(True)).alias("isperson"),
        F.when(F.col("evo"), F.lit(True)).alias("evo"),
        F.when(F.col("kivi"), F.lit("{}")).alias("tahvlikirje"),
    )
    return p.fill_defaults(gaps)


@case(
    """select persoon, left(repeat(perenimi, 6), 50) as perenimi,
              left(repeat(synnikoht, 12), 100) as synnikoht from v_person"""
)
def fit_widths(spark, sf_dir):
    return p.fit_widths(_wide(spark, sf_dir))


@case(
    """select persoon, 'perenimi' as field, cast(length(repeat(perenimi, 6)) as integer) as length
       from v_person where length(repeat(perenimi, 6)) > 50
       union all
       select persoon, 'synnikoht', cast(length(repeat(synnikoht, 12)) as integer)
       from v_person where length(repeat(synnikoht, 12)) > 100"""
)
def cut_report(spark, sf_dir):
    return p.cut_report(_wide(spark, sf_dir))


def _wide(spark, sf_dir):
    return load(spark, sf_dir, "v_person").select(
        "persoon",
        F.repeat("perenimi", F.lit(6)).alias("perenimi"),
        F.repeat("synnikoht", F.lit(12)).alias("synnikoht"),
    )


@case(
    r"""select doc_id, trim(regexp_replace(text, '[\r\n]+', ' ', 'g')) as text from v_doc"""
)
def one_line(spark, sf_dir):
    return load(spark, sf_dir, "v_doc").select("doc_id", fn.one_line(F.col("text")).alias("text"))


_TEXT = "concat_ws(', ', nullif(perenimi, ''), nullif(eesnimi, ''))"
_RECORD = (
    "(select *, '' as isanimi, '' as emanimi, '' as synd, '' as synnikoht, '' as surm,"
    " '' as surmakoht from v_record)"
)


def _record(spark, sf_dir):
    empty = {
        c: F.lit("")
        for c in ("isanimi", "emanimi", "synd", "synnikoht", "surm", "surmakoht")
    }
    return load(spark, sf_dir, "v_record").withColumns(empty)


@case(f"select kirjekood, {_TEXT} as text from {_RECORD}")
def person_text(spark, sf_dir):
    return _record(spark, sf_dir).select("kirjekood", p.person_text().alias("text"))


@case(
    f"select kirjekood, trim(regexp_replace(coalesce(kirje, {_TEXT}), '[\\r\\n]+', ' ', 'g'))"
    f" as kirje from {_RECORD}"
)
def repair_text(spark, sf_dir):
    return p.repair_text(_record(spark, sf_dir)).select("kirjekood", "kirje")


@case(
    f"""select persoon, left(synd, 10) as day, cast(case when mv is true then 1 else 0 end
              as integer) as mv_bit, coalesce(evokirje, '{{}}') as plate,
              nullif(isanimi, '') as father, nullif(nullif(tahvlikirje, '{{}}'), '[]') as no_plate,
              regexp_matches(kirje, '{fn.LETTERS}') as letters,
              try_cast(persoon as bigint) as number, updated + interval 1 second as later,
              strftime(updated, '%Y%m%d_%H%M%S') as stamp,
              concat_ws(' ', nullif(eesnimi, ''), nullif(perenimi, '')) as name
       from v_person"""
)
def scalar_functions(spark, sf_dir):
    c = F.col
    return load(spark, sf_dir, "v_person").select(
        "persoon",
        fn.first_chars(c("synd"), 10).alias("day"),
        fn.bit(c("mv")).alias("mv_bit"),
        F.coalesce("evokirje", F.lit("{}")).alias("plate"),
        fn.absent(c("isanimi")).alias("father"),
        fn.absent(c("tahvlikirje"), "{}", "[]").alias("no_plate"),
        fn.has_letter(c("kirje")).alias("letters"),
        fn.number(c("persoon")).alias("number"),
        fn.later(c("updated"), 1).alias("later"),
        fn.stamp(c("updated")).alias("stamp"),
        fn.full_name(c("eesnimi"), c("perenimi")).alias("name"),
    )


@case(
    """select event_id, json_valid(props) as valid, cast(props ->> '$.k' as bigint) as k,
              cast(case when event_type = 'view' then 1 else 0 end as integer) as is_view
       from events"""
)
def json_fields(spark, sf_dir):
    props = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.is_json(props).alias("valid"),
        F.try_variant_get(fn.parsed(props), "$.k", "bigint").alias("k"),
        fn.flag((F.col("event_type") == "view").cast("int").cast("string")).alias("is_view"),
    )


@case(
    """select persoon, cast(i as integer) as i, kirjed ->> ('$[' || i || ']') as element
       from (select persoon, kirjed, unnest(range(cast(json_array_length(kirjed) as bigint))) as i
             from v_person_json where json_valid(kirjed) and json_type(kirjed) = 'ARRAY')"""
)
def json_elements(spark, sf_dir):
    return load(spark, sf_dir, "v_person_json").select(
        "persoon", F.posexplode(fn.elements(F.col("kirjed"))).alias("i", "element")
    )
