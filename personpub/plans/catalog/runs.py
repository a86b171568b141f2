"""Runs over stored tables: reading by key, late and repeated batches, marks, dropping."""

from datetime import datetime

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators import persons as p
from personpub.operators import properties as pr
from personpub.operators.documents import original_names, to_document
from personpub.plans.catalog.projections import DOCUMENT, FLAGS, SCALARS, TEXTS
from personpub.plans.catalog.properties import PARENT_REF, PLAIN, TYPE_REF
from personpub.plans.catalog.registry import case
from personpub.plans.increment import document_changes, run_increment
from personpub.schemas import NAMES_EST
from personpub.session import scratch
from personpub.sources import exports, outputs
from personpub.sources.bindings import change_rows, load, table
from personpub.sources.targets import Target, drop_target, publish, read_target
from personpub.streaming.publish import stream_publish


def _target(spark, name, **options):
    return Target(scratch(spark, name), key="id", version="updated", **options)


@case(f"select {DOCUMENT} from v_person where kirje <> '' and persoon = '0000000042'")
def get_from_target(spark, sf_dir):
    """One key, read from its bucket by a reader that is not told how many there are."""
    target = _target(spark, "get", buckets=7)
    publish(document_changes(load(spark, sf_dir, "v_person")), target, "recreate")
    again = Target(target.root, "id", "updated")
    return read_target(spark, again, key="0000000042").select(*SCALARS)


@case(f"select {DOCUMENT} from v_person where kirje <> ''")
def publish_late_rows(spark, sf_dir):
    """Older states that come after the table's leave it as it is."""
    person = load(spark, sf_dir, "v_person")
    target = _target(spark, "late")
    publish(document_changes(person), target, "recreate")
    old = person.withColumn("updated", F.col("updated") - F.expr("interval 1 second"))
    publish(document_changes(old.withColumn("kirje", F.lit("older"))), target, "update")
    return read_target(spark, target).select(*SCALARS)


@case(f"select {DOCUMENT} from v_person where kirje <> ''")
def publish_replayed(spark, sf_dir):
    """A batch that is run again changes nothing, not even under the same change time."""
    person = load(spark, sf_dir, "v_person")
    target = _target(spark, "replay")
    publish(document_changes(person), target, "update", batch="load:1")
    again = document_changes(person.withColumn("kirje", F.lit("again")))
    publish(again, target, "update", batch="load:1")
    return read_target(spark, target).select(*SCALARS)


@case(f"select {DOCUMENT} from v_person where kirje <> '' and emem")
def publish_after_drop(spark, sf_dir):
    person = load(spark, sf_dir, "v_person")
    target = _target(spark, "drop")
    publish(document_changes(person), target, "recreate")
    drop_target(spark, target)
    publish(document_changes(person.filter("emem")), target, "update")
    return read_target(spark, target).select(*SCALARS)


@case("select cast(max(updated) as varchar) as mark from v_person")
def mark_saved(spark, sf_dir):
    """The mark saved last is the one that is loaded."""
    path = scratch(spark, "mark")
    newest = load(spark, sf_dir, "v_person").agg(F.max("updated").cast("string")).first()[0]
    for mark in ("2024-01-01 00:00:00", newest):
        outputs.save_mark(spark, path, mark)
    return spark.range(1).select(F.lit(outputs.load_mark(spark, path)).alias("mark"))


@case(
    """select 1 as run, 'published' as status, cast(max(updated) as varchar) as mark from v_person
       union all select 2, 'no news', cast(max(updated) as varchar) from v_person"""
)
def no_news(spark, sf_dir):
    """The second run over an unchanged table writes nothing."""
    person = load(spark, sf_dir, "v_person")
    target = _target(spark, "news")
    rows = []
    for i in (1, 2):
        got = run_increment(person, target)
        rows.append((i, got.status, got.new))
    return spark.createDataFrame(rows, "run int, status string, mark string")


_STATUS = """case when coalesce(kirje, '') = '' then 'deleted' when outcome = 'rejected' then 'failed'
                  else 'indexed' end"""


@case(
    f"""select {_STATUS} as status, case when coalesce(kirje, '') <> '' then reject_reason end as reason,
               count(*) as n from v_judged group by all"""
)
def increment_account(spark, sf_dir):
    return run_increment(load(spark, sf_dir, "v_person"), _target(spark, "account")).account


@case(
    """select persoon, 'kirjed' as field, kirjed as text from v_person_json where not json_valid(kirjed)
       union all select persoon, 'episoodid', episoodid from v_person_json where not json_valid(episoodid)"""
)
def increment_failures(spark, sf_dir):
    return run_increment(load(spark, sf_dir, "v_person_json"), _target(spark, "failures")).failures


@case(
    """select case when tombstone then 'deleted' else 'indexed' end as status,
              cast(null as varchar) as reason, count(*) as n from v_change group by all"""
)
def stream_account(spark, sf_dir):
    """What the batches of a stream leave about themselves, added up."""
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*")
    target = Target(scratch(spark, "counted"), key="id", version="ts", deleted="tombstone")
    account = scratch(spark, "stream-account")
    stream_publish(
        stream, target, scratch(spark, "counted-checkpoint"), "events", order=["event_id"],
        transform=change_rows, account=account,
    ).awaitTermination()
    rows = spark.read.schema("status string, reason string, n long, batch int").parquet(account)
    return rows.groupBy("status", "reason").agg(F.sum("n").alias("n"))


@case(
    """select persoon, field, text from (
         select persoon, 'kirjed' as field, case when kivi then '{"a":1}' else kirjed end as text from v_person_json
         union all select persoon, 'episoodid', case when emem then '3' else episoodid end from v_person_json)
       where json_valid(text) and json_type(text) <> 'ARRAY'"""
)
def wrong_kinds(spark, sf_dir):
    person = load(spark, sf_dir, "v_person_json").withColumns(
        {
            "kirjed": F.when(F.col("kivi"), F.lit('{"a":1}')).otherwise(F.col("kirjed")),
            "episoodid": F.when(F.col("emem"), F.lit("3")).otherwise(F.col("episoodid")),
        }
    )
    return p.wrong_kinds(person, {"kirjed": "list", "episoodid": "list"})


_AS_TEXT = ", ".join(
    f"cast({c} as varchar) as {c}"
    for c in ("isperson", "kivi", "emem", "evo", "wwiiref", "mv", "ylikoolis_oppinud")
)


@case(f"select * replace ({_AS_TEXT}) from (select {TEXTS}, episoodid, {FLAGS}, redirect from v_person_json)")
def export_repaired(spark, sf_dir):
    """An export whose escaped quotes were doubled before it is read."""
    rows = p.export_projection(load(spark, sf_dir, "v_person_json"))
    path = exports.write_export(rows, scratch(spark, "export"), datetime(2024, 3, 1))
    repaired = scratch(spark, "repaired")
    lines = spark.read.text(path)
    lines.select(F.replace("value", F.lit('\\"'), F.lit('""')).alias("value")).write.text(repaired)
    return exports.read_export(spark, repaired, repaired=True)


@case('select id, synd as "sünd", synnikoht as "sünnikoht" from '
      f"(select {DOCUMENT} from v_person)")
def document_names(spark, sf_dir):
    doc = to_document(p.export_projection(load(spark, sf_dir, "v_person"))).select("id", "synd", "synnikoht")
    return original_names(doc)


@case(
    """select a.persoon, a.isanimi from v_person a
       where rtrim(lower(a.isanimi)) = 'algeria'"""
)
def equal_in_estonian(spark, sf_dir):
    """Case and spaces at the end do not count."""
    person = load(spark, sf_dir, "v_person").select("persoon", "isanimi")
    same = fn.estonian(F.concat("isanimi", F.lit("  "))) == fn.estonian(F.lit("Algeria"))
    return person.filter(same)


@case(
    f"""select * from ({PLAIN}) where entity_key not in (
          select persoon from v_judged where outcome = 'redirected'
             or outcome = 'published' and perenimi = '' and eesnimi = '')"""
)
def entities_without_names_removed(spark, sf_dir):
    """Entities found by two empty properties are deleted from the property store; a
    redirected person's has neither."""
    target = Target(scratch(spark, "entities"), "entity_key", "updated")
    person = load(spark, sf_dir, "v_person")
    publish(pr.to_entities(person, NAMES_EST, TYPE_REF, PARENT_REF), target, "recreate")
    stored = read_target(spark, target)
    empty = pr.entity_find(pr.unfold(stored), {"perenimi": "", "eesnimi": ""})
    gone = stored.join(empty, "entity_key", "left_semi").withColumn(target.deleted, F.lit(True))
    publish(gone, target, "update")
    return pr.unfold(read_target(spark, target))
