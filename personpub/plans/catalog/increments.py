"""Incremental and streaming runs over tables written to the shared folder."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from personpub.operators import persons as p
from personpub.operators import stats as st
from personpub.operators.changes import changed_between
from personpub.operators.documents import to_document
from personpub.plans.catalog.merges import _LAST
from personpub.plans.catalog.projections import DOCUMENT, FLAGS, SCALARS, TEXTS
from personpub.plans.catalog.properties import PLAIN, plain
from personpub.plans.catalog.registry import case
from personpub.plans.catalog.statistics import _BASE, _LIVE, _REGISTERED
from personpub.plans.increment import (
    document_changes,
    export_documents,
    republish_batch,
    run_increment,
)
from personpub.session import scratch
from personpub.sources import exports, outputs
from personpub.sources.bindings import change_rows, load, table
from personpub.sources.targets import Target, publish, read_target
from personpub.streaming.publish import stream_publish

RUN = datetime(2024, 3, 1, 12, 0, 0)
MIDDLE = "2024-01-01 00:10:00"


@case(
    f"""select persoon, updated from v_person
        where updated >= timestamp '{MIDDLE}' + interval 1 second
              and updated <= timestamp '2024-01-01 00:20:00'
        order by updated, persoon limit 42"""
)
def republished(spark, sf_dir):
    person = load(spark, sf_dir, "v_person").select("persoon", "updated")
    return republish_batch(person, MIDDLE, "2024-01-01 00:20:00", 42)


def _documents(spark, name: str) -> Target:
    return Target(scratch(spark, name), key="id", version="updated")


@case(f"select {DOCUMENT} from v_person where kirje <> ''")
def publish_recreate(spark, sf_dir):
    target = _documents(spark, "recreate")
    publish(document_changes(load(spark, sf_dir, "v_person")), target, "recreate")
    return read_target(spark, target).select(*SCALARS)


@case(f"select {DOCUMENT}, updated from v_person where kirje <> ''")
def publish_increment(spark, sf_dir):
    """A first load up to a mark, then one incremental run for the rest."""
    person = load(spark, sf_dir, "v_person")
    target = _documents(spark, "increment")
    first = document_changes(changed_between(person, None, MIDDLE))
    publish(first, target, "recreate", mark=MIDDLE)
    run_increment(person, target)
    return read_target(spark, target).select(*SCALARS, "updated")


@case(f"select id, ts, event_id, payload from {_LAST} where not tombstone")
def publish_update(spark, sf_dir):
    """All changes in four batches, each with later and earlier changes than the others."""
    change = load(spark, sf_dir, "v_change")
    target = Target(
        scratch(spark, "update"), key="id", version="ts", deleted="tombstone"
    )
    calm = F.col("payload").isNotNull() & ~F.col("tombstone")
    morning = F.hour("ts") < 12
    for name, part in {
        "deleted": F.col("tombstone"),
        "morning": calm & morning,
        "evening": calm & ~morning,
        "rest": F.col("payload").isNull() & ~F.col("tombstone"),
    }.items():
        publish(change.filter(part), target, "update", batch=name, order=["event_id"])
    return read_target(spark, target)


@case(f"select id, ts, event_id, payload from {_LAST} where not tombstone")
def publish_stream(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parquet*")
    target = Target(
        scratch(spark, "stream"), key="id", version="ts", deleted="tombstone"
    )
    checkpoint = scratch(spark, "stream-checkpoint")
    query = stream_publish(
        stream, target, checkpoint, "events", order=["event_id"], transform=change_rows
    )
    query.awaitTermination()
    return read_target(spark, target)


_ROWS = f"""select {TEXTS}, episoodid, {FLAGS}, redirect from v_person_json"""
_AS_TEXT = ", ".join(
    f"cast({c} as varchar) as {c}"
    for c in ("isperson", "kivi", "emem", "evo", "wwiiref", "mv", "ylikoolis_oppinud")
)
_READ = f"select * replace ({_AS_TEXT}) from ({_ROWS})"


@case(_READ)
def export_round_trip(spark, sf_dir):
    rows = p.export_projection(load(spark, sf_dir, "v_person_json"))
    path = exports.write_export(rows, scratch(spark, "export"), RUN)
    return exports.read_export(spark, path)


@case(_READ)
def change_stream(spark, sf_dir):
    """Export files picked up by a stream."""
    folder = scratch(spark, "exports")
    rows = p.export_projection(load(spark, sf_dir, "v_person_json"))
    exports.write_export(rows, folder, RUN)
    arrived = scratch(spark, "arrived")
    query = (
        exports.change_stream(spark, f"{folder}/*")
        .writeStream.format("parquet")
        .option("path", arrived)
        .option("checkpointLocation", scratch(spark, "arrived-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(arrived).drop("stamp")


@case(
    f"""select {DOCUMENT} from (
            select * replace (case when emem and kivi then ''
                                   when emem and kirje <> '' then kirje || ' (2)'
                                   else kirje end as kirje) from v_person_json)
        where kirje <> ''"""
)
def publish_exports(spark, sf_dir):
    """Two exports, the later one with changed and deleted persons, merged by a stream."""
    folder = scratch(spark, "exports")
    rows = p.export_projection(load(spark, sf_dir, "v_person_json"))
    gone = (F.col("kivi") == 1) | (F.col("kirje") == "")
    text = F.when(gone, F.lit("")).otherwise(F.concat("kirje", F.lit(" (2)")))
    changed = rows.filter("emem = 1").withColumn("kirje", text)
    exports.write_export(changed, folder, RUN + timedelta(minutes=1))
    exports.write_export(rows, folder, RUN)
    target = Target(scratch(spark, "documents"), key="id", version="stamp")
    query = stream_publish(
        exports.change_stream(spark, f"{folder}/*"),
        target,
        scratch(spark, "documents-checkpoint"),
        "exports",
        transform=export_documents,
    )
    query.awaitTermination()
    return read_target(spark, target).select(*SCALARS)


@case(f"select {DOCUMENT} from v_person_json")
def documents_from_export(spark, sf_dir):
    rows = p.export_projection(load(spark, sf_dir, "v_person_json"))
    path = exports.write_export(rows, scratch(spark, "export"), RUN)
    return to_document(exports.read_export(spark, path)).select(*SCALARS)


@case(f"select * from ({_BASE}), ({_LIVE}), ({_REGISTERED})")
def statistics_appended(spark, sf_dir):
    views = [load(spark, sf_dir, v) for v in ("v_record", "v_person", "v_register")]
    path = scratch(spark, "statistics")
    outputs.append_statistics(st.statistics(*views), path)
    return spark.read.parquet(path)


@case(PLAIN)
def properties_written(spark, sf_dir):
    path = scratch(spark, "properties")
    outputs.write_properties(plain(spark, sf_dir), path)
    return spark.read.parquet(path)


@case("select * from v_record")
def snapshot_restored(spark, sf_dir):
    root = scratch(spark, "snapshots")
    outputs.snapshot(load(spark, sf_dir, "v_record"), root, "record", RUN)
    return outputs.restore(spark, root, "record", RUN)
