"""Merges on a key."""

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators import merge
from personpub.plans.catalog.registry import case
from personpub.plans.catalog.views import code
from personpub.session import scratch, settle
from personpub.sources.bindings import code as code_of
from personpub.sources.bindings import load
from personpub.sources.targets import Target, publish, read_target

_LAST = """(select * from v_change qualify row_number() over
            (partition by id order by ts desc, event_id desc) = 1)"""


@case(f"select * from {_LAST}")
def latest(spark, sf_dir):
    return merge.latest(load(spark, sf_dir, "v_change"), "id", ["ts", "event_id"])


_OFFERS = """(select persoon, 'on the wall' as kirje, 2 as place from v_person where kivi
              union all select persoon, 'refugee', 1 from v_person where wwiiref)"""


@case(
    f"""select persoon, kirje, 0 as place from v_person where emem
        union all
        select * from {_OFFERS} where persoon not in (select persoon from v_person where emem)
        qualify row_number() over (partition by persoon order by place) = 1"""
)
def insert_ignore(spark, sf_dir):
    """Persons of two more lists join those of a first one."""
    person = load(spark, sf_dir, "v_person")
    target = person.filter("emem").select("persoon", "kirje", F.lit(0).alias("place"))
    wall = person.filter("kivi").select(
        "persoon", F.lit("on the wall").alias("kirje"), F.lit(2).alias("place")
    )
    refugees = person.filter("wwiiref").select(
        "persoon", F.lit("refugee").alias("kirje"), F.lit(1).alias("place")
    )
    return merge.insert_ignore(target, wall.unionByName(refugees), "persoon", ["place"])


@case(
    """select s.persoon, coalesce(e.entu_id, s.entu_id) as entu_id,
              case when e.persoon is null then s.sync_ts else e.sync_ts end as sync_ts
       from v_sync s left join (select persoon, 'e' || persoon as entu_id,
                                       timestamp '2024-03-01 00:00:00' as sync_ts
                                from v_evo) e on e.persoon = s.persoon
       union all
       select persoon, 'e' || persoon, timestamp '2024-03-01 00:00:00' from v_evo
       where persoon not in (select persoon from v_sync)"""
)
def upsert(spark, sf_dir):
    done = load(spark, sf_dir, "v_evo").select(
        "persoon",
        F.concat(F.lit("e"), "persoon").alias("entu_id"),
        F.expr("timestamp_ntz'2024-03-01 00:00:00'").alias("sync_ts"),
    )
    return merge.upsert(load(spark, sf_dir, "v_sync"), done, "persoon")


_HALF = "timestamp '2024-01-16 00:00:00'"
_NEW = f"""(select * from v_change where ts >= {_HALF} qualify row_number() over
            (partition by id order by ts desc, event_id desc) = 1)"""
_OLD = f"""(select * from v_change where ts < {_HALF} and not tombstone qualify row_number() over
            (partition by id order by ts desc, event_id desc) = 1)"""


@case(
    f"""select id, ts, event_id, payload from {_OLD} where id not in (select id from {_NEW})
        union all select id, ts, event_id, payload from {_NEW} where not tombstone"""
)
def apply_changes(spark, sf_dir):
    change = load(spark, sf_dir, "v_change")
    half = F.expr("timestamp_ntz'2024-01-16 00:00:00'")
    before = change.filter((F.col("ts") < half) & ~F.col("tombstone"))
    target = merge.latest(before, "id", ["ts", "event_id"]).drop("tombstone")
    return merge.apply_changes(
        target, change.filter(F.col("ts") >= half), "id", ["ts", "event_id"], "tombstone"
    )


@case("select persoon, kirje from v_person where not (perenimi = '' and eesnimi = '')")
def delete_where(spark, sf_dir):
    person = load(spark, sf_dir, "v_person")
    empty = (F.col("perenimi") == "") & (F.col("eesnimi") == "")
    return merge.delete_where(person, empty).select("persoon", "kirje")


_NOW = "timestamp '2024-03-01 00:00:00'"


_STAMPED = f"""select persoon, case when evo then kirje || '.' else kirje end as kirje,
               nullif(isanimi, '') as isanimi, case when evo then {_NOW} else updated end as updated
        from v_person
        union all
        select {code('cast(persoon as bigint) + 7000000')}, kirje, null, {_NOW} from v_evo"""


def _edited(spark, sf_dir):
    """(kept table with digests, new rows, time of the change)"""
    person = load(spark, sf_dir, "v_person")
    father = fn.absent(F.col("isanimi")).alias("isanimi")
    old = person.select("persoon", "kirje", father, "updated")
    text = F.when(F.col("evo"), F.concat("kirje", F.lit("."))).otherwise(F.col("kirje"))
    edited = person.select("persoon", text.alias("kirje"), father, "updated")
    now = F.expr("timestamp_ntz'2024-03-01 00:00:00'")
    added = load(spark, sf_dir, "v_evo").select(
        code_of(fn.number(F.col("persoon")) + 7000000).alias("persoon"),
        "kirje",
        F.lit(None).cast("string").alias("isanimi"),
        now.alias("updated"),
    )
    return settle(merge.with_digest(old, "persoon")), edited.unionByName(added), now


@case(_STAMPED)
def stamp_changes(spark, sf_dir):
    """Texts of one list's persons are edited, and new persons are added."""
    old, new, now = _edited(spark, sf_dir)
    return merge.stamp_changes(old, new, "persoon", now)


@case(f"select * from ({_STAMPED}) where updated = {_NOW}")
def real_changes(spark, sf_dir):
    """Of the same, only what differs."""
    old, new, now = _edited(spark, sf_dir)
    return merge.real_changes(old, new, "persoon", now)


@case(f"select * from ({_STAMPED})")
def publish_real_changes(spark, sf_dir):
    """Only rows that differ go into a target; it then is the table as stamped."""
    old, new, now = _edited(spark, sf_dir)
    target = Target(scratch(spark, "stamped"), "persoon", "updated")
    publish(old.drop("digest"), target, "recreate")
    publish(merge.real_changes(old, new, "persoon", now), target, "update")
    return read_target(spark, target)
