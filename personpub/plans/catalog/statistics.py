"""Counts."""

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators import persons as p
from personpub.operators import stats as st
from personpub.operators.documents import to_document
from personpub.plans.catalog.filters import LIVE
from personpub.plans.catalog.registry import case
from personpub.sources.bindings import load, table

_BASE = "select count(*) as isikuid_baasis from v_record where persoon = kirjekood"
_LIVE = f"""select count(*) as isikuid_veebis, count(*) filter (where emem) as e_memoriaalil,
                   count(*) filter (where kivi) as kivis,
                   count(*) filter (where wwiiref) as pogenikke,
                   count(*) filter (where synd = '') as synd_teadmata
            from v_person where {LIVE}"""
_REGISTERED = f"""select count(*) as prga_pogenikke from v_person where {LIVE} and wwiiref
                  and persoon in (select persoon from v_register)"""


@case(_BASE)
def count_representatives(spark, sf_dir):
    return st.count_representatives(load(spark, sf_dir, "v_record"))


@case(_LIVE)
def live_counts(spark, sf_dir):
    return st.live_counts(load(spark, sf_dir, "v_person"))


@case(_REGISTERED)
def refugees_registered(spark, sf_dir):
    return st.refugees_registered(
        load(spark, sf_dir, "v_person"), load(spark, sf_dir, "v_register")
    )


@case(f"select * from ({_BASE}), ({_LIVE}), ({_REGISTERED})")
def statistics(spark, sf_dir):
    views = [load(spark, sf_dir, v) for v in ("v_record", "v_person", "v_register")]
    return st.statistics(*views)


@case("select max(ts) as ts from events")
def high_water(spark, sf_dir):
    return st.high_water(table(spark, sf_dir, "events"), "ts")


@case(
    """select count(*) as "all", cast(sum(cast(isperson as integer)) as bigint) as isperson,
              cast(sum(cast(wwiiref as integer)) as bigint) as wwii,
              cast(sum(cast(mv as integer)) as bigint) as mv,
              cast(sum(cast(emem as integer)) as bigint) as emem,
              cast(sum(cast(kivi as integer)) as bigint) as kivi from v_person"""
)
def load_totals(spark, sf_dir):
    return st.load_totals(to_document(p.export_projection(load(spark, sf_dir, "v_person"))))


_RESULT = """(select case when kirje = '' then 'deleted' when outcome = 'rejected' then 'failed'
                          else 'indexed' end as status,
                     case when kirje <> '' then reject_reason end as reason from v_judged)"""


def _result(spark, sf_dir):
    return st.load_result(load(spark, sf_dir, "v_person"))


@case(f"select status, reason, count(*) as n from {_RESULT} group by status, reason")
def load_account(spark, sf_dir):
    return st.load_account(_result(spark, sf_dir))


@case(
    f"""select count(*) as read, count(*) filter (where status = 'indexed') as indexed,
               count(*) filter (where status = 'deleted') as deleted,
               count(*) filter (where status = 'failed') as failed,
               count(*) filter (where status <> 'failed') as uploaded from {_RESULT}"""
)
def load_summary(spark, sf_dir):
    return st.load_summary(_result(spark, sf_dir))


@case(
    "select count(*) as empty_persons from v_person where perenimi = '' and eesnimi = ''"
)
def count_empty(spark, sf_dir):
    return st.count_empty(load(spark, sf_dir, "v_person"))


_KINDS = ("view", "click", "purchase")


_FLAGS = ", ".join(f"cast(sum({k}) as bigint) as {k}" for k in _KINDS)
_RUNNING = ", ".join(
    f"cast(sum({c}) over (order by batch) as bigint) as {c}" for c in ('"all"', *_KINDS)
)
_EVENT_FLAGS = ", ".join(f"cast(event_type = '{k}' as bigint) as {k}" for k in _KINDS)


@case(
    f"""select batch, {_RUNNING}
        from (select batch, count(*) as "all", {_FLAGS}
              from (select (row_number() over (order by ts, event_id) - 1) // 2500 as batch,
                           {_EVENT_FLAGS} from events)
              group by batch)"""
)
def running_totals(spark, sf_dir):
    flags = [(F.col("event_type") == k).cast("bigint").alias(k) for k in _KINDS]
    events = table(spark, sf_dir, "events").select("ts", "event_id", *flags)
    return st.running_totals(events, ["ts", "event_id"], list(_KINDS))
