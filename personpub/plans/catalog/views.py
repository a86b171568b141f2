"""The binding views as SQL, for comparing results with another engine."""

from __future__ import annotations

import re

from personpub.functions.scalars import LETTERS


def code(x: str) -> str:
    return f"lpad(cast({x} as varchar), 10, '0')"


def cell(name: str) -> str:
    return f"""
        select persoon, '[' || string_agg(element, ',' order by code) || ']' as {name}
        from v_list where list = '{name}' group by persoon"""


RECORD_ELEMENT = """'{"kirjekood":"' || kirjekood || '"}'"""

VIEWS = {
    "v_record": f"""
        select {code('o_orderkey+1')} as kirjekood,
               {code('min(o_orderkey) over (partition by o_custkey) + 1')} as persoon,
               case when o_orderkey%23=0 then null else o_orderpriority end as kirje,
               o_orderpriority as perenimi, o_orderstatus as eesnimi,
               o_orderkey%3=0 as pub_kivi, o_orderkey%2=0 as pub_emem,
               o_orderstatus='F' as pub_evo
        from orders""",
    "v_person": f"""
        select {code('c_custkey')} as persoon,
               case when c_custkey%17=0 then '' when c_custkey%19=0 then '12-34'
                    else concat(c_name, ', ', c_mktsegment) end as kirje,
               cast(null as varchar) as evokirje,
               case when c_custkey%13=0 then '' else c_mktsegment end as perenimi,
               case when c_custkey%13=0 or c_custkey%5=0 then '' else c_name end as eesnimi,
               case when c_custkey%4=0 then '' else n_name end as isanimi,
               '' as emanimi,
               case when c_custkey%7=0 then '' else '1920-05-17 00:00:00' end as synd,
               '' as surm, n_name as synnikoht, '' as surmakoht,
               '[]' as kirjed, '[]' as pereseosed, '[]' as tahvlikirje, '[]' as episoodid,
               c_custkey%10<>0 as isperson, c_custkey%3=0 as kivi, c_custkey%2=0 as emem,
               c_mktsegment='BUILDING' as evo, c_nationkey<5 as wwiiref, c_acctbal<0 as mv,
               c_custkey%6=0 as ylikoolis_oppinud,
               case when c_custkey%11=0 then {code('c_custkey+1')} else '' end as redirect,
               timestamp '2024-01-01 00:00:00' + c_custkey * interval 1 second as updated
        from customer join nation on n_nationkey = c_nationkey""",
    "v_list": f"""
        select persoon, 'kirjed' as list, kirjekood as code, {RECORD_ELEMENT} as element
        from (select {code('o_custkey')} as persoon, {code('o_orderkey+1')} as kirjekood from orders)
        union all
        select {code('user_id')}, 'episoodid', {code('event_id')},
               '{{"nimetus":"' || event_type || '","asukoht":"","aeg":"'
               || cast(cast(ts as date) as varchar) || '"}}'
        from events""",
    "v_kirjed": cell("kirjed"),
    "v_episoodid": cell("episoodid"),
    "v_person_json": """
        select p.* exclude (kirjed, episoodid),
               case when try_cast(p.persoon as bigint) % 29 = 0 then '[{'
                    else coalesce(k.kirjed, '[]') end as kirjed,
               coalesce(e.episoodid, '[]') as episoodid
        from v_person p left join v_kirjed k on k.persoon = p.persoon
                        left join v_episoodid e on e.persoon = p.persoon""",
    "v_evo": f"""
        select {code('c_custkey')} as persoon, concat('EVO ', c_name) as kirje
        from customer where c_mktsegment = 'BUILDING'""",
    "v_stone": f"""
        select {code('k+1')} as kirjekood, cast(null as varchar) as persoon
        from (select distinct l_orderkey as k from lineitem where l_orderkey%2=0
              union all select max(o_orderkey)+1000 from orders)""",
    "v_register": f"""
        select {code('o_custkey')} as persoon from orders where o_orderpriority = '1-URGENT'""",
    "v_sync": f"""
        select {code('c_custkey')} as persoon, md5({code('c_custkey')}) as entu_id,
               case when c_custkey%4=1 then null
                    else timestamp '2024-02-01 00:00:00' end as sync_ts
        from customer where c_custkey%4 in (0, 1)""",
    "v_change": f"""
        select {code('user_id')} as id, ts, event_id, event_type = 'error' as tombstone,
               props as payload from events""",
    "v_relation": f"""
        select {code('a.c_custkey')} as persoon, {code('b.c_custkey')} as other,
               'spouse' as kind
        from customer a join customer b on b.c_custkey = a.c_custkey+1
        where a.c_custkey%2=0""",
    "v_doc": "select doc_id, text, lang, source from documents",
    # persons with the outcome of the publishing test
    "v_judged": f"""
        select *, case when reject_reason is not null then 'rejected'
                       when redirect <> '' then 'redirected' else 'published' end as outcome
        from (select *, case when coalesce(persoon, '') = '' then 'no code'
                             when redirect <> '' then null
                             when coalesce(kirje, '') = '' then 'no text'
                             when not regexp_matches(kirje, '{LETTERS}')
                                 then 'no letter in text'
                             when coalesce(eesnimi, '') = '' and coalesce(perenimi, '') = ''
                                 then 'no name' end as reject_reason
              from v_person)""",
    "v_judged_json": """
        select j.* exclude (kirjed, episoodid), p.kirjed, p.episoodid
        from v_judged j join v_person_json p on p.persoon = j.persoon""",
}


def with_views(sql: str) -> str:
    """The query preceded by the views it needs, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    unique = list(dict.fromkeys(needed))
    if not unique:
        return sql
    listed = ",\n".join(f"{name} as ({VIEWS[name]})" for name in unique)
    return f"with {listed}\n{sql}"
