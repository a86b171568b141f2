"""Queries over documents."""

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators import paging as pg
from personpub.operators import properties as pr
from personpub.operators import search as se
from personpub.operators.ranks import store_ordered
from personpub.plans.catalog.properties import EST, est
from personpub.plans.catalog.registry import case
from personpub.schemas import EPISODES
from personpub.session import kept, scratch
from personpub.sources.bindings import load


def words(c: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'),"
        " lambda w: w <> '')"
    )


@case("select * from v_doc where doc_id = 42")
def get_by_key(spark, sf_dir):
    return se.get(load(spark, sf_dir, "v_doc"), 42, key="doc_id")


@case("select doc_id, lang, source from v_doc order by doc_id limit 10")
def first_page(spark, sf_dir):
    doc = load(spark, sf_dir, "v_doc").select("doc_id", "lang", "source")
    return pg.page(doc, ["doc_id"], 10)


@case("select doc_id, lang, source from v_doc order by lang, source, doc_id limit 10 offset 100")
def later_page(spark, sf_dir):
    doc = load(spark, sf_dir, "v_doc").select("doc_id", "lang", "source")
    return pg.page(doc, ["lang", "source", "doc_id"], 10, 100)


@case("select persoon, perenimi from v_person where persoon > '0000000600'"
      " order by persoon limit 200")
def page_after(spark, sf_dir):
    person = load(spark, sf_dir, "v_person").select("persoon", "perenimi")
    return pg.page_after(person, "persoon", "0000000600", 200)


@case(
    """select persoon, r as rank from (select persoon, row_number() over (order by persoon) as r
       from v_person) where r > 600 and r <= 800"""
)
def deep_page(spark, sf_dir):
    return pg.skip_to(_ordered(spark, sf_dir), 200, 600)


def _ordered(spark, sf_dir):
    """Person codes in order, written once."""
    person = load(spark, sf_dir, "v_person").select("persoon")
    return kept(spark, f"ordered {sf_dir}", lambda path: store_ordered(person, ["persoon"], path, 500))


@case("select count(*) as n, count(*) as last from v_person")
def order_index(spark, sf_dir):
    """Ranges of rows follow each other without a gap."""
    last = F.max(F.col("start") + F.col("n")).alias("last")
    return _ordered(spark, sf_dir).index().agg(F.sum("n").alias("n"), last)


@case("select persoon, eesnimi, perenimi from v_person order by eesnimi, perenimi, persoon")
def sort_exact(spark, sf_dir):
    person = load(spark, sf_dir, "v_person").select("persoon", "eesnimi", "perenimi")
    return pg.sort_exact(person, "eesnimi", "perenimi", "persoon")


@case("select persoon, updated from v_person order by updated, persoon limit 42")
def oldest(spark, sf_dir):
    return pg.oldest(load(spark, sf_dir, "v_person").select("persoon", "updated"), 42)


@case("select doc_id, lang from v_doc where lang = 'de'")
def term(spark, sf_dir):
    return se.term(load(spark, sf_dir, "v_doc"), "lang", "de").select("doc_id", "lang")


@case("select persoon, isanimi from v_person where isanimi = ''")
def term_empty(spark, sf_dir):
    person = load(spark, sf_dir, "v_person").select("persoon", "isanimi")
    return se.term(person, "isanimi", "")


def _stored(spark, sf_dir) -> se.WordTable:
    """The word table of texts and sources, written once."""
    doc = load(spark, sf_dir, "v_doc")
    return kept(spark, f"words {sf_dir}", lambda path: se.store_words(doc, ["text", "source"], path))


def _picked(spark, sf_dir, keys, *columns):
    """Other columns of the documents found."""
    return load(spark, sf_dir, "v_doc").select("doc_id", *columns).join(keys, "doc_id", "left_semi")


@case(f"select doc_id, lang from v_doc where list_has_any({words('text')}, ['para', 'ernt'])")
def match(spark, sf_dir):
    keys = se.match(_stored(spark, sf_dir), "text", "Para, ERNT")
    return _picked(spark, sf_dir, keys, "lang")


@case(
    """select persoon, redirect, isanimi from v_person
       where redirect = '' and wwiiref and not (isanimi = '') and not (perenimi = 'BUILDING')"""
)
def bool_query(spark, sf_dir):
    person = load(spark, sf_dir, "v_person")
    c = F.col
    found = se.bool_query(
        person,
        [c("redirect") == "", c("wwiiref")],
        [c("isanimi") == "", c("perenimi") == "BUILDING"],
    )
    return found.select("persoon", "redirect", "isanimi")


_ALL_WORDS = f"""select doc_id, source, lang from v_doc
    where list_has_all(list_concat({words('text')}, {words('source')}), ['the', 'src7'])"""


@case(_ALL_WORDS)
def multi_match(spark, sf_dir):
    keys = se.multi_match(_stored(spark, sf_dir), ["text", "source"], "The src7")
    return _picked(spark, sf_dir, keys, "source", "lang")


@case(f"{_ALL_WORDS} order by lang, source, doc_id limit 10")
def multi_match_page(spark, sf_dir):
    return pg.page(multi_match(spark, sf_dir), ["lang", "source", "doc_id"], 10)


def _index(field: str) -> str:
    return f"""select doc_id, '{field}' as field, term, count(*) as tf,
                      any_value(dl) as dl
               from (select doc_id, cast(len(ws) as bigint) as dl, unnest(ws) as term
                     from (select doc_id, {words(field)} as ws from v_doc))
               group by doc_id, term"""


@case(f"{_index('text')} union all {_index('source')}")
def build_index(spark, sf_dir):
    return se.build_index(load(spark, sf_dir, "v_doc"), ["text", "source"])


@case(
    f"""select field, count(*) as n_docs, cast(sum(dl) as bigint) as n_words
        from (select 'text' as field, len({words('text')}) as dl from v_doc
              union all select 'source', len({words('source')}) from v_doc)
        where dl > 0 group by field"""
)
def index_stats(spark, sf_dir):
    return se.index_stats(load(spark, sf_dir, "v_doc"), ["text", "source"])


@case(
    f"""select field, count(*) as n_docs, cast(sum(dl) as bigint) as n_words
        from (select 'text' as field, len({words('text')}) as dl from v_doc
              union all select 'source', len({words('source')}) from v_doc)
        where dl > 0 group by field"""
)
def store_words(spark, sf_dir):
    """The word table written, and the totals kept beside it."""
    return se.store_words(load(spark, sf_dir, "v_doc"), ["text", "source"], scratch(spark, "words")).stats()


def _bm25(field: str, query: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in query)
    return f"""
        select doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                           / (tf + 1.2 * (0.25 + 0.75 * dl / (words / n)))) as score
        from (select *, count(*) over (partition by term) as df from ({_index(field)})
              where term in ({listed})),
             (select cast(count(*) as double) as n, cast(sum(len(ws)) as double) as words
              from (select {words(field)} as ws from v_doc) where len(ws) > 0)
        group by doc_id"""


@case(f"select doc_id, round(score, 4) as score from ({_bm25('text', ['the', 'para'])})")
def bm25(spark, sf_dir):
    doc = load(spark, sf_dir, "v_doc")
    scores = se.bm25(
        se.build_index(doc, ["text"]), se.index_stats(doc, ["text"]), "text", "the para"
    )
    return scores.select("doc_id", F.round("score", 4).alias("score"))


@case(f"select doc_id, round(score, 4) as score from ({_bm25('text', ['der', 'only'])})")
def bm25_stored(spark, sf_dir):
    """The same from an index kept on disk."""
    table = _stored(spark, sf_dir)
    scores = se.bm25(table.words("der only"), table.stats(), "text", "der only")
    return scores.select("doc_id", F.round("score", 4).alias("score"))


_TERM = """select doc_id, ln(1 + (n - df + 0.5) / (df + 0.5)) as score
           from v_doc, (select count(*) as n, count(*) filter (where lang = 'de') as df
                        from v_doc) where lang = 'de'"""


@case(
    f"""select doc_id, round(sum(score), 4) as score
        from ({_bm25('text', ['para', 'only'])} union all {_bm25('source', ['src3'])}
              union all {_TERM})
        group by doc_id order by round(sum(score), 4) desc, doc_id limit 10 offset 100"""
)
def should(spark, sf_dir):
    clauses = [
        se.Clause("match", "text", "para only"),
        se.Clause("match", "source", "src3"),
        se.Clause("term", "lang", "de"),
    ]
    scores = se.should(_stored(spark, sf_dir), load(spark, sf_dir, "v_doc"), clauses, key="doc_id", top=110)
    return se.ranked_page(scores, "doc_id", 10, 100)


@case(
    """select persoon from v_person_json where json_valid(episoodid)
       and len(list_filter(from_json(episoodid, '[{"nimetus":"VARCHAR","aeg":"VARCHAR"}]'),
                           lambda e: e.nimetus = 'purchase' and e.aeg >= '2024-01-20')) > 0"""
)
def nested_in_cells(spark, sf_dir):
    person = load(spark, sf_dir, "v_person_json").select(
        "persoon", fn.elements(F.col("episoodid"), EPISODES).alias("episoodid")
    )
    found = se.nested(
        person, "episoodid", lambda e: (e["nimetus"] == "purchase") & (e["aeg"] >= "2024-01-20")
    )
    return found.select("persoon")


@case(
    """select distinct persoon from v_list where list = 'episoodid'
       and element ->> '$.nimetus' = 'purchase' and element ->> '$.aeg' >= '2024-01-20'"""
)
def nested(spark, sf_dir):
    return se.nested_rows(
        load(spark, sf_dir, "v_list"),
        "episoodid",
        lambda e: (e["nimetus"] == "purchase") & (e["aeg"] >= "2024-01-20"),
    )


@case(
    f"""select distinct entity_key from ({EST})
        where value_kind = 'string' and list_has_any({words('string_value')},
              ['household', 'signup'])
        order by entity_key limit 200"""
)
def entity_search(spark, sf_dir):
    def build(path):
        values = est(spark, sf_dir).filter("value_kind = 'string'").select("entity_key", "string_value")
        return se.store_words(values, ["string_value"], path, "entity_key")

    return se.entity_search(kept(spark, f"values {sf_dir}", build), "HOUSEHOLD signup", 200)


@case(
    f"select entity_key, type, item, string_value from ({EST}) where type in"
    " ('kirjed', 'episoodid')"
)
def entity_values(spark, sf_dir):
    rows = pr.entity_select(est(spark, sf_dir), ["kirjed", "episoodid"])
    return rows.select("entity_key", "type", "item", "string_value")
