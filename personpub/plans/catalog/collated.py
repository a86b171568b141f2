"""Text columns under the collation that the registry's tables have.

Case and blanks at the end do not count, and letters stand in Estonian order; joins, grouping
and order follow from the columns' type.
"""

from pyspark.sql import functions as F

from personpub.operators import persons as p
from personpub.plans.catalog.registry import case
from personpub.schemas import collated
from personpub.session import settle
from personpub.sources.bindings import load

_N = "cast(persoon as bigint)"


def _spelled(c: str) -> str:
    return f"case when {_N} % 3 = 0 then lower({c}) when {_N} % 5 = 0 then {c} || '  ' else {c} end"


_PERSON = f"""(select case when {_N} % 4 = 0 then persoon || ' ' else persoon end as persoon, evo, evokirje,
        {_spelled('perenimi')} as perenimi, {_spelled('eesnimi')} as eesnimi, {_spelled('isanimi')} as isanimi
    from v_person)"""
#: in Estonian order z stands between s and t
_KEY = "replace(lower(rtrim({})), 'z', 's~')"


def _person(spark, sf_dir):
    """Persons whose codes and names are spelled in different ways, kept with collated columns."""
    person = load(spark, sf_dir, "v_person")
    n = F.col("persoon").cast("bigint")

    def spelled(c):
        blank = F.when(n % 5 == 0, F.concat(c, F.lit("  "))).otherwise(F.col(c))
        return F.when(n % 3 == 0, F.lower(c)).otherwise(blank).alias(c)

    code = F.when(n % 4 == 0, F.concat("persoon", F.lit(" "))).otherwise(F.col("persoon")).alias("persoon")
    names = [spelled(c) for c in ("perenimi", "eesnimi", "isanimi")]
    return settle(collated(person.select(code, "evo", "evokirje", *names)))


def _plain(df, *columns):
    """Back in binary order, as results are compared."""
    return df.select(*[F.collate(c, "UTF8_BINARY").alias(c) for c in columns])


@case(
    f"""select p.persoon, case when p.evo then e.kirje else p.evokirje end as evokirje
        from {_PERSON} p left join v_evo e on rtrim(e.persoon) = rtrim(p.persoon)"""
)
def enrich_text_collated(spark, sf_dir):
    """Codes meet whatever their case and blanks."""
    evo = collated(load(spark, sf_dir, "v_evo").withColumn("persoon", F.concat("persoon", F.lit("   "))))
    found = p.enrich_text(_person(spark, sf_dir), evo)
    return _plain(found, "persoon", "evokirje")


@case(f"select persoon from {_PERSON} where rtrim(persoon) in (select persoon from v_register)")
def in_register_collated(spark, sf_dir):
    register = collated(load(spark, sf_dir, "v_register"))
    return _plain(p.in_register(_person(spark, sf_dir), register), "persoon")


@case(f"select persoon from {_PERSON} where rtrim(perenimi) = '' and rtrim(eesnimi) = ''")
def empty_names_collated(spark, sf_dir):
    """A name of blanks is an empty one."""
    return _plain(p.empty_names(_person(spark, sf_dir)), "persoon")


@case(f"select lower(rtrim(isanimi)) as isanimi, count(*) as n from {_PERSON} group by 1")
def names_grouped_collated(spark, sf_dir):
    rows = _person(spark, sf_dir).groupBy("isanimi").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.rtrim(F.lower(F.collate("isanimi", "UTF8_BINARY"))).alias("isanimi"), "n")


@case(
    f"""select persoon, cast(dense_rank() over (order by {_KEY.format('isanimi')}) as integer) as place
        from {_PERSON}"""
)
def names_sorted_collated(spark, sf_dir):
    """The places of names in Estonian order, equal for equal names."""
    person = _person(spark, sf_dir)
    places = person.select("isanimi").distinct().orderBy("isanimi")
    # names of nations, a fixed list in every scale
    listed = places.agg(F.collect_list("isanimi").alias("names")).select(F.posexplode("names").alias("at", "isanimi"))
    found = person.join(listed, "isanimi").withColumn("place", F.col("at") + 1)
    return found.select(F.collate("persoon", "UTF8_BINARY").alias("persoon"), "place")
