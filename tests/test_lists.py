"""Lists per person and global ranks, against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators.lists import cells, list_rows
from personpub.operators.paging import first_rows, page, page_after, skip_to
from personpub.operators.persons import attach_records, attach_relations, records_json
from personpub.operators.properties import list_properties, to_entities, to_properties, unfold
from personpub.operators.ranks import running_sums, store_ordered, with_rank
from personpub.operators.search import nested_rows, orphans
from personpub.plans.rebuild import rebuild
from personpub.schemas import NAMES_EST


def _records(spark):
    rng = random.Random(5)
    codes = rng.sample(range(1, 40_000), 600)
    rows = [("hot" if i % 3 == 0 else f"p{i % 50}", f"{c:010d}") for i, c in enumerate(codes)]
    want = {}
    for person, code in sorted(rows):
        want.setdefault(person, []).append(code)
    return spark.createDataFrame(rows, "persoon string, kirjekood string"), want


def _codes(text):
    return [e["kirjekood"] for e in json.loads(text)]


def test_lists_are_rows_and_cells(spark):
    record, want = _records(spark)
    found = records_json(record)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in found.orderBy("persoon", "code").collect():
        assert r["list"] == "kirjed" and json.loads(r["element"]) == {"kirjekood": r["code"]}
        got.setdefault(r["persoon"], []).append(r["code"])
    assert got == want
    assert {r["persoon"]: _codes(r["kirjed"]) for r in cells(found, "persoon", "kirjed").collect()} == want


HOT = 100_000


@pytest.fixture(scope="module")
def hot(spark):
    """A person with very many records, one with one and one with none."""
    codes = spark.range(1, HOT + 1, 1, 8).select(
        F.lit("0000000001").alias("persoon"), F.lpad(F.col("id").cast("string"), 10, "0").alias("kirjekood")
    )
    one = spark.createDataFrame([("0000200000", "0000200000")], "persoon string, kirjekood string")
    rest = [F.lit(None).cast("string").alias(c) for c in ("kirje", "perenimi")]
    return codes.unionByName(one).select("*", F.lit("N").alias("eesnimi"), *rest).withColumn(
        "kirje", F.lit("tekst")
    )


def test_hot_person_through_every_product(spark, hot):
    persons = _person(spark, ["0000000001", "0000200000", "0000300000"])
    attached = attach_records(persons, hot)
    assert attached.filter("persoon = '0000000001'").count() == HOT
    assert attached.filter("persoon = '0000300000' AND element IS NULL").count() == 1
    evo = spark.createDataFrame([], "persoon string, kirje string")
    stone = spark.createDataFrame([], "kirjekood string, persoon string")
    relation = hot.select(F.col("persoon"), F.lit("0000200000").alias("other"), F.col("kirjekood").alias("kind"))
    built = rebuild(hot, evo, stone, relation, F.expr("timestamp_ntz'2024-03-01 00:00:00'"))
    counts = {
        (r["persoon"], r["list"]): r["n"]
        for r in built.lists.groupBy("persoon", "list").agg(F.count("*").alias("n")).collect()
    }
    assert counts == {
        ("0000000001", "kirjed"): HOT, ("0000200000", "kirjed"): 1,
        ("0000000001", "pereseosed"): HOT, ("0000200000", "pereseosed"): 1,
    }
    assert built.persons.count() == 2 and built.failures.count() == 0 and built.cuts.count() == 0
    lists = records_json(hot)
    props = to_properties(persons, NAMES_EST, "t", "f", lists).filter("type = 'kirjed'")
    found = props.groupBy("entity_key").agg(F.count("*"), F.min("item"), F.max("item")).collect()
    assert sorted(map(tuple, found)) == [("0000000001", HOT, 1, HOT), ("0000200000", 1, 200_000, 200_000)]
    entities = to_entities(persons, NAMES_EST, "t", "f", cells=False)
    assert unfold(entities, lists, NAMES_EST).filter("type = 'kirjed'").count() == HOT + 1
    live = persons.withColumn("redirect", F.lit(""))
    assert [r["persoon"] for r in orphans(live, lists).collect()] == ["0000300000"]
    codes = "array<struct<kirjekood:string>>"
    some = nested_rows(lists, "kirjed", lambda e: e["kirjekood"] == "0000000077", codes)
    assert [r["persoon"] for r in some.collect()] == ["0000000001"]


def test_no_job_runs_while_a_rebuild_is_planned(spark, hot):
    evo = spark.createDataFrame([], "persoon string, kirje string")
    stone = spark.createDataFrame([], "kirjekood string, persoon string")
    relation = hot.select("persoon", F.col("kirjekood").alias("other"), F.lit("x").alias("kind"))
    tracker = spark.sparkContext.statusTracker()
    before = max(tracker.getJobIdsForGroup(None), default=-1)
    built = rebuild(hot, evo, stone, relation, F.current_timestamp())
    assert max(tracker.getJobIdsForGroup(None), default=-1) == before
    plan = built.persons._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 10


def test_lists_of_unpublished_persons_give_no_property(spark):
    lists = list_rows(
        spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "x/3")], "persoon string, code string"),
        "persoon", "code", F.lit("{}"), "episoodid",
    )
    owners = spark.createDataFrame([("a",)], "persoon string")
    got = list_properties(owners, lists, NAMES_EST).collect()
    assert sorted((r["entity_key"], r["type"], r["item"]) for r in got) == [("a", "episoodid", 0), ("a", "episoodid", 1)]


def _person(spark, keys):
    from personpub.operators.persons import fill_defaults
    from personpub.schemas import FLAGS, PERSON_COLUMNS

    df = spark.createDataFrame([(k,) for k in keys], "persoon string")
    rest = [c for c in PERSON_COLUMNS if c not in ("persoon", "kirje", "eesnimi")]
    return fill_defaults(
        df.select(
            "persoon", F.lit("tekst").alias("kirje"),
            F.concat(F.lit("N"), "persoon").alias("eesnimi"),
            *[F.lit(None).cast("boolean" if c in FLAGS else "string").alias(c) for c in rest],
        )
    )


def test_relations_for_some_persons_only(spark):
    person = _person(spark, ["a", "b", "c"])
    relation = spark.createDataFrame(
        [("a", "b", "spouse"), ("a", "b", "spouse"), ("a", "b", "child"), ("b", "c", "child"), ("c", "x", "child")],
        "persoon string, other string, kind string",
    )

    def found(df):
        return sorted((r["persoon"], r["code"], json.loads(r["element"] or "null")) for r in df.collect())

    a = [("a", f"b/{k}", {"persoon": "b", "kind": k, "nimi": "Nb"}) for k in ("child", "spouse")]
    c = [("c", None, None)]  # the other person is not known
    every = found(attach_relations(person, relation).fillna("", ["code"]))
    assert [r for r in every if r[0] == "a"] == a
    keys = spark.createDataFrame([("a",), ("c",)], "persoon string")
    assert found(attach_relations(person, relation, keys)) == a + c


def test_ranks_and_pages(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(3)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    want = sorted(rows, key=lambda r: (r[1], r[0]))
    ranked = with_rank(df, ["v", "k"]).orderBy("rank").collect()
    assert [(r["k"], r["v"]) for r in ranked] == want
    assert [r["rank"] for r in ranked] == list(range(1, 501))
    split = with_rank(df, ["v", "k"], rows=9).orderBy("rank").collect()  # 56 ranges
    assert [tuple(r) for r in split] == [tuple(r) for r in ranked]
    past = page(df, ["v", "k"], 10, 495).collect()
    assert [(r["k"], r["v"]) for r in past] == want[495:]
    assert page(df, ["k"], 10, 600).collect() == []
    assert [r["k"] for r in page_after(df, "k", 489, 100).collect()] == list(range(490, 500))
    assert [r["k"] for r in page_after(df, "k", None, 3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("rows", [1, 7, 100_000])
def test_ranks_in_ranges(spark, rows):
    """Bounds looked up in two steps, nulls first, and no rows at all."""
    df = spark.range(3000).selectExpr("cast(id as string) as k", "if(id % 11 = 0, null, id % 40) as v")
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    got = with_rank(df.repartition(5), ["v", "k"], rows=rows).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 3001))
    assert [(r["k"], r["v"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert with_rank(df.limit(0), ["v", "k"], rows=rows).collect() == []


def test_a_page_reads_the_ranges_that_hold_it(spark, tmp_path):
    rows = [(i, (i * 7) % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    want = sorted(rows, key=lambda r: (r[1], r[0]))
    table = store_ordered(df, ["v", "k"], str(tmp_path / "o"), rows=40)
    index = sorted(map(tuple, table.index().collect()))
    assert len(index) > 5 and [s for _, _, s in index] == [sum(n for _, n, _ in index[:i]) for i in range(len(index))]
    for size, offset in ((10, 480), (1, 0), (60, 33), (500, 0), (10, 495), (10, 500), (10, 900)):
        page = skip_to(table, size, offset).orderBy("rank").collect()
        assert [(r["rank"], r["k"], r["v"]) for r in page] == [
            (i + 1, *want[i]) for i in range(offset, min(offset + size, 500))
        ]
    deep = skip_to(table, 10, 480)
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "range" in plan.split("PartitionFilters: [")[1].split("]")[0]
    held = {f.split("range=")[1].split("/")[0] for f in deep.inputFiles()}
    assert len(held) <= len(index)
    assert store_ordered(df.limit(0), ["v", "k"], str(tmp_path / "none")).page(5, 0).collect() == []


@pytest.mark.parametrize("n", [0, 1, 90, 9_999, 10_001, 30_000, None])
def test_first_rows_are_exact_and_sorted(spark, n):
    df = spark.range(20_000).selectExpr("id % 15000 as id", "cast(if(id % 5 = 0, null, id % 7) as int) as v")
    got = [tuple(r) for r in first_rows(df.repartition(7), ["v", "id"], n).collect()]
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert got == want[:n] if n is not None else sorted(got, key=str) == sorted(want, key=str)


def test_running_sums_over_blocks(spark, monkeypatch):
    from personpub.operators import ranks

    monkeypatch.setattr(ranks, "STEP", 4)
    df = spark.range(23).selectExpr("id as step", "id * id as x")
    got = {r["step"]: r["x"] for r in running_sums(df, "step", ["x"]).collect()}
    assert got == {i: sum(j * j for j in range(i + 1)) for i in range(23)}
