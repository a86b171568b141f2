"""Changes by digest, chains of codes, relatives of changed persons: small cases and plans."""

import random

import pytest
from pyspark.sql import functions as F

from personpub.operators import merge
from personpub.operators.persons import relations_json, resolve_codes
from personpub.plans.dependants import dependants
from personpub.session import settle
from personpub.sources.targets import Target, publish

ROW = "id string, a string, b string, updated long"


def test_digest_tells_nulls_and_neighbours_apart(spark):
    rows = [("1", "x", None, 0), ("2", None, "x", 0), ("3", "", "x", 0), ("4", "x", "", 0), ("5", None, None, 0),
            ("6", "", "", 0), ("7", "ab", "c", 0), ("8", "a", "bc", 0)]
    df = merge.with_digest(spark.createDataFrame(rows, ROW), "id")
    assert df.select("digest").distinct().count() == len(rows)
    assert df.filter("length(digest) <> 32").count() == 0


def test_only_real_changes(spark):
    old = settle(merge.with_digest(spark.createDataFrame([(str(i), "a", None, 1) for i in range(50)], ROW), "id"))
    new = [(str(i), "b" if i == 7 else "a", "" if i == 9 else None, 9) for i in range(45)] + [("new", None, None, 9)]
    new = spark.createDataFrame(new, ROW)
    got = {r["id"]: r["updated"] for r in merge.stamp_changes(old, new, "id", F.lit(5).cast("long")).collect()}
    assert got == {**{str(i): 5 if i in (7, 9) else 1 for i in range(45)}, "new": 5}
    real = merge.real_changes(old, new, "id", F.lit(5).cast("long"))
    assert {r["id"] for r in real.collect()} == {"7", "9", "new"}
    assert merge.real_changes(old, new.limit(0), "id", F.lit(5).cast("long")).count() == 0


def test_key_and_digest_alone_are_shuffled(spark, monkeypatch):
    """The comparison's exchanges carry two columns of each side."""
    plans = []
    real = merge.settle

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(merge, "settle", kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = real(merge.with_digest(spark.createDataFrame([("1", "a", "b", 1)], ROW), "id"))
        merge.differences(old, real(spark.createDataFrame([("1", "a", "c", 1)], ROW)), "id")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (plan,) = plans
    reads = [line.split("ReadSchema:")[1] for line in plan.splitlines() if "ReadSchema:" in line]
    assert "struct<id:string,digest:string>" in "".join(reads)
    below = [line for line in plan.splitlines() if "Project" in line]
    assert below and all("updated" not in line for line in below)


def resolved(spark, pairs):
    got = resolve_codes(spark.createDataFrame(pairs, "old string, new string"))
    return dict(map(tuple, got.changes.collect())), {r["old"]: r["reason"] for r in got.rejects.collect()}


def test_chains_and_circles(spark):
    assert resolved(spark, []) == ({}, {})
    assert resolved(spark, [("a", "b"), ("b", "c")]) == ({"a": "c", "b": "c"}, {})
    assert resolved(spark, [("a", "a"), ("b", "a"), (None, "x"), ("y", None)]) == ({"b": "a"}, {})
    circle = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("p", "q"), ("p", "q")]
    assert resolved(spark, circle) == ({"p": "q"}, dict.fromkeys("abcx", "circle"))
    assert resolved(spark, [("a", "b"), ("a", "c"), ("z", "a"), ("b", "d")]) == (
        {"b": "d"}, dict.fromkeys("az", "several codes"),
    )


@pytest.mark.parametrize("n", [1, 2, 37, 300])
def test_long_chains(spark, n):
    pairs = [(f"c{i}", f"c{i + 1}") for i in range(n)]
    random.Random(n).shuffle(pairs)
    assert resolved(spark, pairs) == ({f"c{i}": f"c{n}" for i in range(n)}, {})


def test_relatives_as_a_rebuild(spark, tmp_path):
    """Random names, deletions, new persons and relations: touched lists are those of a rebuild."""
    rng = random.Random(8)
    schema, pair = "persoon string, eesnimi string, perenimi string, updated long", "persoon string, other string, kind string"
    people = {str(i): ("E", f"P{i}") for i in range(30)}
    relations = {(str(rng.randrange(33)), str(rng.randrange(33)), rng.choice("ab")) for _ in range(60)}
    target = Target(str(tmp_path / "p"), "persoon", "updated", buckets=3)
    frame = spark.createDataFrame([(k, *v, 1) for k, v in people.items()], schema)
    publish(frame, target, "recreate")

    def rebuilt(people, relations):
        persons = spark.createDataFrame([(k, *v, 1) for k, v in people.items()], schema)
        lists = relations_json(persons, spark.createDataFrame(sorted(relations), pair))
        return {tuple(r) for r in lists.join(persons, "persoon", "left_semi").select("persoon", "code", "element").collect()}

    before = rebuilt(people, relations)
    changed = {str(i): ("E", "new") for i in (1, 2, 31)}
    gone = {"3", "4"}
    after = {k: v for k, v in {**people, **changed}.items() if k not in gone}
    added = {("5", "6", "c"), ("7", "3", "c"), ("32", "8", "c")}
    removed = set(sorted(relations)[:5])
    rows = [(k, *v, 2, False) for k, v in changed.items()] + [(k, "", "", 2, True) for k in gone]
    changes = spark.createDataFrame(rows, schema + ", _deleted boolean")
    publish(changes, target, "update")
    now = (relations - removed) | added
    frames = [spark.createDataFrame(sorted(r), pair) for r in (now, added, removed)]
    found = dependants(target, changes, *frames)
    taken = {(r["persoon"], r["code"]) for r in found.gone.collect()}
    new = {(r["persoon"], r["code"], r["element"]) for r in found.rows.collect()}
    keys = taken | {r[:2] for r in new}
    assert {r for r in before if r[:2] not in keys} | new == rebuilt(after, now)
    assert {k for k, _ in keys} <= {r[0] for r in found.owners.collect()}
