import json
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators.bitmaps import find_entities, store_properties
from personpub.operators.merge import upsert
from personpub.operators.persons import classify, fill_defaults, split_publishable
from personpub.operators.properties import (
    entity_find,
    patch_properties,
    pending,
    sync_step,
    to_properties,
    unfold,
)
from personpub.plans.sync import run_sync, sync_targets
from personpub.schemas import FLAGS, NAMES_ENG, NAMES_EST, PERSON_COLUMNS
from personpub.sources.targets import read_target

GOOD = {"kirje": "Mari Kask", "eesnimi": "Mari", "perenimi": "Kask"}


def _persons(spark, *rows):
    kinds = {**{c: "string" for c in PERSON_COLUMNS}, **{c: "boolean" for c in FLAGS}}
    schema = ", ".join(f"{c} {kinds[c]}" for c in PERSON_COLUMNS)
    data = [tuple(r.get(c) for c in PERSON_COLUMNS) for r in rows]
    df = fill_defaults(spark.createDataFrame(data, schema))
    return df.withColumn("updated", F.col("updated").cast("timestamp_ntz"))


def _types(spark, person, names=NAMES_EST, **options):
    rows = to_properties(_persons(spark, person), names, "T", "F", **options)
    return [
        (r["type"], r["string_value"] or r["reference_value"] or r["boolean_value"])
        for r in rows.orderBy("pos", "item").collect()
    ]


def test_reasons_and_their_order(spark):
    cases = [
        ({"persoon": None, **GOOD}, "no code"),
        ({"persoon": "", "redirect": "2"}, "no code"),
        ({"persoon": "1", "redirect": "2"}, None),
        ({"persoon": "1", "kirje": None}, "no text"),
        ({"persoon": "1", "kirje": ""}, "no text"),
        ({"persoon": "1", "kirje": "12-34"}, "no letter in text"),
        ({"persoon": "1", "kirje": "šž"}, "no letter in text"),
        ({"persoon": "1", "kirje": "õ"}, "no name"),
        ({"persoon": "1", "kirje": "a", "eesnimi": "A"}, None),
        ({"persoon": "1", "kirje": "a", "perenimi": "B"}, None),
    ]
    df = _persons(spark, *[c for c, _ in cases]).coalesce(1)
    assert [r["reject_reason"] for r in classify(df).collect()] == [w for _, w in cases]
    wider = classify(df, letters=r"\p{L}").collect()
    assert wider[6]["reject_reason"] == "no name"
    good, bad = split_publishable(df)
    assert good.count() + bad.count() == len(cases)


def test_redirect_has_three_properties(spark):
    person = {"persoon": "1", "redirect": "2", "kivi": True, **GOOD}
    assert _types(spark, person) == [("_type", "T"), ("persoon", "1"), ("redirect", "2")]


def test_values_flags_and_lists(spark):
    person = {
        "persoon": "1", **GOOD, "kivi": True, "emem": False, "mv": None, "emanimi": "",
        "kirjed": '[{"a":1},{"a":"x\\ny"}]', "pereseosed": "[{", "episoodid": "{}",
        "tahvlikirje": "{}", "updated": "2024-01-01 10:00:00",
    }
    assert _types(spark, person) == [
        ("_type", "T"), ("persoon", "1"), ("kirje", "Mari Kask"), ("eesnimi", "Mari"),
        ("perenimi", "Kask"), ("kirjed", '{"a":1}'), ("kirjed", '{"a":"x\\ny"}'),
        ("kivi", True), ("updated", "2024-01-01 10:00:00"), ("_parent", "F"),
    ]


def test_indented_elements(spark):
    person = {"persoon": "1", **GOOD, "kirjed": '[{"a":1,"b":"x"}]'}
    found = dict(_types(spark, person, indent=True))
    assert found["kirjed"] == '{\n  "a": 1,\n  "b": "x"\n}'


def test_other_names_and_whole_lists(spark):
    person = {
        "persoon": "1", **GOOD, "wwiiref": True, "kirjed": "[]", "pereseosed": "[]",
        "episoodid": "[{}]", "tahvlikirje": '{"k":1}',
    }
    assert _types(spark, person, NAMES_ENG, explode=False) == [
        ("_type", "T"), ("persoon", "1"), ("kirje", "Mari Kask"), ("surname", "Kask"),
        ("forename", "Mari"), ("kirjed", "[]"), ("tahvlikirje", '{"k":1}'),
        ("episoodid", "[{}]"), ("wwii", True), ("_parent", "F"),
    ]


def test_find_by_values_and_emptiness(spark):
    persons = _persons(
        spark,
        {"persoon": "1", **GOOD},
        {"persoon": "2", "kirje": "x", "perenimi": "Kask"},
        {"persoon": "3", "kirje": "x", "eesnimi": "Mari"},
    )
    props = to_properties(persons, NAMES_EST, "T", "F")

    def find(**conditions):
        return sorted(r[0] for r in entity_find(props, conditions).collect())

    assert find(perenimi="Kask") == ["1", "2"]
    assert find(perenimi="Kask", eesnimi="Mari") == ["1"]
    assert find(eesnimi="") == ["2"]
    assert find(_type="T", perenimi="") == ["3"]


@pytest.mark.parametrize("n", [40, 70_000])
def test_bitmaps_find_the_same(spark, tmp_path, n):
    """Over several bitmaps, with conditions that most, few or no entities meet."""
    ids = spark.range(n)
    rows = ids.selectExpr("concat('e', id) as entity_key", "'_type' as type", "'T' as reference_value")
    for name, value in {"a": "if(id % 3 = 0, 'x', 'y')", "a2": "if(id % 7 = 0, 'z', 'y')", "b": "if(id % 2 = 0, '', concat('v', id % 5))"}.items():
        more = ids.selectExpr("concat('e', id) as entity_key", f"'{name.rstrip('2')}' as type", f"{value} as string_value")
        rows = rows.unionByName(more, allowMissingColumns=True)
    more = ids.selectExpr("concat('e', id) as entity_key", "'c' as type", "id % 4 = 0 as boolean_value")
    rows = rows.unionByName(more, allowMissingColumns=True)
    rows = rows.filter("NOT (type = 'b' AND entity_key LIKE '%9')")
    table = store_properties(rows, str(tmp_path / "p"))
    for conditions in (
        {"a": "x"}, {"a": "x", "c": "true"}, {"a": "z", "b": ""}, {"_type": "T", "b": "", "c": "false"}, {"b": ""},
        {"b": "v3", "a": "y", "_type": "T"}, {"a": "none"}, {"a": "x", "none": ""}, {"a": "", "b": ""},
    ):
        want = entity_find(rows, conditions)
        got = find_entities(table, conditions)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_no_property_row_is_shuffled(spark, tmp_path):
    rows = spark.sql("SELECT 'e' AS entity_key, '_type' AS type, 'T' AS string_value, false AS boolean_value, '' AS reference_value")
    table = store_properties(rows, str(tmp_path / "p"))
    found = find_entities(table, {"_type": "T", "a": "x", "b": ""})
    plan = found._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            by = line.split("hashpartitioning(")[1].split("#")[0]
            assert by in ("_groupingexpression", "bucket", "no")
    assert "bitmap_construct_agg" in plan and found.collect() == []


def test_sync_keeps_ids_and_sets_rejects_aside(spark):
    persons = _persons(
        spark,
        {"persoon": "1", **GOOD, "updated": "2024-01-01 00:00:01"},
        {"persoon": "2", **GOOD, "updated": "2024-01-01 00:00:02"},
        {"persoon": "3", "kirje": "12", "updated": "2024-01-01 00:00:03"},
        {"persoon": "4", **GOOD, "updated": "2024-01-01 00:00:04"},
        {"persoon": "5", **GOOD, "updated": "2024-01-01 00:00:05"},
    )
    sync = spark.createDataFrame(
        [("1", "known", None), ("2", "done", datetime(2024, 2, 1))],
        "persoon string, entu_id string, sync_ts timestamp_ntz",
    )
    step = sync_step(persons, sync, NAMES_EST, "T", "F", F.lit("2024-03-01").cast("timestamp_ntz"), n=3)
    after = upsert(sync, step.done, "persoon")
    state = {r["persoon"]: r["entu_id"] for r in after.collect()}
    assert state["1"] == "known" and state["2"] == "done"
    assert set(state) == {"1", "2", "4"}
    assert [r["persoon"] for r in step.rejects.collect()] == ["3"]
    keys = {r[0] for r in step.entities.select("entity_key").distinct().collect()}
    assert keys == {"1", "4"}
    again = pending(persons, after, step.rejects)
    assert [r["persoon"] for r in again.collect()] == ["5"]
    changed = persons.withColumn("updated", F.lit("2024-05-01").cast("timestamp_ntz"))
    assert "3" in {r[0] for r in pending(changed, after, step.rejects).collect()}


def test_stored_runs(spark, tmp_path):
    rows = [{"persoon": str(i), **GOOD, "updated": f"2024-01-01 00:00:0{i}"} for i in range(1, 6)]
    rows[1]["kirje"] = "12"
    entities, state, rejects = sync_targets(str(tmp_path), buckets=2)

    def run(n, *persons):
        now = F.lit("2024-03-01").cast("timestamp_ntz")
        run_sync(
            _persons(spark, *persons), entities, state, rejects, NAMES_EST, "T", "F", now, n
        )
        return sorted(r["persoon"] for r in read_target(spark, state).collect())

    assert run(3, *rows) == ["1", "3"]
    assert run(3, *rows) == ["1", "3", "4", "5"]
    assert run(3, *rows) == ["1", "3", "4", "5"]
    assert [r["persoon"] for r in read_target(spark, rejects).collect()] == ["2"]
    rows[1] |= {"kirje": "text", "updated": "2024-01-02 00:00:00"}
    assert run(3, *rows) == ["1", "2", "3", "4", "5"]
    props = unfold(read_target(spark, entities))
    assert props.filter("type = 'kirje'").count() == 5


def test_patch_is_for_pending_only(spark):
    sync = spark.createDataFrame(
        [("1", "a", None), ("2", "b", datetime(2024, 2, 1))],
        "persoon string, entu_id string, sync_ts timestamp_ntz",
    )
    rows = patch_properties(sync, "_inheritrights", True).collect()
    assert [(r["entity_key"], r["boolean_value"]) for r in rows] == [("a", True)]


def test_order_and_case_of_estonian(spark):
    words = ["ü", "z", "t", "õ", "s", "a", "ž", "ä", "š", "ö"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r["w"] for r in df.orderBy(fn.estonian(F.col("w"))).collect()]
    assert got == ["a", "s", "š", "z", "ž", "t", "õ", "ä", "ö", "ü"]
    same = df.select(
        (fn.estonian(F.lit("Õun ")) == fn.estonian(F.lit("õun"))).alias("x")
    ).first()["x"]
    assert same
    binary = [r["w"] for r in df.orderBy("w").collect()]
    assert binary == sorted(words)


def test_pretty_and_one_line(spark):
    row = spark.range(1).select(
        fn.pretty(F.lit('{"b":"x \\"y\\"","a":[1,2],"c":null}')).alias("p"),
        fn.pretty(F.lit("[1]")).alias("q"),
        fn.one_line(F.lit(" a\r\n\nb\n")).alias("o"),
    ).first()
    assert row["p"] == '{\n  "b": "x \\"y\\"",\n  "a": [\n    1,\n    2\n  ],\n  "c": null\n}'
    assert row["q"] == "[\n  1\n]" and row["o"] == "a b"


def test_pretty_is_that_of_the_json_library(spark):
    values = [
        {}, [], {"a": {}}, {"a": []}, [[], [[]], {}], {"a": {"b": [1, {"c": "x, {y}: [z]"}, None, True, -1.5]}, "d": "\\"},
        {"t": "line\nend \" quote"}, [{"k": "é"}] * 3,
    ]
    rows = [(json.dumps(v, ensure_ascii=False, separators=(",", ":")), json.dumps(v, ensure_ascii=False, indent=2)) for v in values]
    rows += [(json.dumps(v, ensure_ascii=False, indent=5), json.dumps(v, ensure_ascii=False, indent=2)) for v in values]
    rows += [("1", "1"), ('"x"', '"x"'), ("{", "{"), (None, None), ("[1,", "[1,")]
    df = spark.createDataFrame(rows, "c string, want string")
    assert df.select(fn.pretty(F.col("c")).alias("got"), "want").filter("NOT got <=> want").collect() == []
