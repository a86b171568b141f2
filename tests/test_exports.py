from datetime import datetime

from pyspark.sql import functions as F

from personpub.functions import scalars as fn
from personpub.operators.documents import to_document
from personpub.operators.persons import json_failures
from personpub.schemas import LAYOUTS, export_schema
from personpub.sources.exports import read_export, write_export

# one field each: the raw bytes and what they stand for
CASES = [
    (r'"a \"q\" b"', 'a "q" b'),
    (r'"[{\"k\":\"x \\\"y\\\"\"}]"', r'[{"k":"x \"y\""}]'),
    (r'"[{\"k\":\"a\\nb\"}]"', r'[{"k":"a\nb"}]'),
    (r'"end\\"', "end\\"),
    ('"line1\nline2"', "line1\nline2"),
    (r"\N", None),
    ('""', ""),
    (r'"[{"', "[{"),
    ('"a,b"', "a,b"),
    ('"õ š ž"', "õ š ž"),
]


def _line(layout, position, raw):
    fields = [f'"c{i}"' for i in range(len(LAYOUTS[layout]))]
    fields[position] = raw
    return ",".join(fields)


def _write(path, text):
    path.mkdir()
    (path / "part-0.csv").write_text(text, encoding="utf-8")
    return str(path)


def test_reads_every_case_in_both_layouts(spark, tmp_path):
    for layout, columns in LAYOUTS.items():
        text = "".join(_line(layout, 1, raw) + "\n" for raw, _ in CASES)
        rows = read_export(spark, _write(tmp_path / layout, text), layout).collect()
        assert [r["kirje"] for r in rows] == [value for _, value in CASES]
        assert {r[columns[-1]] for r in rows} == {f"c{len(columns) - 1}"}


def test_reads_repaired_quotes(spark, tmp_path):
    text = "".join(_line("v2", 11, raw) + "\n" for raw in ('"[{""k"":""x""}]"', '"a ""q"""', r"\N"))
    rows = read_export(spark, _write(tmp_path / "r", text), repaired=True).collect()
    assert [r["kirjed"] for r in rows] == ['[{"k":"x"}]', 'a "q"', None]


def test_written_rows_read_back(spark, tmp_path):
    schema = export_schema("v2")
    data = [
        tuple([f"{i:010d}", value] + ["x"] * (len(schema) - 2))
        for i, (_, value) in enumerate(CASES)
    ]
    df = spark.createDataFrame(data, schema)
    path = write_export(df, str(tmp_path), datetime(2024, 3, 1, 12, 30, 5))
    assert path.endswith("20240301_123005_persons")
    back = read_export(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_document_of_json_kinds(spark):
    cells = ['[{"kirjekood":"1"}]', "[]", "{}", "1", "[{", None, "", '["a"]']
    blank = {c: F.lit("") for c in LAYOUTS["v2"]}
    rows = spark.createDataFrame(list(enumerate(cells)), "i int, cell string").select(
        F.col("i"),
        *[
            (F.col("cell") if c in ("kirjed", "tahvlikirje", "episoodid") else v).alias(c)
            for c, v in blank.items()
        ],
    )
    doc = to_document(rows, keep=["i"]).orderBy("i")
    assert [r["kirjed"] for r in doc.collect()] == [
        ['{"kirjekood":"1"}'], [], None, None, None, None, None, ["a"],
    ]
    parsed = [r[0] for r in doc.select(F.col("tahvlikirje").cast("string")).collect()]
    assert parsed == ['[{"kirjekood":"1"}]', "[]", "{}", "1", None, None, None, '["a"]']
    assert [r["episoodid"] is None for r in doc.collect()] == [
        False, False, True, True, True, True, True, True,
    ]
    failed = json_failures(rows.withColumn("persoon", F.col("i").cast("string")), ["kirjed"])
    assert sorted(r["persoon"] for r in failed.collect()) == ["4", "6"]


def test_json_must_be_one_whole_value(spark):
    good = ["1", "null", '"x"', "[1]", " {} ", '{"a":1,"a":2}', '[{"a":[]}]', "-1.5e3"]
    bad = ["", " ", "[1] x", "1,2", "1],[2", '1},{"a":2', "[1]],[[2]", "[", "nan", "x", "{'a':1"]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    rows = df.select(
        fn.is_json(F.col("t")).alias("j"),
        fn.is_json_list(F.col("t")).alias("l"),
        fn.parsed(F.col("t")).isNotNull().alias("p"),
    ).collect()
    assert [r["j"] for r in rows] == [True] * len(good) + [False] * len(bad)
    assert [r["p"] for r in rows] == [True] * len(good) + [False] * len(bad)
    assert [t for t, r in zip(good + bad, rows) if r["l"]] == ["[1]", '[{"a":[]}]']
    assert df.select(fn.is_json(F.lit(None).cast("string")).alias("n")).first()["n"]


def test_old_layout_has_no_episodes_and_redirect(spark, tmp_path):
    line = _line("v1", 11, '"[]"')
    rows = read_export(spark, _write(tmp_path / "old", line + "\n"), "v1")
    doc = to_document(rows).collect()[0]
    assert doc["episoodid"] is None and doc["redirect"] is None
    assert doc["kirjed"] == []
