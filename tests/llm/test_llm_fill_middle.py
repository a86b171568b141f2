"""Fill-in-middle against slices of the text, the way back, and its edge cases."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from personpub.llm.fill_middle import Blocks, fill_middle, restored


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé日😀 \n<P>", max_size=80), st.integers(1, 9))
def test_places_are_those_of_the_text(text, block):
    blocks = Blocks(text.encode(), None, block)
    assert blocks.n == len(text)
    for k in range(len(text) + 1):
        assert blocks.after(k) == (len(text[:k].encode()), k)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé日 \n", max_size=80), st.integers(1, 9))
def test_units_are_matches(text, block):
    unit = re.compile(r"\w+|\n*")
    ends = [0, *(m.end() for m in unit.finditer(text) if m.group())]
    blocks = Blocks(text.encode(), unit, block)
    assert blocks.n == len(ends) - 1
    assert [blocks.after(k) for k in range(len(ends))] == [(len(text[:e].encode()), e) for e in ends]


def brute(doc_id, text):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_rows(spark):
    texts = ["", None, "a", "<", "S>", "M><P", "ab<S>c", "é日😀" * 900, "<" * 3000, "x\0y\n" * 5000, "gleich", "gleich"]
    rows = [(i, t) for i in range(40) for t in texts] + [(None, "ohne id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'f' AS form", "2 AS h1")
    out = fill_middle(df).withColumn("back", restored(F.col("output"), F.col("form")))
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, tuple(r)[1:]) for r in out.collect()), key=repr)
    want = sorted(
        ((i is None, i or 0, (*(b := brute(i, t)), t or "")) for i, t in rows), key=repr
    )
    assert got == want
    assert {r[2][1] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle(df.limit(0)).collect() == []


def test_words_as_units(spark):
    rows = [(i, " ".join(f"wort{j}" for j in range(i * 37))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fill_middle(df, unit=r"\S+\s*").withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    texts = dict(rows)
    for r in out:
        assert r["back"] == texts[r["doc_id"]] and r["n"] == r["doc_id"] * 37
        if r["form"] == "psm":  # a part ends where a word does
            assert r["output"][3 : 3 + r["prefix_chars"]] == "" or r["output"][3 + r["prefix_chars"]] in "<w"
