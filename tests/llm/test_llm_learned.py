"""Toxicity and language: held-out quality, the machine against its formula, edges."""

import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from personpub.llm.common import drawn, held_out
from personpub.llm.language_id import DIM, Space, identify, op7_language_id
from personpub.llm.toxicity import BUCKETS, Machine, fit_machine, op1_toxicity, score_documents, terms

SF = "/root/testdata/sf0.1"


def test_held_out_is_the_crc_rule(spark):
    ids = [0, 1, 7, 123456789, -5]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", held_out(F.col("doc_id"))).collect()}
    assert got == {i: crc32(str(i).encode()) % 5 == 0 for i in ids} | {None: True}


def test_toxicity_on_held_out_rows(spark):
    got = op1_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert hit / sum(r["toxic"] == 1 for r in rows) > 0.83  # some labels have no cause in the text
    assert hit / sum(r["predicted"] == 1 for r in rows) > 0.95
    assert got.filter("NOT score BETWEEN 0 AND 1 OR predicted <> int(score >= 0.5)").count() == 0


def test_language_on_held_out_rows(spark):
    got = op7_language_id(spark, SF)
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(langs, "doc_id").filter("lang IS NOT NULL").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert got.filter("NOT score BETWEEN 0 AND 1").count() == 0


def test_machine_learns_a_pair_that_no_word_tells():
    """Insult and group are harmless alone; together they are toxic."""
    rng = random.Random(3)
    buckets = np.arange(6)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        noise = [i for i in range(2, 6) if rng.random() < 0.5]
        rows.append(np.array([0] * a + [1] * b + noise, dtype=np.int64))
        labels.append(float(a and b))
    m = fit_machine(rows, np.array(labels), buckets)
    for r, y in zip(rows[:200], labels):
        v = m.factors[r]
        pairs = sum(float(v[i] @ v[j]) for i in range(len(r)) for j in range(i))
        x = m.bias + m.weights[r].sum() + pairs
        assert (x > 0) == (y > 0.5)
    both = m.factors[0] @ m.factors[1]
    assert both > 0


def test_terms_read_the_whole_text():
    assert terms(None).size == terms("").size == terms("...").size == 0
    assert set(terms("Idiot idiot")) == {crc32(b"idiot") % BUCKETS}
    assert crc32(b"end") % BUCKETS in terms("pad " * 50_000 + "end")


DOCS = "doc_id long, text string, lang string, source string, n_chars long, toxic int, score string, buckets int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 1, 9, "x", 3) for i, t, g in rows], DOCS)


def test_toxicity_edges(spark):
    docs = [(i, "vile words here" if i % 3 == 0 else "mild words here", "en") for i in range(300)]
    docs += [(1000, None, None), (1001, "", None), (None, "vile", None), (0, "vile words here", "en"), (1002, "vile " + "x " * 100_000, "en")]
    df = frame(spark, docs)
    labels = spark.createDataFrame(
        [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(0, 1, 1), (None, 1, 1), (5, 1, None), (9999, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = score_documents(df, labels).collect()
    assert len(got) == len(docs)
    by = {r["doc_id"]: r for r in got}
    assert by[3]["predicted"] == 1 and by[4]["predicted"] == 0 and by[1002]["predicted"] == 1
    assert by[1000]["score"] == by[1001]["score"] and by[None]["held_out"]
    for none in (labels.filter("false"), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        scores = {r["score"] for r in score_documents(df, none).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1
    assert score_documents(df.filter("false"), labels).collect() == []


@pytest.mark.parametrize(
    "toxic",
    [lambda a, b: a == b, lambda a, b: a and not b],
    ids=["neutral alone", "clean alone"],
)
def test_learn_keeps_terms_that_tell_nothing_or_clean_alone(spark, toxic):
    """One term of the pair alone is no sign of a toxic text, or one of a clean text."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(2500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = ["insult"] * a + ["quoted"] * b + [f"w{rng.randrange(400)}" for _ in range(20)]
        rng.shuffle(words)
        docs.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic(a, b))))
    want = {i: y for i, _, y in labels}
    got = score_documents(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = got.filter("held_out").collect()
    assert sum(r["predicted"] == want[r["doc_id"]] for r in rows) / len(rows) > 0.95


def test_toxicity_recall(spark):
    rows = op1_toxicity(spark, SF).filter("held_out").join(
        spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").select("doc_id"), "doc_id"
    )
    assert rows.agg(F.avg("predicted")).first()[0] > 0.9


def test_language_edges(spark):
    docs = [(i, "the cat and the dog", "en") for i in range(40)] + [(100 + i, "der hund und die katze", "de") for i in range(40)]
    docs += [(300, None, "en"), (301, "", "en"), (302, "123 ... ☃", "en"), (None, "und die", None), (303, "THE", None), (304, "the " * 100_000, None), (303, "THE", None)]
    got = identify(frame(spark, docs)).collect()
    assert len(got) == len(docs)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert {by[i][0] for i in range(40)} == {"en"} and {by[100 + i][0] for i in range(40)} == {"de"}
    assert by[300] == by[301] == by[302] == ("und", 0.0)
    assert by[303][0] == by[304][0] == "en" and by[None][0] == "de"
    nothing = identify(frame(spark, [(i, t, None) for i, t, _ in docs])).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert identify(frame(spark, docs).filter("false")).collect() == []


@pytest.mark.parametrize("text", ["abc", "a", "Ab cd  ef", "été à l'œuf " * 40, "z" * 9000])
def test_vector_is_the_bundle_of_bound_letters(text):
    s = Space()
    symbols = [0]
    for c in text.lower():
        x = int(s.symbol[ord(c)])
        if x or symbols[-1]:
            symbols.append(x)
    if symbols[-1]:
        symbols.append(0)
    want = np.zeros(DIM)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        want += np.roll(s.at[2][a], 2).astype(int) * np.roll(s.at[2][b], 1) * s.at[2][c]
    assert np.array_equal(s.vector(text), want)
    assert np.array_equal(s.vector(text), want)  # from vectors kept ready


def test_more_trigrams_than_are_kept_ready(monkeypatch):
    monkeypatch.setattr("personpub.llm.language_id.READY", 50)
    small = Space()
    monkeypatch.undo()
    text = " ".join("".join(p) for p in zip("abcdefghijklm" * 9, "nopqrstuvwxyz" * 7 + "abc" * 20))
    assert np.array_equal(small.vector(text), Space().vector(text))


@pytest.mark.parametrize("total", [50_000, 10**11, 10**14])
def test_a_sample_has_its_share_of_any_total(spark, total):
    """Of n keys that stand for `total` rows, the rate leaves n * rows / total, never none by rounding."""
    n, rows = 200_000, total // 20
    ids = spark.range(n)
    assert abs(ids.filter(drawn(F.col("id"), rows, total)).count() - n / 20) < n / 200
    assert 0 < ids.filter(drawn(F.col("id"), 20_000 * total // n // 200, total)).count() < n / 50
    assert ids.filter(drawn(F.col("id"), total, total)).count() == n


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    place = np.full(BUCKETS, -1, dtype=np.int32)
    words = [f"wort{i}" for i in range(40)]
    known = np.unique([crc32(w.encode()) % BUCKETS for w in words[:30]])
    place[known] = np.arange(known.size)
    m = Machine(place, 0.3, rng.normal(0, 0.4, known.size), rng.normal(0, 0.4, (known.size, 8)))
    for _ in range(50):
        text = " ".join(rng.choice(words, rng.integers(0, 25)))
        rows = [int(place[b]) for b in sorted({crc32(w.encode()) % BUCKETS for w in text.split()}) if place[b] >= 0]
        rows += [int(place[b]) for b in {crc32(f"{w[:5]}-".encode()) % BUCKETS for w in text.split() if len(w) > 5} if place[b] >= 0]
        x = m.bias + sum(m.weights[r] for r in rows)
        x += sum(float(m.factors[a] @ m.factors[b]) for i, a in enumerate(rows) for b in rows[:i])
        assert abs(m.score(text) - 1 / (1 + np.exp(-x))) < 1e-9


def test_sample_is_gathered_in_one_array(spark):
    """By id, whatever the order of the rows; rows without terms and tables without rows are held too."""
    from personpub.llm.toxicity import _gathered

    rows = [(7, 1, [3, 5, 9]), (2, 0, []), (4, 0, [1])]
    got = [(i, t, bytearray(np.array(b, dtype="<i4").tobytes())) for i, t, b in rows]
    df = spark.createDataFrame(got, "doc_id long, toxic int, buckets binary")
    labels, flat, ends = _gathered(df)
    assert labels.tolist() == [0, 0, 1] and flat.tolist() == [1, 3, 5, 9] and ends.tolist() == [0, 0, 1, 4]
    for none in (df.limit(0), df.filter("doc_id = 2")):
        labels, flat, ends = _gathered(none)
        assert flat.size == 0 and ends.tolist() == [0] * (labels.size + 1)
