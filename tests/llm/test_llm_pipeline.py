"""The pipeline on planted documents, stage by stage against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from personpub.llm.sentencepiece import pieces

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = random.Random(7)
    vocab = [f"word{i}" for i in range(4000)]
    docs, labels = [], []
    for i in range(400):
        text = rng.choices(vocab, k=rng.choice([12, 40, 120, 200]))
        if i % 8 == 0:
            text[rng.randrange(len(text))] = "vileinsult"
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 8 == 0)))
    for i in range(400, 430):  # exact copies, apart from case
        docs.append((i, docs[i - 399][1].upper()))
    for i in range(430, 470):  # near copies: a few words at the end differ
        words = docs[i - 429][1].split()
        docs.append((i, " ".join([*words[: len(words) - len(words) // 15], "new"])))
    bench = [(j, " ".join(rng.choices(vocab, k=25))) for j in range(6)]
    for i in range(470, 500):
        item = bench[i % 6][1].split()[3 : 3 + rng.choice([9, 10, 14])]
        docs.append((i, " ".join([*rng.choices(vocab, k=30), *item, *rng.choices(vocab, k=30)])))
    docs += [(500, ""), (501, None), (None, "no id here at all"), (502, "long " * 40_000)]
    folder = tmp_path_factory.mktemp("pipeline")
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), bench


def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.settle(stage(spark, out[-1], sf_dir)))
    return out


def as_dict(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage(spark, sf):
    sf_dir, bench = sf
    before, clean, exact, near, decon, coded = stages(spark, sf_dir)
    for df in (clean, exact, near, decon):
        assert df.columns == before.columns
    start = as_dict(before)
    toxic = {i for i, t in start.items() if "vileinsult" in lower(t).split()}
    left = as_dict(clean)
    assert left == {i: t for i, t in start.items() if i not in toxic}

    best = {}
    for i, t in left.items():
        if i is not None:
            best[lower(t)] = max(i, best.get(lower(t), -1))
    want = {i: t for i, t in left.items() if i is None or best[lower(t)] == i}
    left = as_dict(exact)
    assert left == want

    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    ids = sorted(i for i in left if i is not None)
    sets = {i: shingles(left[i]) for i in ids}
    comp = {i: i for i in ids}
    changed = True
    pairs = [
        (i, j) for i in ids for j in ids if i < j and sets[i] and sets[j]
        and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(comp[i], comp[j])
            changed |= comp[i] != low or comp[j] != low
            comp[i] = comp[j] = low
    left = as_dict(near)
    assert pairs and set(left) == {i for i in ids if comp[i] == i} | {None}

    wins = {tuple(b.split()[k : k + 10]) for _, b in bench for k in range(16)}

    def hit(t):
        w = lower(t).split()
        return any(tuple(w[k : k + 10]) in wins for k in range(len(w) - 9))

    want = {i for i, t in left.items() if not hit(t)}
    assert set(as_dict(decon)) == want and any(hit(t) for t in left.values())

    p = pieces()
    assert {r["doc_id"]: (r["n_ids"], r["round_trip"]) for r in coded.collect()} == {
        i: (len(p.encode(left[i])), True) for i in want
    }
    assert sorted(map(str, coded.collect())) == sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect()))


def test_rows_without_ids_and_with_shared_ones(spark, sf, tmp_path):
    """Each stage judges the row, not whatever else stands under its id."""
    rng = random.Random(3)
    vocab = [f"word{i}" for i in range(4000)]
    one, two, three, four, five = (" ".join(rng.choices(vocab, k=60)) for _ in range(5))
    near = " ".join([*three.split()[:57], "other"])
    leak = " ".join([*rng.choices(vocab, k=20), *sf[1][0][1].split(), *rng.choices(vocab, k=20)])
    rows = [
        (1, one), (9, one.upper()),  # the copy goes
        (9, two), (1, two), (1, four),  # other texts under the same ids
        (None, two),  # a copy without an id
        (3, three), (None, near), (None, None), (None, ""), (4, ""),
        (5, leak), (5, five), (None, leak.replace("word", "Word")),
        (7, "alone"), (7, "alone"), (7, "Alone"), (None, "nobody"), (None, "nobody"),
    ]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf[0]}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    _, exact, near_left, decon = [
        sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str) for df in stages(spark, str(tmp_path))[1:5]
    ]
    want = [(9, one.upper()), (9, two), (1, four), (3, three), (None, near), (4, ""), (5, leak), (5, five), (7, "Alone"), (None, "nobody")]
    assert exact == sorted(want, key=str)
    want.remove((None, near))
    assert near_left == sorted(want, key=str)
    want.remove((5, leak))
    assert decon == sorted(want, key=str)


def test_empty_documents(spark, sf, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf[0]}/{name}.parquet").filter("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and "pipeline" not in __spark_entry__.oracle_sql()


def test_filter_stages_keep_other_columns(spark, sf):
    sf_dir, _ = sf
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns(
        {c: F.lit("x") for c in ("id", "dropped_id", "key", "mark", "h", "k", "w", "rep", "th", "words", "score", "row_id", "n", "kept")}
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns, name
