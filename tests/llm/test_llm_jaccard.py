"""The n-gram Jaccard join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from personpub.llm import jaccard
from personpub.llm.jaccard import candidates, components, jaccard_components, named_bits, reach, root_keys
from personpub.llm.shingles import mix, shingle_sets


def brute(pairs, percent, k):
    sets = []
    for _, t in pairs:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if common and 100 * common >= percent * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        root = find(i)
        least[root] = doc if root not in least else min(least[root], doc)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(pairs))


def corpus(seed, n=220):
    """Bases of very different lengths, their edited copies, a passage and a line that many share."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocab, k=80)
    out = []
    while len(out) < n:
        base = rng.choices(vocab, k=rng.choice([1, 2, 3, 4, 5, 7, 12, 30, 66, 70, 130, 300, 900]))
        if rng.random() < 0.3:
            base = base + passage
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice([0, 0.01, 0.02, 0.04, 0.05]))):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            if rng.random() < 0.3:
                copy = copy[: max(1, int(len(copy) * 0.9))]
            out.append(" ".join(copy))
    ids = rng.sample(range(10_000), len(out))
    return list(zip(ids, out))


def frame(spark, pairs):
    schema = "doc_id long, text string, k long, key string, n string, a int, b int, rep string"
    return spark.createDataFrame([(i, t, 1, "x", "y", 1, 2, "z") for i, t in pairs], schema)


@pytest.mark.parametrize("percent,words,seed", [(85, 4, 1), (80, 5, 2), (60, 4, 3)])
def test_components_equal_brute_force(spark, percent, words, seed):
    pairs = corpus(seed)
    got = jaccard_components(frame(spark, pairs), percent, words).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == brute(pairs, percent, words)


def test_group_whose_leader_links_to_few(spark, monkeypatch):
    """Copies far from each other, near to one base: they need the second comparison, in small blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    pairs = [(500, " ".join(base))]
    for i in range(40):
        copy = list(base)
        for j in rng.sample(range(200), 4):
            copy[j] = f"x{i}-{j}"
        pairs.append((i, " ".join(copy)))
    for i in range(40):  # a chain: each links only with its neighbours
        pairs.append((1000 + i, " ".join(f"c{j}" for j in range(5 * i, 5 * i + 130))))
    got = jaccard_components(frame(spark, pairs)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == brute(pairs, 85, 4)


@pytest.mark.parametrize("percent,words,seed", [(85, 4, 6), (80, 5, 7)])
def test_common_keys_are_passed_over_without_loss(spark, monkeypatch, percent, words, seed):
    """With every key named that two sampled texts share, some texts have enough other keys and some do not."""
    monkeypatch.setattr(jaccard, "SAMPLE", 2)
    monkeypatch.setattr(jaccard, "LEAST", 2)
    pairs = corpus(seed, 160)
    got = jaccard_components(frame(spark, pairs), percent, words).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == brute(pairs, percent, words)


def test_linked_sets_share_a_key_whatever_is_named():
    """Also where the filter names nothing, some keys, nearly all or all of them."""
    rng = np.random.default_rng(11)
    for percent in (80, 85):
        for n in (3, 20, 70, 400, 3000):
            base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            gone = int(base.size * (100 - percent) / 100)
            sets = [base]
            for _ in range(6):
                kept = np.delete(base, rng.choice(base.size, rng.integers(0, gone + 1), replace=False))
                more = rng.integers(0, 1 << 63, rng.integers(0, gone + 1), dtype=np.uint64)
                sets.append(np.unique(np.append(kept, more)))
            sizes = np.array([s.size for s in sets])
            every, _ = root_keys(np.concatenate(sets), sizes, percent, every=True)
            for share in (0, 0.3, 0.9, 1):
                named = named_bits(rng.permutation(every)[: int(every.size * share)])
                keys, n_keys = root_keys(np.concatenate(sets), sizes, percent, named)
                parts = [set(k.tolist()) for k in np.split(keys, np.cumsum(n_keys)[:-1])]
                for i, a in enumerate(sets):
                    for j in range(i):
                        common = np.intersect1d(a, sets[j]).size
                        if common and 100 * common >= percent * (a.size + sets[j].size - common):
                            assert parts[i] & parts[j], (percent, n, share)


def test_pairs_are_given_once(spark, monkeypatch):
    """Groups of near copies just below the threshold: the step's rows do not grow with the shared keys."""
    made = []
    real = jaccard._verified

    def count(pairs, *args):
        made.append(pairs.count())
        return real(pairs, *args)

    monkeypatch.setattr(jaccard, "_verified", count)
    rng = random.Random(12)
    rows = {}
    for size in (20, 60):
        base = [f"b{i}" for i in range(200)]
        pairs = []
        for i in range(size):
            copy = list(base)
            for at in rng.sample(range(200), 3):
                copy[at] = f"x{i}.{at}"
            pairs.append((i, " ".join(copy)))
        got = jaccard_components(frame(spark, pairs), 85, 4).select("doc_id", "n_shingles", "component_id")
        assert sorted(map(tuple, got.collect())) == brute(pairs, 85, 4)
        rows[size] = made[-1]
    assert rows[60] <= 60 * 59 / 2


def test_met_before():
    big = np.iinfo(np.int64).max
    lower = np.array([[1, 5, 9, big], [2, 5, big, big], [9, 10, 11, big]])
    x, y = np.array([0, 0, 1]), np.array([1, 2, 2])
    assert jaccard.met_before(lower, x, y, 6).tolist() == [True, False, False]
    assert jaccard.met_before(lower, x, y, 5).tolist() == [False, False, False]
    assert jaccard.met_before(lower, x, y, 10).tolist() == [True, True, False]


def test_edge_cases(spark):
    pairs = [
        (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "One"), (5, "one"), (6, "a b c"), (7, "A  B\nC"),
        (8, "a b c d"), (9, "b a c d"), (10, "a b c d e"), (10, "a b c d e"), (None, "ONE"), (15, "a\u00a0b c d e"),
        (11, "word " * 60_000), (12, "word " * 50_000), (13, "É b c d"), (14, "é b c d"),
    ]
    got = {
        (r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(frame(spark, pairs)).collect()
    }
    assert got == {
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6), (8, 1, 8), (9, 1, 9),
        (10, 2, 10), (None, 1, 4), (11, 1, 11), (12, 1, 11), (13, 1, 13), (14, 1, 14),
        (15, 1, 15),  # only ASCII white space parts words
    }
    assert jaccard_components(frame(spark, pairs)).count() == len(pairs)


def test_empty_table_and_no_links(spark):
    assert jaccard_components(frame(spark, [(1, "a")]).filter("false")).collect() == []
    got = jaccard_components(frame(spark, [(2, "a b c d e"), (1, "f g h i j")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (2, 2)]


def test_components_of_a_long_path(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(900, 901), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(n)} | {900: 900, 901: 900}


def test_sets_do_not_depend_on_batches_and_steps(monkeypatch):
    texts = [t for _, t in corpus(9, 60)] + ["", None, "x" * 5000, "  a  " * 700]

    def sets(parts):
        out = []
        for part in parts:
            for _, _, h, sizes in shingle_sets(pa.array(part, pa.string())):
                out += [x.tolist() for x in np.split(h, np.cumsum(sizes)[:-1])]
        return out

    whole = sets([texts])
    assert sets([[t] for t in texts]) == whole
    monkeypatch.setattr("personpub.llm.shingles.STEP", 700)
    assert sets([texts]) == whole
    assert sets([pa.array(["pad", *texts])[1:].to_pylist()]) == whole


@pytest.mark.parametrize("step", [16, 100, 5000])
def test_words_that_end_near_the_end_of_the_buffer(monkeypatch, step):
    """A step may begin within a word whose end is less than the search's stride before the last byte."""
    from personpub.llm import shingles

    rng = random.Random(step)
    texts = [" ".join("x" * rng.choice([1, 30, 4000, 4096, 4097, 9000]) + str(i) for i in range(rng.randint(0, 9))) for _ in range(12)]
    want = [s[2].tolist() for s in shingle_sets(pa.array(["".join(texts[:5]), *texts]))]
    monkeypatch.setattr(shingles, "STEP", step)
    got = [s[2].tolist() for s in shingle_sets(pa.array(["".join(texts[:5]), *texts]))]
    assert sum(got, []) == sum(want, [])


def test_linked_sets_share_a_root_key():
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        for n in [*range(1, 90), 127, 128, 149, 150, 255, 300, 1000, 1700]:
            a = mix(rng.integers(1 << 62, size=n).astype(np.uint64))
            for _ in range(3):
                # as many differences as may be, on one side or on both
                r = (100 - percent) * 2 * n // (100 + percent)
                drop = int(rng.integers(r + 1))
                b = np.append(a[: n - drop], mix(rng.integers(1 << 62, size=r - drop).astype(np.uint64)))
                common = n - drop
                if 100 * common < percent * (n + b.size - common):
                    continue
                pair = [np.unique(a), np.unique(b)]
                keys, counts = root_keys(np.concatenate(pair), np.array([p.size for p in pair]), percent)
                x, y = np.split(keys, [counts[0]])
                assert np.intersect1d(x, y).size, (percent, n, drop)


def test_boxes_exclude_only_what_the_bound_excludes():
    rng = np.random.default_rng(8)
    n_points = 150
    points = rng.poisson(2, (n_points, jaccard.DIMS)).astype("<u2")
    points[100:] = np.maximum(points[:50].astype(int) - (rng.random((50, jaccard.DIMS)) < 0.05), 0)
    n = points.sum(axis=1).astype(np.int64)
    comp = rng.integers(0, 60, n_points)
    for side in (np.zeros(n_points, int), rng.integers(0, 2, n_points)):
        got = {tuple(sorted(p)) for x, y in candidates(points, n, comp, side) for p in zip(x.tolist(), y.tolist())}
        want = {
            (i, j)
            for i in range(n_points)
            for j in range(i + 1, n_points)
            if comp[i] != comp[j]
            and (side.max() == 0 or side[i] != side[j])
            and reach(points[i], points[j], n[i], n[j], 85)
        }
        assert got == want
