"""SentencePiece: the best split, the stream, the way back."""

import random
import re

import pytest

from personpub.llm import sentencepiece as sp
from personpub.llm.sentencepiece import MARK, SPACE, coded, decode, encode, pieces

TEXTS = [
    "", " ", "  two  spaces ", "Hello world", "tab\tnew\nline\r", "a" * 3000, " " * 2000, "▁ and ▁▁", "日本語 ☃ 😀", "\0",
    "é" * 700, "The quick brown fox jumps over the lazy dog. " * 60, "ﬁ Å", "x" * 700 + "▁" * 300,
]


def best(p, text):
    """Whole-text Viterbi, and the same by trying every split of short texts."""
    chars = (" " + text.replace(SPACE, MARK)).replace(" ", SPACE) if text else ""
    score, back = [0.0], [None]
    for n in range(1, len(chars) + 1):
        top = (score[n - 1] + p.fallback, n - 1)
        for i in range(max(0, n - p.longest), n):
            if chars[i:n] in p.scores:
                s = score[i] + p.scores[chars[i:n]][0]
                if s > top[0] or (s == top[0] and i < top[1]):
                    top = (s, i)
        score.append(top[0])
        back.append(top[1])
    return score[-1], chars


def scored():
    """The same pieces as if their scores were likelihoods."""
    return sp.Pieces(merges=False)


def value(p, ids):
    total, run = 0.0, bytearray()
    for i in ids:
        if i in p.byte_of:
            run.append(p.byte_of[i])
        else:
            total += p.scores[p.text[i]][0] + p.fallback * len(run.decode())
            run.clear()
    return total + p.fallback * len(run.decode())


@pytest.mark.parametrize("text", TEXTS)
def test_best_and_back(text):
    p = scored()
    ids = p.encode(text)
    assert p.decode(ids) == text
    score, _ = best(p, text)
    assert value(p, ids) == score
    assert pieces().decode(pieces().encode(text)) == text


def test_every_split_of_short_texts():
    p = scored()

    def splits(chars):
        if not chars:
            return 0.0
        rest = [p.fallback + splits(chars[1:])]
        for k in range(1, min(len(chars), p.longest) + 1):
            if chars[:k] in p.scores:
                rest.append(p.scores[chars[:k]][0] + splits(chars[k:]))
        return max(rest)

    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choices("abeinrst é", k=rng.randrange(1, 10)))
        assert value(p, p.encode(text)) == splits((" " + text).replace(" ", SPACE))


@pytest.mark.parametrize("merges", [False, True])
def test_stream_commits_like_the_whole(monkeypatch, merges):
    p = sp.Pieces(merges=merges)
    rng = random.Random(2)
    for stride in (1, 3, 7, 256):
        monkeypatch.setattr(sp, "STRIDE", stride)
        for _ in range(10):
            chars = "".join(rng.choices("abeinrst▁日", k=400))
            ids = list(p.stream(iter(chars)))
            cut = sorted(rng.sample(range(400), 9))
            assert ids == list(p.stream(chars[a:b] for a, b in zip([0, *cut], [*cut, 400])))
            monkeypatch.setattr(sp, "STRIDE", 10**9)
            assert ids == list(p.stream((chars,)))
            monkeypatch.setattr(sp, "STRIDE", stride)


def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=sp.MODEL)


def test_ids_are_those_of_the_library_for_random_texts():
    rng, lib, p = random.Random(3), library(), pieces()
    parts = ["the", "and", "ing", " ", "  ", "é", "日", "x" * 5, "0", "12", "\n", "\t", "😀", "tion", "ß", "ea", "er", "in", "   ", "."]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert p.encode(text) == lib.encode(text), text
    for text in ("a" * 5000, "ab" * 3000, " " * 700, "in" * 900 + " " * 33, "tion" * 500):
        assert p.encode(text) == lib.encode(text)


def test_ids_are_those_of_the_library_for_all_documents(spark):
    lib, p = library(), pieces()
    for (text,) in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        assert p.encode(text) == lib.encode(text)


def test_forgetting_changes_nothing(monkeypatch):
    text = "The quick brown fox jumps over the lazy dog. " * 3
    want = pieces().encode(text)
    monkeypatch.setattr(sp, "REMEMBERED", 2)
    assert sp.Pieces().encode(text) == want


def test_first_ids_come_before_the_end():
    p = pieces()
    taken = 0

    def chars():
        nonlocal taken
        for c in "▁the▁cat▁sat" * 1000:  # a character at a time
            taken += 1
            yield c

    next(iter(p.stream(chars())))
    assert taken <= sp.STRIDE + pieces().longest


def test_words_meet_at_their_ends():
    assert pieces().cuts and not any(re.search("[^▁]▁", t) for t in pieces().scores)


def test_ids_of_the_library_decode_to_the_same_text():
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=sp.MODEL)
    text = "Words and more words, in a line."
    assert lib.decode(pieces().encode(text)) == text == pieces().decode(lib.encode(text))


def test_columns_and_rows(spark):
    df = spark.createDataFrame(
        [(i, t, 1, "x", True) for i, t in enumerate(TEXTS)] + [(None, None, 1, "x", True), (1, "a", 1, "x", True), (1, "a", 1, "x", True)],
        "doc_id long, text string, n_ids int, ids_sha256 string, round_trip boolean",
    )
    got = coded(df).collect()
    assert len(got) == len(TEXTS) + 3 and all(r["round_trip"] for r in got)
    assert [r["n_ids"] for r in got if r["doc_id"] is None] == [0]
    back = df.select("text", decode(encode(df["text"])).alias("again")).collect()
    assert all((r["text"] or "") == r["again"] for r in back)
    assert coded(df.filter("false")).collect() == []
