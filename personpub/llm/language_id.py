"""Language ID: hyperdimensional letter, n-gram and language vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import drawn, held_out, only, small_batches, table

DIM = 1024
SYMBOLS = 1024
SEED = 7
TRAIN_ROWS = 20_000
#: n-gram vectors kept ready in a worker
READY = 16_384
#: units of a document's vector in a prototype's whole numbers
UNIT = 1 << 20
SHARPNESS = 20.0


class Space:
    """Random letter vectors of +1 and -1 and what is built from them.

    Symbol 0 is the gap between words; every letter has one of the other symbols by its
    code point. The vector of the n-gram abc is a shifted twice times b shifted once
    times c; a text's vector is the sum over its trigrams.
    """

    def __init__(self, dim: int = DIM, seed: int = SEED):
        rng = np.random.default_rng(seed)
        letters = rng.choice(np.array([-1, 1], dtype=np.int8), size=(SYMBOLS, dim))
        self.at = [np.roll(letters, k, axis=1) for k in (2, 1, 0)]
        points = np.arange(0x110000, dtype=np.int64)
        alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        self.symbol = np.where(alpha, 1 + points % (SYMBOLS - 1), 0).astype(np.int64)
        self.dim = dim
        self.place: dict[int, int] = {}
        self.ready = np.empty((READY, dim), dtype=np.float32)

    def _bound(self, codes: np.ndarray) -> np.ndarray:
        a, b, c = codes >> 20, codes >> 10 & 1023, codes & 1023
        return (self.at[0][a] * self.at[1][b] * self.at[2][c]).astype(np.float32)

    def _vectors(self, codes: np.ndarray) -> np.ndarray:
        place = self.place
        got = [place.get(x, -1) for x in codes.tolist()]
        rows = np.array(got, dtype=np.int64)
        if (new := np.flatnonzero(rows < 0)).size:
            free = self.ready.shape[0] - len(place)
            if new.size > free:
                fresh = self._bound(codes[new])
                out = self.ready[np.maximum(rows, 0)]
                out[new] = fresh
                return out
            spots = np.arange(len(place), len(place) + new.size)
            self.ready[spots] = self._bound(codes[new])
            place.update(zip(codes[new].tolist(), spots.tolist()))
            rows[new] = spots
        return self.ready[rows]

    def vector(self, text: str | None) -> np.ndarray | None:
        """The bundled vector of a whole text; None without a letter."""
        if not text:
            return None
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        s = self.symbol[points]
        if not s.any():
            return None
        s = np.concatenate(([0], s, [0]))
        s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]  # one gap between words
        codes, counts = np.unique((s[:-2] << 20) | (s[1:-1] << 10) | s[2:], return_counts=True)
        out = np.zeros(self.dim, dtype=np.float64)
        for i in range(0, codes.size, 4096):
            out += counts[i : i + 4096].astype(np.float32) @ self._vectors(codes[i : i + 4096])
        return out


_spaces: dict[tuple[int, int], Space] = {}


def space(dim: int = DIM, seed: int = SEED) -> Space:
    if (dim, seed) not in _spaces:
        _spaces[dim, seed] = Space(dim, seed)
    return _spaces[dim, seed]


def prototypes(
    rows: DataFrame, train_rows: int = TRAIN_ROWS, dim: int = DIM, seed: int = SEED
) -> dict[str, np.ndarray]:
    """A unit vector for each language of `rows` (doc_id, text, lang).

    Learns from about `train_rows` rows at most, taken by a hash of the id at the rate
    that the count of all rows gives. A language's vector is the sum of the unit vectors
    of its texts, in whole numbers, so that it does not depend on the order of rows.
    Rows without a language, a text or a letter teach nothing. Sums are formed in each task
    and then by position; the driver gets one vector a language.
    """
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    total = rows.count()
    rows = rows.filter(drawn(F.col("doc_id"), train_rows, total))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = space(dim, seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                v = s.vector(text)
                if v is not None and (size := np.linalg.norm(v)):
                    sums[lang] = sums.get(lang, 0) + np.rint(v / size * UNIT).astype(np.int64)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [v.tolist() for v in sums.values()]})

    parts = rows.select("text", "lang").mapInPandas(run, "lang string, v array<long>")
    found = (
        parts.select("lang", F.posexplode("v").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
        .select("lang", F.col("v.x").alias("v"))
        .collect()
    )
    out = {}
    for lang, v in sorted(found):
        v = np.array(v, dtype=np.float64)
        if size := np.linalg.norm(v):
            out[lang] = v / size
    return out


def identify(
    docs: DataFrame,
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    dim: int = DIM,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    The language is the one whose prototype has the largest cosine with the vector of the
    whole text; ties go to the first by name. The score is its share of
    exp(SHARPNESS * cosine) over all languages. Learns from rows that are not held out.
    A text that is null, empty or without a letter is `und` with score 0, and so is every
    text when nothing was learned. Null ids are held out. Repeated rows each give a
    row; an empty table gives none; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = only(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("held_out", held_out(F.col("doc_id")))
    learned = prototypes(rows.filter("NOT held_out"), train_rows, dim, seed)
    names = list(learned)
    matrix = np.array([learned[n] for n in names]).reshape(len(names), dim)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = space(dim, seed)
        for batch in batches:
            langs, scores = [], []
            for text in batch["text"]:
                v = s.vector(text)
                size = 0.0 if v is None else float(np.linalg.norm(v))
                if not size or not names:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                cos = matrix @ v / size
                top = int(cos.argmax())
                langs.append(names[top])
                scores.append(float(1 / np.exp(SHARPNESS * (cos - cos[top])).sum()))
            yield batch[["doc_id", "held_out"]].assign(lang_pred=langs, score=scores)

    kind = dict(rows.dtypes)["doc_id"]
    return (
        rows.select(F.col("doc_id").cast("string"), "text", "held_out")
        .mapInPandas(run, "doc_id string, held_out boolean, lang_pred string, score double")
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
