"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import drawn, held_out, only, small_batches, table

BUCKETS = 1 << 18
TRAIN_ROWS = 20_000
LEAST_ROWS = 5
FACTORS = 8
#: the first epochs are for the weights alone, so that factors only add what weights cannot
EPOCHS, ALONE = 24, 12
BATCH = 128
RATE, SHRINK = 1.0, 0.1
PAIR_RATE, PAIR_SHRINK = 0.1, 3.0
SEED = 11
_WORD = re.compile(r"[^\W_]+")


def terms(text: str | None) -> np.ndarray:
    """The different hash buckets of a whole text: its words in lower case, and their first
    five letters where they are longer."""
    if not text:
        return np.empty(0, dtype=np.int64)
    words = set(_WORD.findall(text.lower()))
    heads = {f"{w[:5]}-" for w in words if len(w) > 5}
    hashes = [crc32(w.encode("utf-8", "surrogatepass")) for w in words | heads]
    return np.unique(np.array(hashes, dtype=np.int64) % BUCKETS)


@dataclass
class Machine:
    """bias + sum of weights + half the sum, over factors, of (sum of v)^2 - sum of v^2.

    `place` gives a bucket's row in `weights` and `factors`, -1 if it has none.
    """

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, text: str | None) -> float:
        rows = self.place[terms(text)]
        rows = rows[rows >= 0]
        v = self.factors[rows]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return _logistic(self.bias + float(self.weights[rows].sum()) + pairs)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_machine(rows: list[np.ndarray], labels: np.ndarray, buckets: np.ndarray, seed: int = SEED) -> Machine:
    """The logistic loss in batches, of which each touches only its own terms. `rows` hold
    positions in `buckets`.

    Weights: Adagrad with an absolute penalty in proportion to the noise of a term of so many
    rows, so that any term may weigh, up or down, and chance does not. Factors: a row's step
    is divided by its gradient's length, so that no long text outweighs the others, and the
    squared penalty is dealt over the term's rows.
    """
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[buckets] = np.arange(buckets.size)
    rng = np.random.default_rng(seed)
    n = buckets.size
    toxic = float(labels.sum())
    share = toxic / max(labels.size, 1)
    bias = float(np.log((toxic + 0.5) / (labels.size - toxic + 0.5)))
    w, v = np.zeros(n), rng.normal(0, 0.01, (FACTORS, n))
    gw, gb = np.full(n, 0.1), 1.0
    sizes = np.array([r.size for r in rows], dtype=np.int64)
    held_by = np.maximum(1, np.bincount(np.concatenate(rows), minlength=n) if rows else 1)
    shrink = SHRINK * np.sqrt(2 * share * (1 - share) * np.log(max(n, 2)) / held_by)
    pair_shrink = PAIR_SHRINK / held_by
    spot = np.zeros(n, dtype=np.int64)
    for epoch in range(EPOCHS if n else 0):
        order = rng.permutation(labels.size)
        for at in range(0, order.size, BATCH):
            picked = order[at : at + BATCH]
            k = picked.size
            flat, row = np.concatenate([rows[i] for i in picked]), np.repeat(np.arange(k), sizes[picked])
            spot[:] = 0
            spot[flat] = 1
            ids = np.flatnonzero(spot)
            spot[ids] = np.arange(ids.size)
            inner = spot[flat]
            vu = v[:, ids]
            total = np.stack([np.bincount(row, vu[f][inner], k) for f in range(FACTORS)])
            square = np.bincount(row, (vu**2).sum(axis=0)[inner], k)
            long = (total**2).sum(axis=0)
            x = bias + np.bincount(row, w[flat], k) + 0.5 * (long - square)
            err = _logistic(x) - labels[picked]
            times = np.bincount(inner, minlength=ids.size)
            dw = np.bincount(inner, err[row], ids.size)
            gw[ids] += dw**2
            step = RATE / np.sqrt(gw[ids])
            moved = w[ids] - step * dw
            w[ids] = np.sign(moved) * np.maximum(0, np.abs(moved) - step * shrink[ids] * times)
            if epoch >= ALONE:
                # the squared length of a row's gradient: the sum over its terms of (total - v)^2
                even = err / (1 + np.maximum(0, (sizes[picked] - 2) * long + square))
                each = np.bincount(inner, even[row], ids.size)
                for f in range(FACTORS):
                    dv = np.bincount(inner, (even * total[f])[row], ids.size) - each * vu[f]
                    v[f, ids] = (vu[f] - PAIR_RATE * dv) / (1 + PAIR_RATE * pair_shrink[ids] * times)
            gb += err.sum() ** 2
            bias -= 0.5 * err.sum() / np.sqrt(gb)
    return Machine(place, bias, w, np.ascontiguousarray(v.T))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Machine:
    """Fit to labelled documents that are not held out, about `train_rows` of them at most.

    Which ones is decided by a hash of the id, at the rate that the count of labels gives, on
    both sides before they are joined. An id with several labels is toxic if one says so, of
    several texts under one id one is learned; null ids and labels are left out. The machine has every bucket that at least LEAST_ROWS
    sampled rows hold, whatever it says alone. The driver gets the sampled rows' different
    buckets, four bytes each. Without labels of both kinds the machine is a constant.
    """
    marks = (
        only(labels, doc_id="doc_id", toxic="toxic")
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    # both ids as long, so that equal ids have equal hashes
    sample = drawn(F.col("doc_id").cast("long"), train_rows, marks.count())

    @F.pandas_udf("binary")
    def buckets(texts: pd.Series) -> pd.Series:
        return pd.Series([terms(t).astype("<i4").tobytes() for t in texts], dtype=object)

    small_batches(docs.sparkSession)
    rows = only(docs, doc_id=id_col, text=text_col).filter(sample).join(marks.filter(sample), "doc_id")
    got = rows.select("doc_id", "toxic", buckets("text").alias("buckets"))
    got = got.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("buckets").alias("buckets"))
    labels_of, flat, ends = _gathered(got)
    counts = np.bincount(flat, minlength=BUCKETS)
    both = 0 < labels_of.sum() < labels_of.size
    chosen = np.flatnonzero(counts >= LEAST_ROWS) if both else np.empty(0, dtype=np.int64)
    spot = np.full(BUCKETS, -1, dtype=np.int32)
    spot[chosen] = np.arange(chosen.size)
    places = spot[flat]
    kept = places >= 0
    ends = np.append(0, np.cumsum(kept))[ends]
    places = places[kept]
    del flat, kept
    return fit_machine([places[i:j] for i, j in zip(ends, ends[1:])], labels_of, chosen)


def _gathered(got: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By id: labels, the buckets of all rows one after the other, and where each row begins, with their end.

    One array for all, so that the driver gives its memory back as soon as it is done.
    """
    rows = got.toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    labels_of = rows.column("toxic").to_numpy().astype(np.float64)[order]
    held = rows.column("buckets").combine_chunks().take(pa.array(order))
    del rows
    ends = np.append(0, np.cumsum(pc.binary_length(held).to_numpy() // 4, dtype=np.int64))
    # a sample of TRAIN_ROWS stays far below the 2 GB that one such array holds
    flat = np.frombuffer(held.buffers()[2] or b"", dtype="<i4", count=int(ends[-1])).copy()
    del held
    pa.default_memory_pool().release_unused()
    return labels_of, flat, ends


def toxicity(text: Column, machine: Machine) -> Column:
    """The machine's score, 0 to 1, of a whole text; a null text is an empty one."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([machine.score(t) for t in texts], dtype="float64")

    return scores(text)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from 0.5 on).

    Whole texts are read; a null or empty one has the score of a text without known
    terms. Repeated rows get equal scores, a null id is held out, an empty table gives no
    rows, and other columns are not read. Scoring shuffles nothing.
    """
    machine = learn(docs, labels, train_rows, id_col, text_col)
    return (
        only(docs, doc_id=id_col, text=text_col)
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text"), machine).alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
