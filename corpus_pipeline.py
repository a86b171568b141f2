"""The corpus pipeline: from all documents to token counts of the clean, different ones.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
`documents`. `run` writes each stage's rows as Parquet below the shared folder and reads
them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import ascii_lower, table
from personpub.llm.decontamination import contamination
from personpub.llm.exact_dedup import exact_groups
from personpub.llm.idbits import once, row_id, without
from personpub.llm.jaccard import jaccard_components
from personpub.llm.sentencepiece import coded
from personpub.llm.toxicity import learn, toxicity
from personpub.session import settle


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the machine learns from the labels of these documents.

    Rows are judged one by one, by their text alone; a null or empty one has the score of a text
    without known terms. Without labels of both kinds all rows score alike. An empty table stays
    empty.
    """
    machine = learn(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity(F.col("text"), machine) < 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the document with the largest id.

    Null and empty texts are equal. A row without an id counts as below every id, so it goes
    before any other. Only the row itself goes, not another text under its id. Of rows that
    repeat an id and its text the first by its columns' values stays.
    """
    key = row_id(last=False)
    rows = docs.select(key.alias("row_id"), "text")
    found = exact_groups(rows, id_col="row_id").groupBy("doc_id", "text_sha256")
    found = found.agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("NOT kept OR n > 1")
    found = settle(found.select(F.col("doc_id").alias("key"), F.col("text_sha256").alias("mark"), "kept"))
    mark = F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)
    left = without(docs, found.filter("NOT kept"), key, mark)
    again = found.filter("kept")
    # few tables repeat rows; where they do, what is left is kept first, so that no plan holds both steps
    return left if again.isEmpty() else once(settle(left), again, key, mark)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join (five words a shingle, Jaccard 0.8) the one with the least id.

    A row without an id counts as above every id, so it goes before any other; texts that share
    an id are one document, which goes or stays. Texts without words are linked with nothing.
    """
    rows = docs.select(row_id().alias("row_id"), "text")
    found = jaccard_components(rows, percent=80, words=5, id_col="row_id")
    dropped = settle(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("key")))
    return without(docs, dropped, row_id())


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Rows are judged one by one, known by a hash of id and text, so that a row without an id goes
    too and another text under the id of one that goes stays. Null texts have no windows.
    """
    key = F.xxhash64(F.lit("row"), row_id(), F.coalesce("text", F.lit("")))
    found = contamination(docs.select(key.alias("row_key"), "text"), table(spark, sf_dir, "benchmark"), id_col="row_key")
    dropped = settle(found.filter("contaminated").select(F.col("doc_id").alias("key")))
    return without(docs, dropped, key)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document with the number and digest of its ids and the check of the way back.

    A null text counts as empty and has no ids; null ids pass through.
    """
    return coded(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: neither the learned scores, the components nor the ids can be told in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
