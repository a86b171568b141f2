"""Exact dedup and the id filter."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from personpub.llm.exact_dedup import exact_groups
from personpub.llm.idbits import once, row_id, without

SCHEMA = "doc_id long, text string, body string, key int, digest string, salt string, n int"


def rows(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z", 2) for i, t in pairs], SCHEMA)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


def brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[lower(t)].append(i)
    out = []
    for i, t in pairs:
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[lower(t)]), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


PAIRS = [
    (1, "One text"), (2, "ONE TEXT"), (3, "one text "), (4, None), (5, ""), (6, "É"), (7, "é"),
    (None, "one text"), (8, "long " * 50_000), (9, "LONG " * 50_000), (2, "ONE TEXT"), (None, "alone"), (10, "\0"),
]


def test_groups_equal_brute_force(spark):
    got = sorted((tuple(r) for r in exact_groups(rows(spark, PAIRS)).collect()), key=str)
    assert got == brute(PAIRS)


def test_clashing_digests_are_told_apart_by_content(spark):
    pairs = [(i, f"text {i % 40}") for i in range(200)]
    full = exact_groups(rows(spark, pairs)).collect()
    short = exact_groups(rows(spark, pairs), digest_chars=1).collect()
    assert sorted(map(tuple, full), key=str) == sorted(map(tuple, short), key=str) == brute(pairs)


def test_empty_table(spark):
    assert exact_groups(rows(spark, []).filter("false")).collect() == []


def test_large_group_in_many_partitions(spark):
    docs = spark.range(0, 20_000, 1, 64).select(F.col("id").alias("doc_id"), F.lit("Same").alias("text"))
    got = exact_groups(docs)
    assert got.select("keep_id", "group_size").distinct().collect() == [(19_999, 20_000)]
    assert got.filter("kept").count() == 1


def test_without_keeps_all_other_rows_and_columns(spark):
    docs = spark.createDataFrame(
        [(i, f"t{i}", "a", 1) for i in range(1000)] + [(None, "n", "a", 1), (5, "t5", "a", 1)],
        "doc_id long, text string, id string, dropped_id int",
    )
    gone = spark.createDataFrame([(i,) for i in [*range(0, 1000, 3), 5, 5, None]], "key long")
    got = without(docs, gone, row_id())
    assert got.columns == docs.columns
    left = {i for i in range(1000) if i % 3 and i != 5}
    assert sorted(r[0] for r in got.collect() if r[0] is not None) == sorted(left)
    assert got.filter("doc_id IS NULL").count() == 1
    assert without(docs, gone.filter("false"), row_id()).count() == docs.count()
    marked = gone.filter("key = 5 OR key = 6").selectExpr("key", "if(key = 5, 't5', 'other') as mark").distinct()
    assert without(docs, marked, row_id(), F.col("text")).count() == docs.count() - 2


def test_once_keeps_one_of_repeated_rows(spark):
    rows = [(1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (2, "a", "x"), (2, "a", "x"), (None, "c", "x"), (None, "c", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _place string")
    again = docs.select(row_id().alias("key"), F.col("text").alias("mark")).groupBy("key", "mark").count().filter("count > 1")
    got = [tuple(r) for r in once(docs, again, row_id(), F.col("text")).collect()]
    assert sorted(got, key=str) == sorted([(1, "a", "x"), (1, "b", "x"), (2, "a", "x"), (None, "c", "x")], key=str)
    assert once(docs, again.limit(0), row_id(), F.col("text")).count() == len(rows)
