"""Sharding: the smallest capacity, whole groups, gapless slots."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from personpub.llm.sharding import cut_points, shard


def smallest(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        k, fill = 1, 0
        for x in sizes:
            if fill + x > mid:
                k, fill = k + 1, 0
            fill += x
        low, high = (low, mid) if k <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed", range(6))
def test_capacity_is_minimal_and_kept(spark, seed):
    rng = random.Random(seed)
    shards = rng.choice([1, 2, 5, 40])
    sizes = [rng.choice([16, 17, 100, 900, 40_000]) for _ in range(rng.choice([1, 3, 50, 400]))]
    row = cut_points(spark.createDataFrame([(sizes,)], "sizes array<long>"), shards).first()
    cuts = [1, *row["cuts"], len(sizes) + 1]
    parts = [sum(sizes[a - 1 : b - 1]) for a, b in zip(cuts, cuts[1:])]
    assert cuts == sorted(set(cuts)) and len(parts) <= shards
    assert row["cap"] == smallest(sizes, shards)
    assert max(parts) <= row["cap"]


def docs(spark, pairs):
    schema = "doc_id long, text string, atom string, size string, shard string, n int"
    return spark.createDataFrame([(i, t, "a", "b", "c", 1) for i, t in pairs], schema)


def test_rows_and_law(spark):
    rng = random.Random(4)
    texts = [f"text {i} " * rng.randrange(1, 40) for i in range(300)] + ["É" * 9, "", None]
    pairs = [(i, rng.choice(texts)) for i in range(2000)] + [(1, "twice"), (1, "twice"), (None, None), (None, "x")]
    got = shard(docs(spark, pairs)).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs if i is not None
    )
    assert len(got) == len(pairs)
    text_of = dict(pairs)
    home, slots, sizes = {}, {}, {}
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 40
        if r["doc_id"] not in (None, 1):
            assert home.setdefault(text_of[r["doc_id"]] or "", r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(sizes) == 40 and max(sizes.values()) < 1.5 * sum(sizes.values()) / 40


def test_one_group_of_copies_and_empty_table(spark):
    many = spark.range(0, 6000, 1, 16).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    got = shard(many)
    assert got.select("shard").distinct().count() == 1
    assert got.agg(F.min("slot"), F.max("slot"), F.count_distinct("slot")).first() == (0, 5999, 6000)
    assert shard(docs(spark, [(1, "a")]).filter("false")).collect() == []


def test_same_every_time(spark):
    table = docs(spark, [(i, f"t{i % 50}") for i in range(500)])
    one = sorted(map(tuple, shard(table).collect()))
    assert sorted(map(tuple, shard(table.repartition(7)).collect())) == one
