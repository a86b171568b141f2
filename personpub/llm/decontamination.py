"""Benchmark decontamination: a prefix-filtered set join over item-sized windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import UPPER, ascii_lower, only, table
from personpub.llm.idbits import id_bits, passes
from personpub.session import settle

#: what stands between words: every ASCII character but digits and a-z
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3
SLOTS = 65_536
SALTS = 8


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; none for null."""
    return F.array_remove(F.split(ascii_lower(text), GAPS), "")


def _shingle(words: Column, pos: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, pos + i) for i in range(size)])


def _spots(texts: DataFrame, bits: Column, slots: int) -> DataFrame:
    """Every word position with the hashes of the shingles that begin there (hs), and whether
    one of them passes the filter (hit). A text without words has one row without a position."""
    spots = texts.select("doc_id", "th", "words", F.posexplode_outer("words").alias("pos", "word"))
    hashes = [_shingle(F.col("words"), F.col("pos"), k) for k in (SHINGLE, 2, 1)]
    found = [passes(h, bits, slots) for h in hashes]
    hit = F.col("pos").isNotNull() & (found[0] | found[1] | found[2])
    return spots.withColumns({"hit": hit, "hs": F.array(*hashes)})


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per different window: win (its words), items (ids as strings).

    An item of fewer words than a window, but not none, is one window.
    """
    items = only(benchmark, item=id_col, body=text_col).select(
        F.col("item").cast("string").alias("item"), words_of(F.col("body")).alias("words")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - WINDOW + 1, F.lit(1)))
    return (
        items.filter(F.size("words") > 0)
        .select("item", "words", F.explode(starts).alias("s"))
        .select("item", F.slice("words", F.col("s"), WINDOW).alias("win"))
        .groupBy("win")
        .agg(F.collect_set("item").alias("items"))
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slots: int = SLOTS,
    salts: int = SALTS,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word is hit if it stands in an occurrence of a benchmark window, ten
    consecutive words of an item (all of them for a shorter item). items_sha256 is over
    the sorted ids of the items with a window in the document. A null or wordless text
    has no words and no hits; a wordless item has no windows; an item with a null id
    hits but is not listed. Repeated rows each get their own, equal result; rows that share
    an id but not the text are told apart by a hash of the text. No benchmark: nothing is
    hit. No documents: no rows.

    A window is a set of three-word shingles (shorter ones for windows of one or two
    words). How often each benchmark shingle stands in the documents is counted over
    all of them; that order makes a window's rarest shingle its prefix, which for whole
    containment is the only necessary token. Documents are cut a second time and joined on
    prefixes alone, behind a bit filter of fixed size, carrying the words around the spot. The place
    of the shingle in the window bounds where the window starts and ends, and its words
    are then compared one by one. Passages that many documents share are spread by salt.
    """
    windows = benchmark_windows(benchmark)
    size = F.least(F.size("win"), F.lit(SHINGLE))
    at = F.explode(F.sequence(F.lit(0), F.size("win") - size))
    shingles = windows.select("win", "items", at.alias("o")).select(
        "win",
        "items",
        "o",
        F.xxhash64(F.get("win", F.col("o")), F.get("win", F.col("o") + 1), F.get("win", F.col("o") + 2)).alias("h"),
    )
    texts = only(docs, doc_id=id_col, body=text_col).select(
        "doc_id", F.xxhash64("body").alias("th"), words_of(F.col("body")).alias("words")
    )
    any_bits = id_bits(shingles.select("h"), slots)
    counts = (
        _spots(texts, any_bits, slots)
        .filter("hit")
        .select(F.explode(F.array_distinct("hs")).alias("h"))
        .filter(passes(F.col("h"), any_bits, slots))
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    prefixes = (
        shingles.join(counts, "h")
        .groupBy("win")
        .agg(
            F.count(F.lit(1)).alias("present"),
            F.min_by(F.struct("o", "h"), F.struct("n", "o")).alias("p"),
            F.first("items").alias("items"),
        )
        # a window with a shingle that no document has occurs nowhere
        .filter(F.col("present") == F.size("win") - size + 1)
        .select("win", "items", "p.o", "p.h")
    )
    # read by the filter and by the join; a few rows a benchmark item
    prefixes = settle(prefixes)
    prefix_bits = id_bits(prefixes.select("h"), slots)
    # one row a text with its length, and one for each spot where a prefix may stand
    first = F.greatest(F.col("pos") - (WINDOW - 1), F.lit(0))
    nothing = F.array().cast("array<bigint>")
    head = F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.array(F.lit(None).cast("bigint"))).otherwise(nothing)
    some = F.when(F.col("hit"), F.array_distinct("hs")).otherwise(nothing)
    around = F.slice("words", first + 1, F.col("pos") - first + WINDOW)
    rows = settle(
        _spots(texts, prefix_bits, slots)
        .filter("hit OR coalesce(pos, 0) = 0")
        .select(
            "doc_id",
            "th",
            "pos",
            F.size("words").cast("long").alias("n_words"),
            F.when(F.col("hit"), first).alias("first"),
            F.when(F.col("hit"), around).alias("around"),
            F.explode(F.concat(head, some)).alias("h"),
        )
        .filter(F.col("h").isNull() | passes(F.col("h"), prefix_bits, slots))
    )
    spots = rows.filter("h IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(salts)))
    spread = prefixes.withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    start = F.col("pos") - F.col("o")
    length = F.size("win")
    occurrences = (
        spots.join(spread, ["h", "salt"])
        .filter((start >= F.col("first")) & (start + length <= F.col("first") + F.size("around")))
        .filter(F.slice("around", start - F.col("first") + 1, length) == F.col("win"))
        .select("doc_id", "th", F.struct(start.alias("a"), (start + length).alias("b")).alias("span"), "items")
    )
    # bounded by one document's own words
    hit = (
        occurrences.groupBy("doc_id", "th")
        .agg(F.collect_set("span").alias("spans"), F.collect_set("items").alias("lists"))
        .select(
            F.col("doc_id").alias("hit_id"),
            F.col("th").alias("hit_th"),
            F.expr(
                """aggregate(sort_array(spans), named_struct('n', 0L, 'end', 0),
                     (m, x) -> named_struct('n', m.n + greatest(x.b - greatest(x.a, m.end), 0),
                                            'end', greatest(x.b, m.end)), m -> m.n)"""
            ).alias("n_hit"),
            F.sort_array(F.array_distinct(F.flatten("lists"))).alias("items"),
        )
    )
    sizes = rows.filter("h IS NULL").select("doc_id", "th", "n_words")
    zero = F.lit(0).cast("long")
    return (
        sizes.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", zero).alias("n_hit"),
            F.coalesce(F.size("items").cast("long"), zero).alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        )
        .withColumn("n_items", F.greatest("n_items", zero))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{u}', '{l}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(
    u=UPPER, l=UPPER.lower()
)

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::varchar AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS k, unnest(list_transform(
    range(1, greatest(len(w) - {WINDOW}, 0) + 2), lambda i: array_to_string(w[i:i + {WINDOW} - 1], ' '))) AS win
  FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT k FROM win),
cut AS (
  SELECT rid, k, unnest(range(1, len(w) - k + 2)) AS s,
    unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS win
  FROM d, lens WHERE len(w) >= k),
occ AS (SELECT rid, s, k, item FROM cut JOIN win USING (k, win)),
hit AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM occ) GROUP BY rid),
it AS (
  SELECT rid, count(item) AS n_items, sha256(coalesce(string_agg(item, ',' ORDER BY item), '')) AS sha
  FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""
