"""Source divergence audit: how the terms of a source differ from its language and from other sources.

Terms are never ranked one by one: those of a source with the same counts (there, in the language)
are one cell, the divergence is evaluated once per cell, cells are ranked by cumulative
multiplicity, and only the terms of the cells that reach the report are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from personpub.llm.common import only, table
from personpub.session import settle

#: documents of its language that a kept term is in, and terms reported for a source
DOCUMENTS, TOP = 10, 10
#: p is counted in parts of SCALE; ADDED goes onto every count
SCALE, ADDED = 1_000_000_000, 2
#: runs of letters and of the bytes of longer characters; what parts them
TERM, GAP = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^A-Za-z\x80-\xff]")
#: bytes of a text cut at a time; terms, and their bytes, that a task holds before it gives them out
STEP, HELD, HELD_BYTES = 1 << 20, 300_000, 32 << 20
_DOCUMENT = 1 << 48


def words_of(raw: bytes, step: int = STEP) -> Counter[bytes]:
    """The terms of a UTF-8 text with their counts; a long text is cut between terms."""
    found: Counter[bytes] = Counter()
    low = 0
    while low < len(raw):
        gap = GAP.search(raw, low + step)
        high = gap.start() if gap else len(raw)
        found.update(TERM.findall(raw[low:high].lower()))
        low = high
    return found


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it), from columns lang, source, text.

    A task adds up what it reads, so that of a term in every document hardly more than one row a
    task and source is shuffled. Each source of a language also has a row with a null term.
    """

    def given(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in held.items():
            terms = [None, *counts]
            packed = [0, *counts.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()),
                    pa.array([x % _DOCUMENT for x in packed], pa.int64()),
                    pa.array([x // _DOCUMENT for x in packed], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        size = bytes_held = 0
        for batch in batches:
            wide = pa.types.is_large_string(batch.column(2).type)
            texts = batch.column(2).cast(pa.large_binary() if wide else pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                counts = held.setdefault((lang, source), {})
                before = len(counts)
                found = words_of(text.as_py())
                for term, n in found.items():
                    counts[term] = counts.get(term, 0) + n + _DOCUMENT
                if len(counts) > before:
                    size += len(counts) - before
                    bytes_held += sum(map(len, found))
                if size > HELD or bytes_held > HELD_BYTES:
                    yield from given(held)
                    held, size, bytes_held = {}, 0, 0
        yield from given(held)

    parts = docs.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str) -> str:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * kept)) as SQL; null where nothing is kept."""
    parts = f"cast({count} + {ADDED} AS decimal(19,0)) * cast({SCALE} AS decimal(10,0))"
    return f"(1L + ({parts}) div cast(nullif({total} + {ADDED} * kept, 0) AS decimal(19,0)))"


def _divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def _top_terms(groups: DataFrame, counted: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value, rank: the terms that a source has most above its language."""
    cell = ["lang", "source", "n", "lang_n"]
    cells = counted.groupBy(*cell).agg(F.count(F.lit(1)).alias("terms")).join(groups, ["lang", "source"])
    cells = cells.select(
        *cell, "terms", F.expr(_share("n", "group_total")).alias("p"), F.expr(_share("lang_n", "lang_total")).alias("q")
    ).filter("p > q")
    cells = cells.withColumn("value", F.expr(_divergence("p", "q")))
    # each value has a term at least, so the first `top` values hold the first `top` terms
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    values = values.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top)
    earlier = F.coalesce(F.sum("terms").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("before", earlier).filter(F.col("before") < top)
    chosen = cells.join(values.drop("terms", "place"), ["lang", "source", "value"])
    terms = counted.join(chosen.select(*cell, "value", "before"), cell)
    equal = Window.partitionBy("lang", "source", "value").orderBy("term")
    terms = terms.withColumn("place", F.row_number().over(equal)).filter(F.col("place") <= top)
    rank = F.col("before") + F.col("place")
    return terms.select("lang", "source", F.col("term").alias("item"), "value", rank.alias("rank")).filter(
        F.col("rank") <= top
    )


def _pairs(groups: DataFrame, counted: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: the divergence of every two sources of a language.

    Over all kept terms, with s and t the counts of a term in the two sources, the sum of f(s, t) is

        sum of f(s, 0) + sum of f(0, t) + (kept - with s - with t) * f(0, 0)
        + sum over terms with both of f(s, t) - f(s, 0) - f(0, t) + f(0, 0),

    so that only a term's own sources meet, as cells of equal counts.
    """
    one, two = (
        groups.select(
            "lang", F.col("source").alias(f"{x}_source"), F.col("group_total").alias(f"{x}_total"),
            F.col("group_terms").alias(f"{x}_terms"), *(["kept"] if x == "s" else []),
        )
        for x in ("s", "t")
    )
    pairs = one.join(two, "lang").filter("s_source < t_source")
    f = {
        (a, b): _divergence(_share("s" if a else "0L", "s_total"), _share("t" if b else "0L", "t_total"))
        for a in (0, 1)
        for b in (0, 1)
    }
    key = ["lang", "s_source", "t_source"]
    nothing = pairs.select(*key, F.expr(f"(kept - s_terms - t_terms) * {f[0, 0]}").alias("part"))
    counts = counted.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms"))
    only_s = counts.select("lang", F.col("source").alias("s_source"), F.col("n").alias("s"), "terms")
    only_s = pairs.join(only_s, ["lang", "s_source"]).select(*key, F.expr(f"terms * {f[1, 0]}").alias("part"))
    only_t = counts.select("lang", F.col("source").alias("t_source"), F.col("n").alias("t"), "terms")
    only_t = pairs.join(only_t, ["lang", "t_source"]).select(*key, F.expr(f"terms * {f[0, 1]}").alias("part"))
    left = counted.select("lang", "term", F.col("source").alias("s_source"), F.col("n").alias("s"))
    right = counted.select("lang", "term", F.col("source").alias("t_source"), F.col("n").alias("t"))
    both = left.join(right, ["lang", "term"]).filter("s_source < t_source")
    both = both.groupBy(*key, "s", "t").agg(F.count(F.lit(1)).alias("terms")).join(pairs, key)
    more = F.expr(f"terms * ({f[1, 1]} - {f[1, 0]} - {f[0, 1]} + {f[0, 0]})")
    parts = nothing.unionByName(only_s).unionByName(only_t).unionByName(both.select(*key, more.alias("part")))
    values = parts.groupBy(*key).agg(F.coalesce(F.sum("part"), F.lit(0)).alias("value"))
    forth = values.select("lang", F.col("s_source").alias("source"), F.col("t_source").alias("item"), "value")
    back = values.select("lang", F.col("t_source").alias("source"), F.col("s_source").alias("item"), "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return forth.unionByName(back).withColumn("rank", F.row_number().over(ranked))


def divergence(
    docs: DataFrame,
    documents: int = DOCUMENTS,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank for every source of a language.

    Terms are runs of letters and other non-ASCII characters, with A-Z in lower case. A
    language keeps those that at least `documents` of its rows have. With p and q the smoothed
    shares of a term in whole billionths, its divergence is floor((p - q)^2 / (p + q)). Part
    `pair` ranks the other sources of the language by the sum over all kept terms; part `term` the
    `top` terms that the source has above its language. Equal values go by the item's UTF-8 bytes.

    A null text, lang or source counts as ''. A source without terms still has its pairs, and
    value 0 where nothing is kept; a source alone in its language has none. Repeated rows
    count as often as they stand there, ids are not read. An empty table gives no rows; other
    columns are not read.
    """
    rows = only(docs, lang=lang_col, source=source_col, text=text_col)
    rows = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])
    counts = settle(term_counts(rows).withColumn("term", F.col("term").cast("string")))
    known = counts.filter("term IS NOT NULL").groupBy("lang", "term")
    kept = known.agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= documents)
    kept = kept.drop("docs")
    counted = settle(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"))
    # a language is the sum of its sources; a term's count there is given with one of them
    totals = counted.groupBy("lang", "source").agg(
        F.sum("n").alias("group_total"), F.count(F.lit(1)).alias("group_terms")
    )
    langs = totals.groupBy("lang").agg(F.sum("group_total").alias("lang_total"))
    sizes = counted.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("one").alias("kept"))
    none = {"group_total": 0, "group_terms": 0, "lang_total": 0, "kept": 0}
    groups = counts.filter("term IS NULL").select("lang", "source")
    groups = settle(
        groups.join(totals, ["lang", "source"], "left").join(langs.join(sizes, "lang"), "lang", "left").fillna(none)
    )
    pairs = _pairs(groups, counted).withColumn("part", F.lit("pair"))
    terms = _top_terms(groups, counted, top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", F.col("value").cast("long"), F.col("rank").cast("int")]
    return pairs.select(*columns).unionByName(terms.select(*columns))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), said AS (
  SELECT r, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM said GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY lang, source, term
), langs AS (
  SELECT lang, sum(lang_n) AS lang_total, count(*) AS v FROM kept GROUP BY lang
), totals AS (
  SELECT lang, source, sum(n) AS total FROM counted GROUP BY lang, source
), groups AS (
  SELECT g.lang, g.source, CAST(coalesce(total, 0) AS HUGEINT) AS total,
    CAST(coalesce(lang_total, 0) AS HUGEINT) AS lang_total, CAST(coalesce(v, 0) AS HUGEINT) AS v
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN totals t USING (lang, source) LEFT JOIN langs l ON l.lang = g.lang
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * CAST(coalesce(c.n, 0) + 2 AS HUGEINT)) // (g.total + 2 * g.v) AS p,
    1 + (1000000000 * CAST(k.lang_n + 2 AS HUGEINT)) // (g.lang_total + 2 * g.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM shares x JOIN shares y
      ON x.lang = a.lang AND x.source = a.source AND y.lang = a.lang AND y.source = b.source AND x.term = y.term), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 10
"""
