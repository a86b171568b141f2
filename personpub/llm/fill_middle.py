"""Fill-in-middle transformation: cuts found by a Fenwick tree over fixed blocks of the text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import only, table

#: what marks the prefix, the suffix and the middle in an output
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: bytes of UTF-8 in a block
BLOCK = 1024
#: of a hundred texts, how many are cut, and of a hundred cut ones how many begin with the suffix
CUT, SUFFIX_FIRST = 90, 20
SEED = "1"


class Blocks:
    """Where units of a UTF-8 text end.

    The text is cut into blocks of BLOCK bytes. Two Fenwick trees hold, for each block, how many
    units and how many code points have their last byte in it. A unit is a code point, or a
    match of `unit` in the text (empty matches are none).
    """

    def __init__(self, raw: bytes, unit: re.Pattern[str] | None = None, block: int = BLOCK):
        self.raw, self.block = raw, block
        data = np.frombuffer(raw, dtype=np.uint8)
        self.last = np.ones(data.size, dtype=bool)
        self.last[:-1] = (data[1:] & 0xC0) != 0x80
        self.ends = self.last
        if unit is not None:
            stops = [m.end() for m in unit.finditer(raw.decode("utf-8", "replace")) if m.end() > m.start()]
            self.ends = np.zeros(data.size, dtype=bool)
            self.ends[np.flatnonzero(self.last)[np.array(stops, dtype=np.int64) - 1]] = True
        self.n = int(np.count_nonzero(self.ends))
        self.units = self._tree(self.ends)
        self.points = self.units if unit is None else self._tree(self.last)

    def _tree(self, marks: np.ndarray) -> list[int]:
        size = -(-marks.size // self.block)
        starts = np.arange(size) * self.block
        tree = [0, *(np.add.reduceat(marks, starts, dtype=np.int64).tolist() if size else [])]
        for i in range(1, size + 1):
            above = i + (i & -i)
            if above <= size:
                tree[above] += tree[i]
        return tree

    def after(self, k: int) -> tuple[int, int]:
        """The place after the first k units: its byte and its code point."""
        if not k:
            return 0, 0
        size = len(self.units) - 1
        at, left, points = 0, k, 0
        step = 1 << size.bit_length() >> 1
        while step:
            there = at + step
            if there <= size and self.units[there] < left:
                at = there
                left -= self.units[there]
                points += self.points[there]
            step >>= 1
        low = at * self.block
        byte = low + int(np.flatnonzero(self.ends[low : low + self.block])[left - 1]) + 1
        return byte, points + int(np.count_nonzero(self.last[low:byte]))


def draws(seed: str, doc_id: Column) -> list[Column]:
    """Four numbers below 2^32 from the hash of the seed and the id; a null id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(raw: bytes, h: tuple[int, int, int, int], unit: re.Pattern[str] | None, cut: int, suffix_first: int):
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    blocks = Blocks(raw, unit)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not raw or any(m in raw for m in marks) or h[2] % 100 >= cut:
        return blocks.n, "plain", None, None, raw
    low, high = sorted((h[0] % (blocks.n + 1), h[1] % (blocks.n + 1)))
    (a, a_points), (b, b_points) = blocks.after(low), blocks.after(high)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    p, s, m = marks
    if h[3] % 100 < suffix_first:
        return blocks.n, "spm", a_points, b_points - a_points, b"".join((s, suffix, p, prefix, m, middle))
    return blocks.n, "psm", a_points, b_points - a_points, b"".join((p, prefix, s, suffix, m, middle))


def fill_middle(
    docs: DataFrame,
    seed: str = SEED,
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
    unit: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output.

    The text is cut after two numbers of units that the id's hash draws; units are code points or
    the matches of the pattern `unit`, and what stands between two matches goes with the later one.
    The output is the text itself (plain), or the three parts behind their marks, prefix
    first (psm) or suffix first (spm). Empty texts and texts that hold a mark stay plain, so
    that `restored` can always undo it; their counts of characters are null.

    A null text counts as empty. A null id draws like an empty one. Rows of one id are cut
    each on their own, and equal rows alike. An empty table gives no rows; other columns are
    not read. A text is held once as bytes, with a byte of marks for each of its bytes.
    """
    pattern = re.compile(unit) if unit else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary() if _wide(batch.column(1)) else pa.binary())
            h = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            rows = [transform(t.as_py(), x, pattern, cut, suffix_first) for t, x in zip(texts, h)]
            n, form, prefix, middle, output = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = only(docs, doc_id=id_col, text=text_col)
    kind = dict(rows.dtypes)["doc_id"]
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *draws(seed, F.col("doc_id")))
    columns = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary"
    return rows.mapInArrow(run, columns).withColumn("output", F.col("output").cast("string"))


def _wide(column: pa.Array) -> bool:
    return pa.types.is_large_string(column.type)


def restored(output: Column, form: Column) -> Column:
    """The text of an output. A text with a mark is never cut, so each mark stands there once."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    back = F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
    return back.when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)




def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
  FROM documents
), h AS (
  SELECT *, CAST('0x' || substring(s, 1, 8) AS BIGINT) % (n + 1) AS x,
    CAST('0x' || substring(s, 9, 8) AS BIGINT) % (n + 1) AS y,
    CAST('0x' || substring(s, 17, 8) AS BIGINT) % 100 AS u,
    CAST('0x' || substring(s, 25, 8) AS BIGINT) % 100 AS v
  FROM d
), f AS (
  SELECT *, least(x, y) AS a, greatest(x, y) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR u >= 90 THEN 'plain'
      WHEN v < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix
  FROM f
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256
FROM p
"""
