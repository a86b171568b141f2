"""N-gram Jaccard join: group counts as points under boxes, exact verification, components.

Two texts link if 100 * (shingles in common) >= percent * (shingles of either). With n and n'
shingles they then differ in at most r = (100 - percent) / (100 + percent) * (n + n')
of them, which is at most (100 - percent) / percent * n for either.

Root. Shingles are hashed into m groups, m by the size class of the smaller text. A
difference touches one group, so of the first r + 1 filled groups of either text one is
untouched: both texts send a key for its whole content, and meet there. Texts below SINGLE
shingles take each shingle as a group. (For larger ones 1.5 groups for every two
shingles of the least size leave far more than r + 1 filled; that it is fewer has a probability below 1e-14
a text.)

Common lines and passages make keys that very many unlike texts share. Such keys are named beforehand
from a sample and passed over: a text sends the first r + 1 filled groups that are not named. Of the
groups that are filled and not named in either of two texts, one of the first r + 1 is untouched,
so it is not named for the other, and among the first r + 1 of each. Where there are fewer than
r + 1 such groups, both texts have fewer; such a text also sends its first r + 1 filled groups as
they are, so there the two meet. Whichever keys are named, no link is lost; it only decides
how many texts meet in vain.

Leaves. Under a root key each text is a point, the counts of its shingles in DIMS groups.
The number in common is at most the sum of the smaller counts, coordinate by
coordinate; for a box, of its largest counts. Boxes, then points, that cannot reach the
share are left out, the others are verified with the sets themselves.

Equal sets are one class from the start. Under each key the texts first meet one leader only;
what these links join needs no more comparison, so a group of copies of any size
does not become pairs. Texts under one key in different components are then compared
through the boxes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from personpub.llm.common import only, small_batches, table
from personpub.llm.idbits import id_bits, passes
from personpub.llm.shingles import WORDS, mix, shingle_sets
from personpub.session import settle

PERCENT = 85
SINGLE = 64
#: groups of a point, and of a fine one at most
DIMS, FINEST = 128, 1 << 16
#: points in a box, and points of a key compared in one task
BOX, BLOCK = 32, 512
#: keys of a text, its first ones, that tell whether a pair has met already
FIRST_KEYS = 16


#: of SAMPLE texts one tells which keys are common: those that LEAST sampled texts have, NAMED at most
SAMPLE, LEAST, NAMED = 32, 4, 1 << 20
#: bits of the filter that holds them
NAMED_BITS = 1 << 23


def size_class(n: np.ndarray) -> np.ndarray:
    """0 below SINGLE, then one more for each doubling."""
    return np.where(n < SINGLE, 0, np.log2(np.maximum(n, 1) / SINGLE).astype(np.int64) + 1)


def named_bits(keys: np.ndarray) -> np.ndarray:
    """A bit filter of keys to pass over. What it takes for one of them is passed over everywhere."""
    bits = np.zeros(NAMED_BITS >> 3, dtype=np.uint8)
    spot = keys >> np.uint64(64 - (NAMED_BITS.bit_length() - 1))
    np.bitwise_or.at(bits, (spot >> np.uint64(3)).astype(np.int64), np.uint8(1) << (spot & np.uint64(7)).astype(np.uint8))
    return bits


def _is_named(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    spot = keys >> np.uint64(64 - (NAMED_BITS.bit_length() - 1))
    return (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def root_keys(
    h: np.ndarray, sizes: np.ndarray, percent: int = PERCENT, named: np.ndarray | None = None, every: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of sets given one after the other (ascending hashes): keys, and how many each has.

    A set sends those of its own class, and of the class below where its smallest partner
    would be there. Keys in the filter `named` are passed over; with `every`, the keys of all
    filled groups are given.
    """
    own = size_class(sizes)
    lower = size_class(-(-percent * sizes // 100))
    row = np.arange(sizes.size)
    keys_a, who_a = _keys(h, sizes, own, np.ones(sizes.size, dtype=bool), percent, named, every)
    keys_b, who_b = _keys(h, sizes, lower, lower != own, percent, named, every)
    keys, who = np.append(keys_a, keys_b), np.append(who_a, who_b)
    order = np.argsort(who, kind="stable")
    return keys[order], np.bincount(who, minlength=row.size)


def _ranks(who: np.ndarray) -> np.ndarray:
    """The place of each entry among those of its row."""
    if not who.size:
        return np.empty(0, dtype=np.int64)
    first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
    return np.arange(who.size) - np.repeat(first, np.diff(np.append(first, who.size)))


def _keys(h, sizes, kind, wanted, percent, named, every):
    who = np.repeat(np.arange(sizes.size), sizes)
    take = wanted[who]
    h, who = h[take], who[take]
    if not h.size:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    c = kind[who]
    groups = np.where(c > 0, (SINGLE * 5 * (100 - percent) // percent) << np.maximum(c - 1, 0), 0).astype(np.uint64)
    group = ((h >> np.uint64(32)) * groups) >> np.uint64(32)
    begins = np.ones(h.size, dtype=bool)
    begins[1:] = (who[1:] != who[:-1]) | (group[1:] != group[:-1]) | (c[1:] == 0)
    at = np.flatnonzero(begins)
    content = np.add.reduceat(mix(h), at)
    who, group, c = who[at], group[at], c[at].astype(np.uint64)
    tag = group * np.uint64(0x9E3779B97F4A7C15) + (c + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    keys = mix(content + tag)
    if every:
        return keys, who
    differ = (100 - percent) * sizes // percent
    sent = _ranks(who) <= differ[who]
    if named is not None:
        plain = np.flatnonzero(~_is_named(keys, named))
        few = np.bincount(who[plain], minlength=sizes.size) <= differ
        sent &= few[who]
        sent[plain[_ranks(who[plain]) <= differ[who[plain]]]] = True
    return keys[sent], who[sent]


def _ends(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))


def _common(rows: DataFrame, percent: int, words: int) -> np.ndarray:
    """The filter of keys that many texts share, by a sample of the texts.

    It bounds work and has no part in results, so a table may be sampled at a fixed rate and the
    filter may hold the NAMED most frequent keys only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, h, sizes in shingle_sets(batch.column(0), words):
                keys, _ = root_keys(h, sizes, percent, every=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    some = rows.filter(F.xxhash64("doc_id", F.lit(SAMPLE)) % SAMPLE == 0).select("text")
    counts = some.mapInArrow(run, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    most = counts.filter(F.col("n") >= LEAST).orderBy(F.desc("n"), "key").limit(NAMED)
    # NAMED numbers at most, as one array; the tasks get a filter of fixed size made of them
    return named_bits(most.select("key").toArrow().column("key").to_numpy().astype(np.int64).view(np.uint64))


def _keyed(rows: DataFrame, percent: int, words: int) -> DataFrame:
    """doc_id, n (set size), whole (128 bits of the set), point (DIMS counts of 16 bits), keys."""
    named = _common(rows, percent, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, count, h, sizes in shingle_sets(batch.column(1), words):
                first = np.cumsum(sizes) - sizes
                full = sizes > 0
                whole = np.zeros((count, 2), dtype=np.uint64)
                if h.size:
                    whole[full, 0] = np.add.reduceat(mix(h), first[full])
                    whole[full, 1] = np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first[full])
                keys, n_keys = root_keys(h, sizes, percent, named)
                who = np.repeat(np.arange(count), sizes)
                cells = np.bincount(
                    who * DIMS + (h & np.uint64(DIMS - 1)).astype(np.int64), minlength=count * DIMS
                ).reshape(count, DIMS)
                # a count that 16 bits cannot hold bounds nothing
                points = np.minimum(cells, 0xFFFF).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, count),
                        pa.array(sizes.astype(np.int64)),
                        pa.array([x.tobytes() for x in whole], pa.binary()),
                        pa.array([p.tobytes() for p in points], pa.binary()),
                        pa.ListArray.from_arrays(_ends(n_keys), pa.array(keys.view(np.int64))),
                    ],
                    names=["doc_id", "n", "whole", "point", "keys"],
                )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, n long, whole binary, point binary, keys array<long>")


def _cut_again(rows: DataFrame, words: int, ids: DataFrame, column: str, kind: str, build) -> DataFrame:
    """doc_id, n and a column built from the sets, for the documents in `ids` (id) and few more.

    Only texts that pass a filter of these ids are cut again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, count, h, sizes in shingle_sets(batch.column(1), words):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, count), pa.array(sizes.astype(np.int64)), build(h, sizes)],
                    names=["doc_id", "n", column],
                )

    bits = id_bits(ids.select(F.xxhash64("id").alias("h")))
    wanted = F.col("doc_id").isNotNull() & passes(F.xxhash64("doc_id"), bits)
    id_kind = dict(rows.dtypes)["doc_id"]
    return settle(rows.filter(wanted).mapInArrow(run, f"doc_id {id_kind}, n long, {column} {kind}"))


def _set_column(h: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(_ends(sizes), pa.array(h.view(np.int64)))


def _fine_column(h: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Points of as many groups (a power of two) as the set has shingles, 8 bits each."""
    out = []
    for part in np.split(h, np.cumsum(sizes)[:-1]):
        dims = min(max(DIMS, 1 << max(part.size - 1, 0).bit_length()), FINEST)
        counts = np.bincount((part & np.uint64(dims - 1)).astype(np.int64), minlength=dims)
        out.append(np.minimum(counts, 0xFF).astype(np.uint8).tobytes())
    return pa.array(out, pa.binary())


def fine_reach(p: bytes, q: bytes, m: int, n: int, percent: int) -> bool:
    """Whether two fine points can link; the finer one is folded to the other's groups."""
    a, b = np.frombuffer(p, dtype=np.uint8), np.frombuffer(q, dtype=np.uint8)
    if a.max() == 0xFF or b.max() == 0xFF:  # a count that 8 bits cannot hold bounds nothing
        return True
    dims = min(a.size, b.size)
    a, b = (x.reshape(-1, dims).sum(axis=0, dtype=np.int64) for x in (a, b))
    return (100 + percent) * int(np.minimum(a, b).sum()) >= percent * (m + n)


def reach(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether points (or boxes, by their largest counts and smallest sizes) can link."""
    common = np.minimum(a, b).sum(axis=-1, dtype=np.int64)
    full = (a.max(axis=-1) == 0xFFFF) | (b.max(axis=-1) == 0xFFFF)
    return ((100 + percent) * common >= percent * (na + nb)) | full


def box_order(points: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sort-tile order: by size into slabs, in a slab by its most varied coordinate."""
    order = np.argsort(n, kind="stable")
    slab = BOX * max(1, int(np.sqrt(n.size / BOX)))
    out = []
    for i in range(0, n.size, slab):
        part = order[i : i + slab]
        widest = int(points[part].astype(np.float64).var(axis=0).argmax())
        out.append(part[np.argsort(points[part, widest], kind="stable")])
    return np.concatenate(out)


def candidates(points: np.ndarray, n: np.ndarray, comp: np.ndarray, side: np.ndarray, percent: int = PERCENT):
    """Pairs of positions in different components that the bound cannot exclude.

    Where `side` has two values, only pairs across them are compared.
    """
    kinds = np.unique(side)
    trees = []
    for kind in kinds:
        own = np.flatnonzero(side == kind)
        order = own[box_order(points[own], n[own])]
        boxes = [order[i : i + BOX] for i in range(0, order.size, BOX)]
        trees.append((boxes, np.array([points[b].max(axis=0) for b in boxes]), np.array([n[b].min() for b in boxes])))
    (boxes_a, most_a, least_a), (boxes_b, most_b, least_b) = trees[0], trees[-1]
    for i, a in enumerate(boxes_a):
        low = i if len(trees) == 1 else 0
        for j in np.flatnonzero(reach(most_a[i][None], most_b[low:], least_a[i], least_b[low:], percent)) + low:
            b = boxes_b[j]
            fit = reach(points[a][:, None], points[b][None], n[a][:, None], n[b][None], percent)
            fit &= comp[a][:, None] != comp[b][None]
            if len(trees) == 1 and i == j:
                fit = np.triu(fit, 1)
            x, y = np.nonzero(fit)
            yield a[x], b[y]


def met_before(lower: np.ndarray, x: np.ndarray, y: np.ndarray, key: int) -> np.ndarray:
    """Whether the pairs of rows x and y have a key below `key` in common among their first ones."""
    out = np.zeros(x.size, dtype=bool)
    for at in range(0, x.size, 1 << 14):
        a, b = lower[x[at : at + (1 << 14)]], lower[y[at : at + (1 << 14)]]
        out[at : at + (1 << 14)] = ((a[:, :, None] == b[:, None, :]) & (a < key)[:, :, None]).any(axis=(1, 2))
    return out


def _beside(df: DataFrame, side: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns of `side` (by doc_id) beside the ids in column `key`, named after it.

    The join has a key of its own, so that both sides are dealt anew and a leader of many splits.
    """
    side = side.select(
        F.xxhash64("doc_id").alias("k"),
        F.col("doc_id").alias("other"),
        *[F.col(c).alias(f"{key}_{c}") for c in columns],
    )
    mine = df.withColumn("k", F.xxhash64(key))
    return mine.join(side, (mine["k"] == side["k"]) & (mine[key] == side["other"])).drop("k", "other")


def _verified(pairs: DataFrame, points: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. The bound first, on points, then on finer ones whose groups
    hold about one shingle; then the sets of what is left."""

    @F.pandas_udf("boolean")
    def possible(p, q, m, n):
        import pandas as pd

        a = np.frombuffer(b"".join(p), dtype="<u2").reshape(-1, DIMS)
        b = np.frombuffer(b"".join(q), dtype="<u2").reshape(-1, DIMS)
        return pd.Series(reach(a, b, m.to_numpy(), n.to_numpy(), percent))

    @F.pandas_udf("boolean")
    def finely_possible(p, q, m, n):
        import pandas as pd

        return pd.Series([fine_reach(*x, percent) for x in zip(p, q, m, n)], dtype=bool)

    def members(found: DataFrame) -> DataFrame:
        return found.select(F.col("a").alias("id")).unionByName(found.select(F.col("b").alias("id"))).distinct()

    near = _beside(_beside(pairs, points, "a", ["n", "point"]), points, "b", ["n", "point"])
    near = settle(near.filter(possible("a_point", "b_point", "a_n", "b_n")).select("a", "b").distinct())
    fine = _cut_again(rows, words, members(near), "fine", "binary", _fine_column)
    near = _beside(_beside(near, fine, "a", ["n", "fine"]), fine, "b", ["n", "fine"])
    near = settle(near.filter(finely_possible("a_fine", "b_fine", "a_n", "b_n")).select("a", "b").distinct())
    sets = _cut_again(rows, words, members(near), "shingles", "array<long>", _set_column)
    full = _beside(_beside(near, sets, "a", ["n", "shingles"]), sets, "b", ["n", "shingles"])
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return full.filter((100 + percent) * common >= percent * (F.col("a_n") + F.col("b_n"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node it reaches) for the nodes of links (a, b).

    Large-star and small-star steps in turn, each kept in the shared folder, until the links are
    stars around their smallest nodes. A node's neighbours are only ever reduced to their
    minimum, so a hub is no large group. Nothing but a count comes to the driver.
    """

    def around(both: DataFrame) -> DataFrame:
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.xxhash64("a").alias("k"), F.col("a").alias("c"), F.least("a", "m").alias("m")
        )
        mine = both.withColumn("k", F.xxhash64("a"))
        return mine.join(least, (mine["k"] == least["k"]) & (mine["a"] == least["c"])).select("a", "b", "m")

    now = settle(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = around(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        stars = around(large)
        small = stars.select("a", "m").unionByName(stars.filter("b <> m").select(F.col("b").alias("a"), "m"))
        now = settle(small.filter("a <> m").select("a", F.col("m").alias("b")).distinct())
        new = now.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if new == mark:
            break
        mark = new
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def jaccard_components(
    docs: DataFrame,
    percent: int = PERCENT,
    words: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id.

    component_id is the smallest doc_id that the document reaches by links, itself included;
    class_id the smallest doc_id with the same set. Sets are of shingles of `words` words; `percent`
    is between 51 and 99.

    A null, empty or wordless text has no shingles and is linked with nothing. Rows that
    share an id are one node, linked by what any of them links with. A row with a null id
    joins the class of its set, and has that class's component; the links of a class
    without any id are not followed. An empty table gives no rows, other
    columns are not read.
    """
    if not 50 < percent < 100:
        raise ValueError("percent must be between 51 and 99")
    small_batches(docs.sparkSession)
    rows = only(docs, doc_id=id_col, text=text_col)
    keyed = settle(_keyed(rows, percent, words))
    reps = (
        keyed.filter("n > 0")
        .groupBy("whole")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
        .select(F.xxhash64("whole").alias("k"), F.col("whole").alias("w"), "rep", "rows")
    )
    reps = settle(reps)
    filled = keyed.filter("n > 0").select("doc_id", "n", "whole", F.xxhash64("whole").alias("k"))
    several = reps.filter("rows > 1")
    copies = filled.join(several, (filled["k"] == several["k"]) & (F.col("whole") == F.col("w"))).filter("doc_id <> rep")
    copies = settle(copies.select(F.xxhash64("doc_id", "whole").alias("h"), F.col("doc_id").alias("copy"), "w").distinct())
    # only copies, and what the filter takes for one, are shuffled to leave them out
    mark = passes(F.xxhash64("doc_id", "whole"), id_bits(copies.select("h")))
    texts = keyed.filter("n > 0 AND doc_id IS NOT NULL")
    compared = texts.filter(mark).join(copies, (F.col("doc_id") == F.col("copy")) & (F.col("whole") == F.col("w")), "left_anti")
    classes = (
        texts.filter(~mark).unionByName(compared).select(F.col("doc_id").alias("rep"), F.explode("keys").alias("key"))
    )
    met = classes.groupBy("key").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    met = settle(met)
    bits = id_bits(met.select(F.col("key").alias("h")))
    shared = classes.filter(passes(F.col("key"), bits)).select("rep", "key", F.xxhash64("key").alias("k"))
    met = met.select(F.xxhash64("key").alias("k"), F.col("key").alias("met_key"), "met")
    members = settle(
        shared.join(met, (shared["k"] == met["k"]) & (F.col("key") == F.col("met_key")))
        .select("rep", "key", "met")
        .distinct()
    )
    # the leader of a key is the member that meets most others over all its keys
    company = members.groupBy("rep").agg(F.sum("met").alias("company"))
    company = company.select(F.xxhash64("rep").alias("k"), F.col("rep").alias("r"), "company")
    weighed = members.withColumn("k", F.xxhash64("rep"))
    weighed = weighed.join(company, (weighed["k"] == company["k"]) & (weighed["rep"] == company["r"]))
    leaders = weighed.groupBy("key").agg(
        F.max(F.struct("company", (-F.xxhash64("rep")).alias("x"), F.col("rep").alias("leader"))).alias("l")
    )
    leaders = leaders.select(F.xxhash64("key").alias("k"), F.col("key").alias("led_key"), F.col("l.leader").alias("leader"))
    marked = members.withColumn("k", F.xxhash64("key"))
    first = settle(
        marked.join(leaders, (marked["k"] == leaders["k"]) & (marked["key"] == leaders["led_key"]))
        .filter("rep <> leader")
        .select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"))
        .distinct()
    )
    points = texts.select("doc_id", "n", "point")
    links = settle(_verified(first, points, rows, words, percent))
    found = settle(components(links))

    second = _second(members, found, points, first, percent)
    second = settle(_verified(second, points, rows, words, percent))
    if not second.isEmpty():
        stars = found.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = settle(components(stars.unionByName(second)))
    reps = reps.join(found, F.col("rep") == F.col("node"), "left").select(
        "k", "w", "rep", F.coalesce("component", "rep").alias("component")
    )
    filled = filled.join(reps, (filled["k"] == reps["k"]) & (F.col("whole") == F.col("w"))).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("rep").alias("class_id"),
    )
    empty = keyed.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.col("doc_id").alias("class_id"),
    )
    return filled.unionByName(empty)


def _second(
    members: DataFrame, found: DataFrame, points: DataFrame, first: DataFrame, percent: int
) -> DataFrame:
    """Pairs (a, b) under one key in different components that no bound excludes.

    A key with members of more than one component is cut into blocks of about BLOCK
    members; each pair of blocks is compared in one task. Like texts share most of their keys, and
    any two in different components that share one meet there, so a pair is left out where a
    lower key, one of the FIRST_KEYS of both, has them too.
    """
    kind = dict(members.dtypes)["rep"]
    apart = members.filter("met > 2").join(found, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "met", F.coalesce("component", "rep").alias("comp")
    )
    mixed = apart.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    mixed = mixed.select(F.xxhash64("key").alias("k"), F.col("key").alias("mixed_key"))
    apart = apart.withColumn("k", F.xxhash64("key"))
    apart = apart.join(mixed, (apart["k"] == mixed["k"]) & (apart["key"] == mixed["mixed_key"]), "left_semi")
    apart = settle(apart.select("key", "rep", "met", "comp"))
    lowest = Window.partitionBy("rep").orderBy("key")
    few = apart.select("rep", "key").withColumn("r", F.row_number().over(lowest)).filter(F.col("r") <= FIRST_KEYS)
    few = few.groupBy("rep").agg(F.sort_array(F.collect_list("key")).alias("few")).withColumnRenamed("rep", "few_rep")
    blocks = F.ceil(F.col("met") / BLOCK).cast("long")
    apart = apart.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")))
    other = F.explode(F.expr("sequence(0L, blocks - 1)"))
    apart = apart.withColumn("other", other).select(
        "key", "rep", "comp", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    apart = apart.join(few, F.col("rep") == F.col("few_rep")).join(points, F.col("rep") == F.col("doc_id"))
    apart = apart.select("key", "i", "j", "block", "rep", "comp", "n", "point", "few")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            bounds = _runs(held)
            if len(bounds) > 2:  # the last group may go on in the next batch
                yield from _compare(held.slice(0, bounds[-2]), bounds[:-1])
                held = held.slice(bounds[-2])
        if held is not None and held.num_rows:
            yield from _compare(held, _runs(held))

    def _runs(t: pa.Table) -> list[int]:
        n = t.num_rows
        change = np.zeros(max(n - 1, 0), dtype=bool)
        for c in ("key", "i", "j"):
            v = t.column(c).to_numpy()
            change |= v[1:] != v[:-1]
        return [0, *(np.flatnonzero(change) + 1).tolist(), n]

    def _compare(t: pa.Table, bounds: list[int]) -> Iterator[pa.RecordBatch]:
        n, comp, side, key = (t.column(c).to_numpy() for c in ("n", "comp", "block", "key"))
        few = t.column("few").combine_chunks()
        lengths = np.diff(few.offsets.to_numpy())
        lower = np.full((t.num_rows, FIRST_KEYS), np.iinfo(np.int64).max)
        lower[np.arange(FIRST_KEYS) < lengths[:, None]] = few.flatten().to_numpy()
        points = np.frombuffer(b"".join(t.column("point").to_pylist()), dtype="<u2").reshape(-1, DIMS)
        xs, ys = [], []
        for low, high in zip(bounds, bounds[1:]):
            if high - low < 2:
                continue
            for x, y in candidates(points[low:high], n[low:high], comp[low:high], side[low:high], percent):
                new = ~met_before(lower[low:high], x, y, key[low])
                xs.append(x[new] + low)
                ys.append(y[new] + low)
        if xs:
            rep = t.column("rep").combine_chunks()
            x, y = rep.take(pa.array(np.concatenate(xs))), rep.take(pa.array(np.concatenate(ys)))
            yield pa.RecordBatch.from_arrays([x, y], names=["x", "y"])

    pairs = (
        apart.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(run, f"x {kind}, y {kind}")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    return pairs.join(first, ["a", "b"], "left_anti")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
