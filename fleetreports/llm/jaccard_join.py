"""N-gram Jaccard join: size-aware, light sets by subsets, heavy sets by lists.

A document's set is its distinct 3-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``); with fewer words the whole sequence is one shingle.
Two documents are linked if 100 * |A and B| >= 90 * |A or B|, that is, if they
have at least o(a, b) = ceil(9 * (a + b) / 19) shingles in common.

1. One pass over the texts gives every document the size and a 128-bit hash of
   its set, and the set's prefix: the p = n - ceil(0.9 n) + l shingles of least
   hash, l = n // 12 + 1. Equal sets are one class from here on. A linked pair
   has at least the smaller l of the two in common within the prefixes.
2. *Light sets* (up to x shingles) list their subsets of exactly o(a, b)
   shingles for every pair of sizes (a, b) that can be linked and occurs. Sets
   that list the same subset for the same (a, b) are linked if one of them has
   the smaller size; all are linked to the least such member, so no group is
   expanded into pairs.
3. *Heavy sets* scan inverted lists. The lists hold the prefixes of all sets
   that a heavy one can be linked with; a set with fewer than l listed shingles
   in lists of several sets is out. First every list is compared with one
   member, whose shingles are the most common; pairs with enough common prefix
   shingles are confirmed on the full sets. Sets that are then still in lists
   with several components scan lists of their full sets, rarest shingle first
   (rarity in classes, read from bitmaps of the counted shingles):
   the larger set of a linked pair has a common shingle among its first
   a - ceil(0.9 a) + 1, the smaller among its first b - ceil(18 b / 19) + 1, and
   from there on both have o(a, b) shingles left that are not theirs alone. So a
   passage that many sets hold is not expanded, and no link is lost.
4. The boundary x is the one of least cost: subsets listed by the sets up to x,
   against entries of the lists that the sets above x scan, both counted.
5. Connected components of the links.

Defined cases: null or wordless texts have an empty set and are linked with
nothing (their component is their own doc_id); rows with a null doc_id get a
null component_id and link nothing; repeated rows give repeated result rows; a
doc_id with several texts is one node with the links of all of them. Only
``doc_id`` and ``text`` are read, whatever further columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetreports.llm import words as W
from fleetreports.llm.bitmaps import hash_filter, id_filter, low_spots, passes, spot_of
from fleetreports.llm.components import components
from fleetreports.llm.tables import dropped, released, stored

SHINGLE = 3
LEAST = 9  # sets of fewer shingles are linked with equal sets only
LIGHT_MOST = 32  # the boundary is looked for up to this size
MORE = 12  # l = n // MORE + 1
PEELS = 2
LEVELS = (2, 4, 16, 64, 256, 1024)  # sets that hold a shingle: classes of rarity

_SIG = "doc_id bigint, n_shingles bigint, set_hi bigint, set_lo bigint, prefix array<bigint>, small array<bigint>"
_SETS = "rep bigint, set_hi bigint, shingles array<bigint>"
_SET = ["set_hi", "set_lo", "n_shingles"]


def overlap(a: int, b: int) -> int:
    """Common shingles that link sets of a and b shingles."""
    return -(-9 * (a + b) // 19)


def partners(n: int) -> list[tuple[int, int]]:
    """Pairs of sizes (a, b), a <= b, one of them n, whose sets can be linked
    without being equal."""
    pairs = [(n, b) for b in range(n, 10 * n // 9 + 1)] + [(a, n) for a in range(-(-9 * n // 10), n)]
    return [(a, b) for a, b in pairs if overlap(a, b) <= a and overlap(a, b) < b]


def n_subsets(n: int, sizes: frozenset[int]) -> int:
    """Subsets that a set of n shingles lists if the ``sizes`` occur."""
    return sum(comb(n, overlap(a, b)) for a, b in partners(n) if {a, b} <= sizes)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in W.chunks(batches):
        n = len(c)
        sets, off = W.shingles(W.words(c, lower=True), SHINGLE, n)
        size = np.diff(off)
        full = size > 0
        hi, lo = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        if len(sets):
            hi[full] = np.add.reduceat(W.mix(sets), off[:-1][full])
            lo[full] = np.add.reduceat(W.mix(sets ^ np.uint64(0xA5A5A5A55A5A5A5A)), off[:-1][full])
        place = np.arange(len(sets)) - np.repeat(off[:-1], size)  # sets are sorted by hash
        first = np.where(size >= LEAST, size - (9 * size + 9) // 10 + size // MORE + 1, 0)
        few = np.where(size <= LIGHT_MOST, np.where(size >= LEAST, size, 0), 0)
        ends = lambda x: np.concatenate(([0], np.cumsum(x)))
        yield pa.RecordBatch.from_arrays(
            [c.rows.column(0), pa.array(size), pa.array(W.signed(hi)), pa.array(W.signed(lo)),
             W.lists(W.signed(sets[place < np.repeat(first, size)]), ends(first)),
             W.lists(W.signed(sets[place < np.repeat(few, size)]), ends(few))],
            names=["doc_id", "n_shingles", "set_hi", "set_lo", "prefix", "small"])


def _shared(bitmap, bits: int):
    """Representatives with the prefix shingles that pass the bitmap, if they are
    enough for a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.asarray(b.column(2))
            tokens = np.asarray(b.column(3).flatten())
            of = np.repeat(np.arange(len(n)), np.asarray(b.column(3).value_lengths()))
            met = passes(bitmap.value, low_spots(tokens.view(np.uint64), bits))
            count = np.bincount(of[met], minlength=len(n))
            keep = count >= (9 * n + 9) // 10 // MORE + 1
            met &= keep[of]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i).filter(pa.array(keep)) for i in range(3)), W.lists(tokens[met], np.concatenate(([0], np.cumsum(count[keep]))))],
                names=["rep", "set_hi", "n", "tokens"])
    return run


def _sets(bitmap):
    """Full sets of the rows whose id passes the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = (b.filter(pa.array(passes(bitmap.value, np.asarray(b.column(2))))) for b in batches)
        for c in W.chunks(wanted):
            sets, off = W.shingles(W.words(c, lower=True), SHINGLE, len(c))
            size = np.diff(off)
            hi = np.zeros(len(c), np.uint64)
            if len(sets):
                hi[size > 0] = np.add.reduceat(W.mix(sets), off[:-1][size > 0])
            yield pa.RecordBatch.from_arrays([c.rows.column(0), pa.array(W.signed(hi)), W.lists(W.signed(sets), off)],
                                             names=["rep", "set_hi", "shingles"])
    return run


# ------------------------------------------------------------------ light sets


def _left_out(n: int, k: int) -> np.ndarray:
    """Which k of n places a subset leaves out, one row for each subset."""
    return np.array(list(combinations(range(n), k)), np.int64).reshape(comb(n, k), k)


def _subsets(sizes: frozenset[int]):
    """(a, b, subset's 128-bit hash, rep, whether the set has the smaller size)
    of light sets (rep, small)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "sub_hi", "sub_lo", "rep", "smaller"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # some 6,000 subsets a set at most
                some = batch.slice(at, 256)
                reps = np.asarray(some.column(0))
                size = np.asarray(some.column(1).value_lengths())
                flat = np.asarray(some.column(1).flatten()).view(np.uint64)
                off = np.concatenate(([0], np.cumsum(size)))
                for n in np.unique(size).tolist():
                    rows = np.flatnonzero(size == n)
                    sets = flat[off[rows][:, None] + np.arange(n)]
                    keys = [W.mix(sets), W.mix(sets ^ np.uint64(0xA5A5A5A55A5A5A5A))]
                    for a, b in partners(n):
                        if not {a, b} <= sizes:
                            continue
                        out = _left_out(n, n - overlap(a, b))
                        sums = [(k.sum(1, dtype=np.uint64)[:, None] - k[:, out].sum(2, dtype=np.uint64)).ravel() for k in keys]
                        m = len(sums[0])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(m, a, np.int32)), pa.array(np.full(m, b, np.int32)), pa.array(W.signed(sums[0])),
                             pa.array(W.signed(sums[1])), pa.array(np.repeat(reps[rows], len(out))), pa.array(np.full(m, n == a))], names=names)
    return run


def _light_links(reps: DataFrame, most: int, sizes: frozenset[int]) -> DataFrame:
    """Links (a, b) between sets of up to ``most`` shingles."""
    subsets = (reps.where(f"n between {LEAST} and {most}").select("rep", "small")
               .mapInArrow(_subsets(frozenset(s for s in sizes if s <= most)), "a int, b int, sub_hi bigint, sub_lo bigint, rep bigint, smaller boolean"))
    key = ["a", "b", "sub_hi", "sub_lo"]
    groups = (subsets.groupBy(*key).agg(F.count("*").alias("members"), F.min(F.expr("if(smaller, rep, null)")).alias("to"))
              .where("members > 1 and to is not null").drop("members"))
    return (subsets.join(groups, key).where("rep <> to")
            .select(F.greatest("rep", "to").alias("a"), F.least("rep", "to").alias("b")).distinct())


# ------------------------------------------------------------------ heavy sets


def _of(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets of these reps (the one column), and a few more."""
    bits = _bits(ids)
    bitmap = sets.sparkSession.sparkContext.broadcast(id_filter(ids, F.col(ids.columns[0]), bits))
    return sets.withColumn("spot", spot_of(F.col("rep"), bits)).mapInArrow(_only(bitmap), _SETS)


def _only(bitmap):
    """Sets whose rep passes the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(passes(bitmap.value, np.asarray(b.column(3))))).select([0, 1, 2])
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, a_hi, b, b_hi) that are links by their full sets; a table.
    Only sets that are in a pair are shuffled."""
    pairs = stored(pairs, "pairs")
    left, right = (_of(sets, pairs.select(side).distinct()).toDF(side, f"{side}_hi", f"s{side}") for side in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    linked = 100 * both >= 90 * (F.size("sa") + F.size("sb") - both)
    links = stored(pairs.join(left, ["a", "a_hi"]).join(right, ["b", "b_hi"]).where(linked).select("a", "b").distinct(), "links")
    dropped(pairs)
    return links


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of each list's members with its middle, in different components,
    that have as many list entries in common as linked sets have."""
    open_lists = (lists.groupBy("token")
                  .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.struct("common", -F.col("rep"), "set_hi", "label", "n")).alias("mid"))
                  .where("low < high"))
    mids = open_lists.select("token", (-F.col("mid.col2")).alias("b"), F.col("mid.set_hi").alias("b_hi"),
                             F.col("mid.label").alias("label_b"), F.col("mid.n").alias("n_b"))
    return (lists.join(mids, "token").where("label <> label_b and 10 * least(n, n_b) >= 9 * greatest(n, n_b)")
            .groupBy(F.col("rep").alias("a"), F.col("set_hi").alias("a_hi"), "b", "b_hi")
            .agg(F.count("*").alias("met"), F.min(F.least("n", "n_b")).alias("n"))
            .where(f"met >= floor(n / {MORE}) + 1").select("a", "a_hi", "b", "b_hi"))


def _ranked(bitmaps):
    """(rep, set_hi, n, first, left, shingle): each set's rarest shingles, without
    those that are its alone, as many as a larger set scans; ``first`` tells how many
    of them a smaller set is listed under, ``left`` what the set has from there on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                n = np.asarray(some.column(2).value_lengths()).astype(np.int64)
                flat = np.asarray(some.column(2).flatten())
                of = np.repeat(np.arange(len(n)), n)
                level = np.zeros(len(flat), np.int64)
                for held in bitmaps.value:
                    level += passes(held, low_spots(flat.view(np.uint64), (8 * len(held)).bit_length() - 1))
                order = np.lexsort((flat, level, of))
                alone = np.bincount(of[level == 0], minlength=len(n))
                place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n) - alone[of]  # (order keeps the documents' runs)
                larger = n - (9 * n + 9) // 10 + 1 - alone
                smaller = n + (-18 * n // 19) + 1 - alone
                keep = (place >= 0) & (place < larger[of])
                of, place = of[keep], place[keep]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(of)), some.column(1).take(pa.array(of)), pa.array(n[of]), pa.array(place < smaller[of]),
                     pa.array((n - alone)[of] - place), pa.array(flat[order][keep])],
                    names=["rep", "set_hi", "n", "listed", "left", "shingle"])
    return run


def _scan_pairs(still: DataFrame, sets: DataFrame, most: int) -> DataFrame:
    """Pairs of ``still`` (rep, set_hi, label) in different components, one of
    them heavy, that meet in lists of their full sets; step 3 of the module."""
    sc = sets.sparkSession.sparkContext
    sets = _of(sets, still.select("rep"))
    df = stored(sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "lists")
    levels = []
    for least in LEVELS:
        some = df.where(F.col("df") >= least)
        levels.append(hash_filter(some, F.col("shingle"), _bits(some, 27)))
    dropped(df)
    ranked = sets.mapInArrow(_ranked(sc.broadcast(levels)), "rep bigint, set_hi bigint, n bigint, listed boolean, left bigint, shingle bigint")
    ranked = stored(ranked.join(still, ["rep", "set_hi"]), "scanned")
    several = ranked.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("shingle")
    ranked = ranked.join(several, "shingle")
    small = ranked.where("listed").select(
        "shingle", F.col("rep").alias("b"), F.col("set_hi").alias("b_hi"), F.col("n").alias("n_b"),
        F.col("label").alias("label_b"), F.col("left").alias("left_b"))
    return (ranked.join(small, "shingle")
            .where(f"label <> label_b and n > {most} and struct(n_b, b) < struct(n, rep) and 10 * n_b >= 9 * n "
                   "and 19 * least(left, left_b) >= 9 * (n + n_b)")
            .select(F.col("rep").alias("a"), F.col("set_hi").alias("a_hi"), "b", "b_hi").distinct())


def _boundary(posted: DataFrame, sizes: DataFrame) -> tuple[int, frozenset[int]]:
    """The light sets' greatest size, by cost, and the sizes that occur up to
    LIGHT_MOST (at most so many rows come to the driver)."""
    count = {r.n: r.sets for r in sizes.where(f"n <= {LIGHT_MOST}").collect()}
    scans = {r.n: r.scan for r in posted.where(f"n <= {LIGHT_MOST}").groupBy("n").agg(F.sum("common").alias("scan")).collect()}
    occur = frozenset(count)
    cost = lambda x: (sum(m * n_subsets(n, occur) for n, m in count.items() if n <= x)
                      + sum(s for n, s in scans.items() if n > x))
    return min(range(LEAST - 1, LIGHT_MOST + 1), key=cost), occur


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id. See the module for the method and the defined cases."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sig = stored(docs.mapInArrow(_signatures, _SIG), "signatures")
    classes = stored(sig.where("n_shingles > 0 and doc_id is not null").groupBy(*_SET)
                     .agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("small").alias("small")), "classes")
    rows = stored(sig.select("doc_id", *_SET), "rows")
    dropped(sig)
    reps = classes.where(f"n_shingles >= {LEAST}").withColumnRenamed("n_shingles", "n")
    classes = classes.select("rep", *_SET)

    # Inverted lists of the prefixes, without the entries that stand alone.
    sc = docs.sparkSession.sparkContext
    df = stored(reps.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "lists")
    bits = _bits(df)
    some = reps.select("rep", "set_hi", "n", "prefix").mapInArrow(
        _shared(sc.broadcast(hash_filter(df, F.col("token"), bits)), bits), "rep bigint, set_hi bigint, n bigint, tokens array<bigint>")
    posted = stored(some.select("rep", "set_hi", "n", F.explode("tokens").alias("token")).join(df, "token").groupBy("rep", "set_hi", "n")
                    .agg(F.collect_list("token").alias("tokens"), F.sum("df").alias("common")).where(_enough("size(tokens)")), "postings")
    dropped(df)
    most, occur = _boundary(posted, reps.groupBy("n").agg(F.count("*").alias("sets")))

    links = [stored(_light_links(reps, most, occur), "links")]
    # One doc_id with several texts: its classes belong together.
    links.append(stored(rows.where("n_shingles > 0 and doc_id is not null").join(classes, _SET).where("doc_id <> rep")
                        .groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.collect_set("rep").alias("reps"))
                        .where("low < high").select(F.col("doc_id").alias("a"), F.explode("reps").alias("b")), "links"))
    # A class whose least id is such a doc_id too is that node itself.

    heavy = posted.where(f"10 * n >= 9 * {most + 1}")
    bits = _bits(heavy)
    bitmap = sc.broadcast(id_filter(heavy, F.col("rep"), bits))
    found = docs.where("doc_id is not null").select("doc_id", "text", spot_of(F.col("doc_id"), bits).alias("spot")).mapInArrow(_sets(bitmap), _SETS)
    sets = stored(found, "sets")
    if sets.select("rep", "set_hi").distinct().count() < sets.count():  # rows that come again
        old, sets = sets, stored(sets.dropDuplicates(["rep", "set_hi"]), "sets")
        dropped(old)
    released(docs.sparkSession)

    def labelled() -> tuple[DataFrame, DataFrame]:
        label = components(_union(links))
        lists = (heavy.select("rep", "set_hi", "n", "common", F.explode("tokens").alias("token"))
                 .join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep")))
        return label, lists

    label, lists = labelled()
    links.append(_confirmed(_star_pairs(lists), sets))
    dropped(label)
    released(docs.sparkSession)
    label, lists = labelled()
    for _ in range(PEELS):  # without those that are out, others have too few
        several = lists.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
        lists = lists.join(several, "token")
        still = stored(lists.groupBy("rep", "set_hi", "label", "n").agg(F.count("*").alias("open")).where(_enough("open")).drop("open"), "still")
        lists = lists.join(still.select("rep", "set_hi"), ["rep", "set_hi"], "left_semi")
    links.append(_confirmed(_scan_pairs(still.select("rep", "set_hi", "label"), sets, most), sets))
    dropped(label, posted, sets)
    label = components(_union(links))
    dropped(*links)

    named = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").select(*_SET, F.coalesce("label", "rep").alias("component"))
    return (rows.join(named, _SET, "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def _enough(count: str) -> str:
    """As many prefix shingles as a set of n has in common with any linked set."""
    return f"{count} >= floor(ceil(0.9 * n) / {MORE}) + 1"


def _bits(entries: DataFrame, most: int = 29) -> int:
    """Size of a bitmap for so many entries: 32 to 64 bits each, up to 64 MB in
    all; beyond that more pass it than need to, and the exact steps see them."""
    return max(20, min(most, (32 * entries.count()).bit_length()))


def _union(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for x in links[1:]:
        out = out.unionByName(x)
    return out
