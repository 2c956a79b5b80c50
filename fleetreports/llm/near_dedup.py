"""MinHash near-duplicate classes by a signature-coordinate inverted join.

A document's set is its distinct 5-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``); with fewer words the whole sequence is one shingle.
Two documents are linked if 100 * |A and B| >= 75 * |A or B|.

1. One pass over the texts gives every document the size and a 128-bit hash of
   its set, and a MinHash signature of K = 64 coordinates, kept as 64 tokens
   (one hash per coordinate and value). Equal sets fall into one class at once.
2. Every class representative is posted under its tokens. A linked pair shares
   at least T = 30 of the 64 tokens but for a chance below 1e-6 at the
   similarity bound. Hence *prefix merging*: in the order rarest token first,
   two representatives with T common tokens share one among the first
   K - T + 1 of each, so only these are merged, tokens that one representative
   alone has need no posting, and a representative with fewer than T shared
   tokens is out. *Skip merging*: a posting list whose members are already in
   one component is skipped.
3. Long lists are not expanded into pairs: first every list is compared with
   one member, the one whose tokens are the most common (the original of a
   group of edited copies has most of them). Representatives that are then still
   in lists with several components are merged on their full sets, again by
   prefix, rarest shingle first: a pair at the similarity shares one among the
   larger set's first |A| - ceil(3/4 |A|) + 1 and the smaller set's first
   |B| - ceil(6/7 |B|) + 1, and enough of either set comes after it. A passage that many documents share is not among a
   document's rarest shingles, so its crowd is not expanded, and no pair is
   lost. Pairs with T collisions are confirmed on the full shingle sets.
4. Connected components of the confirmed links; component_id is the smallest
   doc_id that can be reached.

Defined cases: null or wordless texts have an empty set, are linked with
nothing and are kept; rows with a null doc_id get a null component_id and are
kept; repeated rows give repeated result rows; a doc_id that comes with several
texts does not link these, and where it is the smallest of several classes only one
of them is compared further. Only ``doc_id`` and ``text`` are read, so further
columns, whatever their names, play no part in the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fleetreports.llm import words as W
from fleetreports.llm.bitmaps import id_filter, passes, spot_of
from fleetreports.llm.components import components
from fleetreports.llm.tables import dropped, stored

SHINGLE, K, T, STAR_ROUNDS = 5, 64, 30, 1
_RNG = np.random.Generator(np.random.PCG64(77))
_ADD = _RNG.integers(0, 1 << 64, K, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 64, K, dtype=np.uint64) | np.uint64(1)

_SIG = "doc_id bigint, n_shingles bigint, set_hi bigint, set_lo bigint, tokens array<bigint>"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in W.chunks(batches, size=W.PIECE):
        n = len(c)
        sets, off = W.shingles(W.words(c, lower=True), SHINGLE, n)
        size = np.diff(off)
        full = size > 0
        hi, lo = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        tokens = np.zeros((int(full.sum()), K), np.uint64)
        if len(sets):
            at = off[:-1][full]
            hi[full] = np.add.reduceat(W.mix(sets), at)
            lo[full] = np.add.reduceat(W.mix(sets ^ np.uint64(0xA5A5A5A55A5A5A5A)), at)
            for k in range(K):
                tokens[:, k] = np.minimum.reduceat((sets ^ _ADD[k]) * _MUL[k], at)
            tokens = W.mix(tokens * np.uint64(K) + np.arange(K, dtype=np.uint64))
        where = np.concatenate(([0], np.cumsum(full * K)))
        yield pa.RecordBatch.from_arrays(
            [c.rows.column(0), pa.array(size), pa.array(W.signed(hi)), pa.array(W.signed(lo)),
             W.lists(W.signed(tokens.ravel()), where)],
            names=["doc_id", "n_shingles", "set_hi", "set_lo", "tokens"])


def _sets(bitmap):
    """Shingle sets of the rows whose id passes the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wanted():
            for b in batches:
                spots = np.asarray(b.column(2))
                yield b.filter(pa.array(passes(bitmap.value, spots)))
        for c in W.chunks(wanted(), size=W.PIECE):
            sets, off = W.shingles(W.words(c, lower=True), SHINGLE, len(c))
            yield pa.RecordBatch.from_arrays([c.rows.column(0), W.lists(W.signed(sets), off)], names=["doc_id", "shingles"])
    return run


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose full sets (columns 2, 3) reach the similarity."""
    for b in batches:
        left, right = b.column(2), b.column(3)
        lv, lo = np.asarray(left.values), np.asarray(left.offsets)
        rv, ro = np.asarray(right.values), np.asarray(right.offsets)
        keep = np.zeros(b.num_rows, bool)
        for i in range(b.num_rows):
            x, y = lv[lo[i]:lo[i + 1]], rv[ro[i]:ro[i + 1]]
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= 75 * (len(x) + len(y) - both)
        yield b.select([0, 1]).filter(pa.array(keep))


def _open_pairs(reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``reps`` (rep, label) in different components that share a
    shingle among the rarest of their full sets; see step 3 of the module."""
    flat = sets.select(F.col("doc_id").alias("rep"), F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    df = flat.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    alone = F.col("n") - F.size("p")  # shingles of one set only come first and meet nothing
    probe, index = F.expr("n - ceil(0.75 * n) + 1"), F.expr("n - ceil(6 * n / 7) + 1")
    ranked = (flat.join(df, "shingle").groupBy("rep", "n")
              .agg(F.sort_array(F.collect_set(F.struct("df", "shingle"))).alias("p"))  # one document's shingles
              .join(reps, "rep").select("rep", "label", "n", (index - alone).alias("index"), alone.alias("alone"),
                      F.posexplode(F.slice("p.shingle", F.lit(1), F.greatest(F.lit(0), (probe - alone).cast("int")))).alias("at", "shingle")))
    several = ranked.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("shingle")
    ranked = ranked.join(several, "shingle")
    # What both sets have in common begins, in the order of rarity, at the first such shingle.
    ranked = ranked.withColumn("rest", F.expr("n - alone - at"))
    small = ranked.where("at < index").select(F.col("shingle").alias("shingle_b"), F.col("rep").alias("b"), F.col("n").alias("n_b"),
                                              F.col("label").alias("label_b"), F.col("rest").alias("rest_b"))
    return (ranked.join(small, F.expr("shingle = shingle_b and label <> label_b and struct(n_b, b) < struct(n, rep) and 4 * n_b >= 3 * n "
                                      "and 7 * least(rest, rest_b) >= 3 * (n + n_b)"))
            .select(F.col("rep").alias("a"), "b"))


def _links(pairs: DataFrame, tokens: DataFrame, sets: DataFrame) -> DataFrame | None:
    """The pairs (a, b) with T collisions, confirmed on full sets; a table."""
    ta = tokens.select(F.col("rep").alias("a"), F.col("tokens").alias("ta"))
    tb = tokens.select(F.col("rep").alias("b"), F.col("tokens").alias("tb"))
    sa = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    near = (pairs.join(ta, "a").join(tb, "b")
            .where(F.size(F.array_intersect("ta", "tb")) >= T).select("a", "b").distinct())
    links = stored(near.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb")
                   .mapInArrow(_confirmed, "a bigint, b bigint"), "links")
    if links.isEmpty():
        dropped(links)
        return None
    return links


def _classified(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the set's hash and size, and the
    component of its class (the doc_id for an empty set)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sig = stored(docs.mapInArrow(_signatures, _SIG), "signatures")
    by_set = ["set_hi", "set_lo", "n_shingles"]
    rows = sig.drop("tokens")
    classes = stored(rows.where("n_shingles > 0 and doc_id is not null").groupBy(*by_set)
                     .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")), "classes")
    reps = (sig.where("n_shingles > 0").join(classes.select(F.col("rep").alias("doc_id"), *by_set), ["doc_id", *by_set])
            .select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "tokens").dropDuplicates(["rep"]))

    # Postings: tokens of at least two representatives, each representative's rarest first.
    flat = reps.select("rep", "n", F.explode("tokens").alias("token"))
    df = flat.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = (flat.join(df, "token").groupBy("rep", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("p")).where(F.size("p") >= T))
    posted = stored(shared.select(
        "rep", "n", F.aggregate("p", F.lit(0).cast("bigint"), lambda s, x: s + x["df"]).alias("common"),
        F.col("p.token").alias("tokens"),
        F.slice("p.token", 1, F.greatest(F.lit(0), F.size("p") - (T - 1))).alias("prefix")), "postings")

    # The full sets of what is posted, for the confirmation.
    bitmap = docs.sparkSession.sparkContext.broadcast(id_filter(posted, F.col("rep")))
    sets = stored(docs.where("doc_id is not null").select("doc_id", "text", spot_of(F.col("doc_id")).alias("spot"))
                  .mapInArrow(_sets(bitmap), "doc_id bigint, shingles array<bigint>"), "sets")

    links: list[DataFrame] = []
    label = None
    for step in range(STAR_ROUNDS + 1):
        lists = posted.select("rep", "n", "common", F.explode("prefix").alias("token"))
        if label is None:
            lists = lists.withColumn("label", F.col("rep"))
        else:
            lists = lists.join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        open_lists = (lists.groupBy("token")
                      .agg(F.min("label").alias("low"), F.max("label").alias("high"),
                           F.max(F.struct("common", -F.col("rep"), "label", "n")).alias("mid"))
                      .where("low < high"))
        if step < STAR_ROUNDS:
            mids = open_lists.select("token", (-F.col("mid.col2")).alias("b"), F.col("mid.label").alias("label_b"), F.col("mid.n").alias("n_b"))
            pairs = lists.join(mids, "token").where("label <> label_b and 4 * least(n, n_b) >= 3 * greatest(n, n_b)").select(F.col("rep").alias("a"), "b")
        else:
            still = lists.join(open_lists.select("token"), "token").select("rep", "label").distinct()
            pairs = _open_pairs(still, sets)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = _links(pairs, posted.select("rep", "tokens"), sets)
        if found is None:
            if step < STAR_ROUNDS:
                continue
            break
        links.append(found)
        every = links[0]
        for x in links[1:]:
            every = every.unionByName(x)
        old, label = label, components(every)
        dropped(old)
    dropped(posted, sets, *links)

    if label is not None:
        named = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left")
    else:
        named = classes.withColumn("label", F.lit(None).cast("bigint"))
    named = named.select(*by_set, F.coalesce("label", "rep").alias("class_label"))
    return rows.join(named, by_set, "left").select("doc_id", *by_set, F.coalesce("class_label", "doc_id").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id, kept. See the module for the method and the defined cases."""
    return _classified(docs).select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component"))).alias("kept"))


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, with the hash and size of their sets (as in ``_signatures``)."""
    for c in W.chunks(batches, size=W.PIECE):
        sets, off = W.shingles(W.words(c, lower=True), SHINGLE, len(c))
        size = np.diff(off)
        hi, lo = np.zeros(len(c), np.uint64), np.zeros(len(c), np.uint64)
        if len(sets):
            at = off[:-1][size > 0]
            hi[size > 0] = np.add.reduceat(W.mix(sets), at)
            lo[size > 0] = np.add.reduceat(W.mix(sets ^ np.uint64(0xA5A5A5A55A5A5A5A)), at)
        yield pa.RecordBatch.from_arrays([*c.rows.columns, pa.array(W.signed(hi)), pa.array(W.signed(lo)), pa.array(size)],
                                         names=[*c.rows.schema.names, *_KEY])


_KEY = ["_set_hi", "_set_lo", "_set_size"]


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for near-duplicates, decided by row: of each class
    one row with the smallest doc_id stays, whatever other texts come with the same
    doc_id; of rows that are equal in doc_id and set, one. A class whose rows all have a
    null doc_id keeps one of them; null-id rows of other classes go. Rows without
    a word stay. (A doc_id that is the smallest of several classes keeps one row of
    each.) Only repeated rows are shuffled with their texts."""
    verdict = stored(_classified(docs).where("n_shingles > 0").groupBy("doc_id", "set_hi", "set_lo", "n_shingles")
                     .agg(F.count("*").alias("rows"), F.first("component").alias("component")), "verdict")
    key = ["set_hi", "set_lo", "n_shingles"]
    named = verdict.where("doc_id is not null").select(*key).distinct().withColumn("named", F.lit(True))
    verdict = (verdict.join(named, key, "left").withColumn("stays", F.expr("if(doc_id is null, named is null, doc_id = component)"))
               .select(F.col("doc_id").alias("_id"), *(F.col(k).alias(f"_{k}") for k in key), "rows", "stays"))
    verdict = stored(verdict, "verdict")
    schema = StructType([*docs.schema.fields, *(StructField(k, LongType()) for k in _KEY)])
    rows = docs.mapInArrow(_with_sets, schema)
    same = (F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_set_hi") == F.col("__set_hi"))
            & (F.col("_set_lo") == F.col("__set_lo")) & (F.col("_set_size") == F.col("_size")))
    verdict_key = verdict.withColumnsRenamed({"_set_hi": "__set_hi", "_set_lo": "__set_lo", "_n_shingles": "_size"})
    out = rows.join(verdict_key.where("not stays or rows > 1"), same, "left_anti")
    repeated = verdict_key.where("stays and rows > 1")
    if not repeated.isEmpty():
        one = rows.join(repeated, same, "left_semi")
        out = out.unionByName(one.groupBy(F.col("doc_id").cast("bigint").alias("_id"), *_KEY).agg(F.first(F.struct(*docs.columns)).alias("_row"))
                              .select("_row.*", *_KEY))
    return out.drop(*_KEY)
