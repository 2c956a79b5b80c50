"""SimHash fingerprints, and all fingerprints within a Hamming radius.

A document's terms are its 3-word shingles (words ``[^\\x20\\x09-\\x0D]+``,
unchanged; the whole sequence where there are fewer words), each weighted by how
often it occurs. Every term's 128-bit hash votes with its weight, +1 or -1, on
each bit; the fingerprint holds the signs, as 32 hex digits. Two fingerprints'
likeness is 1 - hamming / 128.

``within``: permuted block tables. A fingerprint is cut into ``BLOCKS`` = 8 blocks of 16
bits, and each block leads one table of all fingerprints. Two fingerprints within
``RADIUS`` bits of each other differ, in at least one table, by no more than the
table's share of the radius (``shares``: 3 bits in seven tables, 2 in the last), so a
query (rows whose doc_id is divisible by ``query_step``) looks up in each table the
values of the leading block that are that near, 697 of 65,536, and compares the
fingerprints found there, 7.7 % of all. A pair counts in the first table that finds
it. ``RADIUS`` = 30 bits follows from the similarity to be found: texts with a
Jaccard similarity of shingles of 0.75 are 22 bits apart on average (a cosine of
0.857, an angle of 0.17 pi), with a standard deviation of 4; two unrelated texts
are within 30 bits by chance once in 1.5e9 pairs. Equal fingerprints are one entry
with a count; tasks return sums, not pairs. The tables are dealt to tasks by the first
bits of the leading block, more bits for more rows, and a part that a crowd of near
copies fills beyond ``CELL_PRINTS`` is cut further.

Defined cases: null text counts as empty; a text without words has no term and
the fingerprint 0; ties of the vote give bit 0; rows with a null doc_id come last
in the order; repeated rows are separate rows, in the order of their texts'
hashes; one row alone is its own next document. Only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetreports.llm import words as W
from fleetreports.llm.tables import dropped, stored

TERM, BITS_ALL, RADIUS = 3, 128, 30
ROWS_PER_RANGE, MAX_RANGES = 2000, 100_000
#: Tables, and bits of the block that leads each.
BLOCKS, BLOCK_BITS = 8, 16
#: Fingerprints and queries of a cell; the least bits that deal a table out; candidates compared at once.
CELL_PRINTS, CELL_QUERIES, LEAST_BITS, _PAIRS = 1 << 16, 1 << 18, 3, 1 << 20


def _votes(c: W.Chunk) -> np.ndarray:
    """Fingerprints of a chunk's texts: uint64, two halves a row."""
    n, w = len(c), W.words(c)
    count = np.diff(w.first)
    value, begin = W.runs(w, TERM)
    at = np.searchsorted(begin, w.first)
    out = np.zeros((n, 2), np.uint64)
    full = np.flatnonzero(count >= TERM)
    for half in range(2):
        h = value if half == 0 else W.mix(value ^ np.uint64(0x6A09E667F3BCC909))
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        for i in full:
            ones = bits[at[i]:at[i + 1]].sum(axis=0, dtype=np.int32)
            out[i, half] = np.packbits(2 * ones > at[i + 1] - at[i]).view(">u8")[0]
    for i in np.flatnonzero((count > 0) & (count < TERM)):
        v = np.uint64(int(count[i]))
        for x in w.hash[w.first[i]:w.first[i + 1]]:
            v = W.mix(np.array([v ^ x], np.uint64))[0]
        out[i] = v, W.mix(np.array([v ^ np.uint64(0x6A09E667F3BCC909)], np.uint64))[0]
    return out


def _hex(fp: np.ndarray) -> list[str]:
    return [f"{int(a):016x}{int(b):016x}" for a, b in fp]


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / BITS_ALL


def _packed(texts: list[bytes]) -> W.Chunk:
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    blank = pa.RecordBatch.from_arrays([pa.nulls(len(texts))], names=["x"])
    return W.Chunk(blank, np.frombuffer(b"".join(texts), np.uint8), off, np.ones(len(texts), bool))


def _head(text: bytes, points: int) -> bytes:
    """The first code points of UTF-8."""
    if points <= 0:
        return b""
    lead = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return text if points >= len(lead) else text[:lead[points]]


def _points(text: bytes) -> int:
    return int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, tail) in order; each row that isn't a tail is
    followed by its next document, be it a row or a tail."""
    carry = None  # text, doc_id, tail, fingerprint of the row before
    for c in W.chunks(batches):
        own = _votes(c)
        ids, tails = c.rows.column(0).to_pylist(), c.rows.column(2).to_pylist()
        texts = [c.text(i) for i in range(len(c))]
        if carry:
            texts, ids, tails = [carry[0], *texts], [carry[1], *ids], [carry[2], *tails]
            own = np.vstack([carry[3][None], own])
        carry = texts[-1], ids[-1], tails[-1], own[-1]
        rows = [i for i in range(len(texts) - 1) if not tails[i]]
        if not rows:
            continue
        size = [_points(texts[i]) for i in rows]
        edited = [_head(texts[i], n - n // 2) + _head(texts[i + 1], n // 2) for i, n in zip(rows, size, strict=True)]
        changed = _votes(_packed(edited))
        at = np.array(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in rows], pa.int64()), pa.array(size, pa.int64()),
             pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
             pa.array(_hex(own[at])), pa.array(_hex(changed)),
             pa.array(_likeness(own[at], changed)), pa.array(_likeness(own[at], own[at + 1])),
             pa.array(W.signed(own[at, 0].copy())), pa.array(W.signed(own[at, 1].copy()))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "hi", "lo"])


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, tail), in partitions sorted so that each row's next
    document (ascending doc_id, after the last the first) comes after it.

    Quantiles of doc_id cut the order into ranges of about ROWS_PER_RANGE rows;
    the first row of each range is sent to the range before as well, as its
    tail. The driver sees only the quantiles and the first ids of the ranges."""
    last = F.lit((1 << 63) - 1)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("at", F.struct(F.coalesce("doc_id", last).alias("id"), F.xxhash64("text").alias("tie")))
    total = docs.count()
    n = max(1, min(MAX_RANGES, total // ROWS_PER_RANGE))
    cuts = (docs.agg(F.percentile_approx("at.id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []) if n > 1 else []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "left"))

    heads = docs.select(range_of("at.id").alias("range"), "at").groupBy("range").agg(F.min("at").alias("at")).sort("range").collect()
    spark = docs.sparkSession
    before = [(heads[k - 1]["range"], r["at"]["id"], r["at"]["tie"]) for k, r in enumerate(heads)]
    first = spark.createDataFrame(before, "before int, first_id bigint, first_tie bigint")  # at most MAX_RANGES rows
    rows = (docs.join(F.broadcast(first), (F.col("at.id") == F.col("first_id")) & (F.col("at.tie") == F.col("first_tie")), "left")
            .withColumn("range", range_of("at.id"))
            .select("doc_id", "text", "at", F.explode(F.expr(
                "CASE WHEN before IS NULL THEN array(named_struct('range', range, 'tail', false)) "
                "ELSE array(named_struct('range', range, 'tail', false), named_struct('range', before, 'tail', true)) END")).alias("to")))
    return (rows.repartition("to.range").sortWithinPartitions("to.range", "to.tail", "at")
            .select("doc_id", "text", F.col("to.tail").alias("tail")))


def shares(radius: int) -> list[int]:
    """Bits by which a pair within the radius may differ in each table's leading block;
    it cannot differ by more in every table, as the bits beyond would add up to more."""
    each, more = divmod(radius + 1, BLOCKS)
    return [each if k < more else each - 1 for k in range(BLOCKS)]


def _flips(bits: int, most: int) -> list[int]:
    """Values of ``bits`` bits with at most ``most`` ones."""
    ones = [sum(1 << k for k in at) for n in range(min(bits, most) + 1) for at in combinations(range(bits), n)]
    return sorted(ones)


def _block(hi, lo, k: int) -> np.ndarray:
    """Block k of fingerprints, from the first bits on."""
    half, place = (hi, k) if k < BLOCKS // 2 else (lo, k - BLOCKS // 2)
    return (half >> np.uint64(64 - BLOCK_BITS * (place + 1)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


def _halves(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(t.column(n).to_numpy().astype(np.int64).view(np.uint64) for n in ("hi", "lo"))


def _looked_up(bits: int, radius: int):
    """Within one cell, the part of a table whose leading block begins with the same
    ``bits`` bits: rows of its fingerprints within the radius of each query."""
    share, rest = shares(radius), BLOCK_BITS - bits

    def cell(key: tuple, asked: pa.Table, prints: pa.Table) -> pa.Table:
        table, part = key[0].as_py(), key[1].as_py()
        (hi, lo), (other_hi, other_lo) = _halves(asked), _halves(prints)
        n = prints.column("n").to_numpy().astype(np.int64)
        lead = _block(other_hi, other_lo, table) & ((1 << rest) - 1)
        order = np.argsort(lead, kind="stable")
        other_hi, other_lo, n = other_hi[order], other_lo[order], n[order]
        begin = np.searchsorted(lead[order], np.arange((1 << rest) + 1))
        own = _block(hi, lo, table)
        spent = np.bitwise_count((own >> rest ^ part).astype(np.uint64))
        sums = np.zeros(len(hi), np.int64)
        for used in np.unique(spent):
            flips = np.array(_flips(rest, share[table] - int(used)), np.int64)
            queries = np.flatnonzero(spent == used)
            size = max(1, _PAIRS // len(flips))
            for i in range(0, len(queries), size):
                q = queries[i:i + size]
                values = (own[q, None] & ((1 << rest) - 1)) ^ flips
                first, many = begin[values], begin[values + 1] - begin[values]
                first, many, who = first.ravel(), many.ravel(), np.repeat(q, len(flips))
                ends = np.cumsum(many)
                at = 0
                while at < len(many):  # about _PAIRS candidates at once
                    before = int(ends[at - 1]) if at else 0
                    to = max(at + 1, int(np.searchsorted(ends, before + _PAIRS, "right")))
                    m = many[at:to]
                    other = np.arange(int(m.sum())) + np.repeat(first[at:to] - (ends[at:to] - m - before), m)
                    owner = np.repeat(who[at:to], m)
                    x = hi[owner] ^ other_hi[other]
                    near = np.flatnonzero(np.bitwise_count(x) <= radius)
                    owner, other, x = owner[near], other[near], x[near]
                    y = lo[owner] ^ other_lo[other]
                    good = np.bitwise_count(x) + np.bitwise_count(y) <= radius
                    for k in range(table):  # found by an earlier table
                        good &= np.bitwise_count(_block(x, y, k).astype(np.uint64)) > share[k]
                    np.add.at(sums, owner[good], n[other[good]])
                    at = to
        some = sums > 0
        return pa.table({"hi": W.signed(hi[some]), "lo": W.signed(lo[some]), "n": sums[some]})
    return cell


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each distinct query fingerprint (hi, lo) the number of rows of
    ``prints`` (hi, lo, n: distinct fingerprints and their rows) that differ from
    it in at most ``radius`` bits, if any: hi, lo, n."""
    q = queries.select("hi", "lo").distinct()
    bits = min(BLOCK_BITS, max(LEAST_BITS, (prints.count() // CELL_PRINTS).bit_length()))

    def lead(k: int) -> Column:
        half, place = ("hi", k) if k < BLOCKS // 2 else ("lo", k - BLOCKS // 2)
        return F.shiftrightunsigned(half, 64 - BLOCK_BITS * (place + 1)).bitwiseAND((1 << bits) - 1 << BLOCK_BITS - bits)

    def places(k: int, flips: list[int]) -> Column:
        """The table and the first bits of its leading block, as they are and with these bits flipped."""
        own = F.shiftright(lead(k), BLOCK_BITS - bits).cast("int")
        return F.transform(F.array(*[F.lit(x) for x in flips]), lambda x: F.struct(F.lit(k).alias("table"), own.bitwiseXOR(x).alias("part")))

    def parts(near: list[list[int]]) -> Column:
        return F.explode(F.concat(*[places(k, flips) for k, flips in enumerate(near)]))

    asked = q.withColumn("at", parts([_flips(bits, s) for s in shares(radius)])).select("hi", "lo", "at.*")
    held = prints.select("hi", "lo", "n").withColumn("at", parts([[0]] * BLOCKS)).select("hi", "lo", "n", "at.*")
    # One row a cell, at most BLOCKS * 2^16: how many pieces its fingerprints (down) and queries (across) are cut into.
    sizes = (held.groupBy("table", "part").agg(F.ceil(F.count("*") / CELL_PRINTS).alias("down"))
             .join(asked.groupBy("table", "part").agg(F.ceil(F.count("*") / CELL_QUERIES).alias("across")), ["table", "part"]))

    def piece(of: str) -> Column:
        return F.pmod(F.xxhash64("hi", "lo"), F.col(of))

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(of) - 1))

    cell = ["table", "part", "x", "y"]
    asked = asked.join(F.broadcast(sizes), ["table", "part"]).withColumn("x", piece("across")).withColumn("y", every("down"))
    held = held.join(F.broadcast(sizes), ["table", "part"]).withColumn("y", piece("down")).withColumn("x", every("across"))
    asked = asked.select(*[F.col(c).alias(c) for c in ("hi", "lo", *cell)])  # both sides come from the same rows: names of their own
    held = held.select(*[F.col(c).alias(c) for c in ("hi", "lo", "n", *cell)])
    return (asked.groupBy(*cell).cogroup(held.groupBy(*cell))
            .applyInArrow(_looked_up(bits, radius), "hi bigint, lo bigint, n bigint")
            .groupBy("hi", "lo").agg(F.sum("n").alias("n")))


def fingerprints(docs: DataFrame, query_step: int = 50) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    n_within: for rows whose doc_id is divisible by ``query_step`` the number of
    other rows with a fingerprint within RADIUS bits, else null."""
    rows = stored(with_next(docs).mapInArrow(
        _pairs, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double, hi bigint, lo bigint"), "fingerprints")
    asks = rows.where(F.col("doc_id") % query_step == 0)
    prints = rows.groupBy("hi", "lo").agg(F.count("*").alias("n"))
    near = within(asks, prints).select("hi", "lo", (F.col("n") - 1).alias("n_within"))
    asked = asks.select("doc_id", "hi", "lo").distinct().join(near, ["hi", "lo"]).select("doc_id", "hi", "lo", "n_within")
    return rows.join(asked, ["doc_id", "hi", "lo"], "left").drop("hi", "lo")
