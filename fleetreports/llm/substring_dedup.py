"""Repeated windows of words across documents, with a count-min prefilter.

A window is ``WINDOW`` = 50 consecutive words (``[^\\x20\\x09-\\x0D]+``, unchanged)
of one document. A word goes if a window that covers it also starts in a
document with a smaller doc_id; windows are judged on the input.

1. *Sketch pass.* Every window has an anchor, the least hash of its 25-word runs;
   equal windows have equal anchors, and neighbouring windows share theirs, so
   a document has about one anchor for 13 words. Each task counts the anchors of
   one copy of every text in a count-min sketch (2 rows of counters that stop at 2)
   and hands on its non-zero blocks; Spark merges the blocks. The sketch grows with the
   bytes of unlike texts, ``PER_ANCHOR`` = 8 to 16 counters for each anchor
   to be expected, up to 2^``MOST_BITS`` counters a row (64 MB, reached at some 6 GB of
   unlike texts). The merged sketch never counts too few; a fuller one only lets more
   windows through.
2. *Exact pass.* Windows whose anchor is estimated to be repeated are grouped
   exactly by a 96-bit hash: the smallest doc_id of each group with several (pre-aggregated
   in every task), joined back to the occurrences; windows that occur very often are
   few and joined by broadcast, so none of them is one task's work. Documents with equal texts send
   the windows of one copy only; the others lose all they have.
3. Positions of removed windows meet their text again and the kept words are
   written out.

Defined cases: null text has no words; fewer than 50 words: nothing goes; a null
doc_id counts as larger than any other and never removes words elsewhere; rows
that share a doc_id do not remove words from one another; repeated rows give
repeated result rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetreports.llm import words as W
from fleetreports.llm.bitmaps import id_filter, passes, spot_of
from fleetreports.llm.tables import dropped, stored

WINDOW, ANCHOR = 50, 25
ROWS, BLOCK = 2, 1 << 19  # sketch rows, counters a block
LEAST_BITS, MOST_BITS = 20, 29  # log2 of counters a row
HOT_ROWS, HOT_SHARE = 10_000, 100_000
PER_ANCHOR, ANCHOR_BYTES = 8, 94  # counters an anchor; text bytes an anchor (13 words of natural text)
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def sketch_bits(size: int) -> int:
    """log2 of the counters of a sketch row for so many bytes of unlike texts."""
    return min(max((size * PER_ANCHOR // ANCHOR_BYTES).bit_length(), LEAST_BITS), MOST_BITS)


def _cells(values: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (W.mix(values ^ np.uint64(_SEEDS[row])) >> np.uint64(64 - bits)).astype(np.int64)


def _anchors(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window, and the word at which the window begins."""
    total = len(w.hash)
    if total < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begin = np.flatnonzero(w.doc[:total - WINDOW + 1] == w.doc[WINDOW - 1:])
    value, at = W.runs(w, ANCHOR)
    run = np.full(total, np.uint64((1 << 64) - 1))
    run[at] = value
    span, least = 1, run  # least of `span` runs from each word on, doubled
    while 2 * span <= WINDOW - ANCHOR + 1:
        least = np.minimum(least[:len(least) - span], least[span:])
        span *= 2
    rest = WINDOW - ANCHOR + 1 - span
    return np.minimum(least[begin], least[begin + rest]), begin


def _add(once: np.ndarray, twice: np.ndarray, more: np.ndarray, more_twice: np.ndarray) -> None:
    """Add bitmaps of counters that stop at 2, in place."""
    twice |= more_twice
    twice |= once & more
    once |= more


def _originals(batches: Iterator[pa.RecordBatch], firsts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows whose ``spot`` is among ``firsts``: the others are copies of another row's text."""
    for b in batches:
        mine = passes(firsts, np.asarray(b.column(b.schema.get_field_index("spot"))))
        yield b if mine.all() else b.filter(pa.array(mine))


def _sketch(firsts, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << bits) // 8
        once = np.zeros((ROWS, size), np.uint8)
        twice = np.zeros((ROWS, size), np.uint8)
        for c in W.chunks(_originals(batches, firsts.value)):
            w = W.words(c)
            value, begin = _anchors(w)
            if not len(value):
                continue
            doc = w.doc[begin]
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
            value = value[new]
            for row in range(ROWS):
                cell, count = np.unique(_cells(value, row, bits), return_counts=True)
                byte, bit = cell >> 3, (np.uint8(1) << (cell & 7).astype(np.uint8))
                had = (once[row][byte] & bit) > 0
                np.bitwise_or.at(once[row], byte, bit)
                again = had | (count > 1)
                np.bitwise_or.at(twice[row], byte[again], bit[again])
        step = BLOCK // 8
        for row in range(ROWS):
            for k in range(size // step):
                part = once[row, k * step:(k + 1) * step]
                if part.any():
                    packed = zlib.compress(part.tobytes() + twice[row, k * step:(k + 1) * step].tobytes(), 1)
                    yield pa.RecordBatch.from_pydict({"block": pa.array([row * (size // step) + k], pa.int64()), "counts": [packed]})
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order of their number, added one after the other."""
    step, now, once, twice = BLOCK // 8, None, None, None

    def done():
        return pa.RecordBatch.from_pydict({"block": pa.array([now], pa.int64()), "counts": [zlib.compress(twice.tobytes(), 1)]})

    for b in batches:
        for block, counts in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            part = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
            if block == now:
                _add(once, twice, part[:step], part[step:])
            else:
                if now is not None:
                    yield done()
                now, once, twice = block, part[:step].copy(), part[step:].copy()
    if now is not None:
        yield done()


def _repeated_cells(docs: DataFrame, firsts, bits: int) -> np.ndarray:
    """The merged sketch of ``docs`` (text, spot) as bitmaps of counters at 2, ROWS x 2^bits bits."""
    blocks = (docs.mapInArrow(_sketch(firsts, bits), "block bigint, counts binary")
              .repartition("block").sortWithinPartitions("block")
              .mapInArrow(_merged, "block bigint, counts binary").collect())
    out = np.zeros(ROWS * (1 << bits) // 8, np.uint8)
    step = BLOCK // 8
    for r in blocks:
        out[r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(zlib.decompress(bytes(r["counts"])), np.uint8)
    return out.reshape(ROWS, -1)


def _occurrences(sketch, firsts, bits: int):
    """Windows of the originals with an anchor that the sketch holds for repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in W.chunks(_originals(batches, firsts.value)):
            w = W.words(c)
            value, begin = _anchors(w)
            maybe = np.ones(len(value), bool)
            for row in range(ROWS):
                maybe &= passes(sketch.value[row], _cells(value, row, bits))
            if not maybe.any():
                continue
            full, _ = W.runs(w, WINDOW)
            check, _ = W.runs(w, WINDOW, seed=11)
            at, doc = begin[maybe], w.doc[begin[maybe]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(full[maybe])), pa.array((check[maybe] >> np.uint64(33)).astype(np.int32)),
                 c.rows.column(0).take(pa.array(doc)), c.rows.column(1).take(pa.array(doc)),
                 pa.array((at - w.first[doc]).astype(np.int32))], names=["h", "h2", "ord", "text_key", "pos"])
    return run


def _written(with_text: bool):
    """Each text without its removed words: counts, digest and, if asked for, the kept words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in W.chunks(batches):
            n_words, n_removed, sha, texts = [], [], [], []
            removed, whole = c.rows.column(2), c.rows.column(3).to_pylist()
            values, off = np.asarray(removed.values), np.asarray(removed.offsets)
            for i in range(len(c)):
                tokens = c.text(i).split()
                total, at = len(tokens), values[off[i]:off[i + 1]]
                if whole[i] and total >= WINDOW:
                    tokens = []
                elif len(at):
                    cover = np.zeros(total + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, np.minimum(at + WINDOW, total), -1)
                    gone = np.cumsum(cover[:total]) > 0
                    tokens = [t for t, g in zip(tokens, gone.tolist(), strict=True) if not g]
                kept = b" ".join(tokens)
                n_words.append(total)
                n_removed.append(total - len(tokens))
                sha.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [c.rows.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed,
    kept_sha256 and, ``with_text``, kept_text (kept words, one space between)."""
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("ord"),
        F.xxhash64("text").alias("text_key"))
    texts = docs.where("text is not null").select("ord", "text_key", F.crc32("text").alias("crc"), F.octet_length("text").alias("size"))
    same = ["text_key", "crc", "size"]
    firsts = stored(texts.groupBy(*same).agg(F.min("ord").alias("first"), F.max("ord").alias("last")), "firsts")
    key = F.struct("ord", "text_key")
    bitmap = spark.sparkContext.broadcast(id_filter(firsts.select(F.col("first").alias("ord"), "text_key"), key))
    bits = sketch_bits(firsts.agg(F.sum("size")).first()[0] or 0)
    spotted = docs.select("ord", "text_key", "text", spot_of(key).alias("spot"))
    sketch = spark.sparkContext.broadcast(_repeated_cells(spotted.select("text", "spot"), bitmap, bits))
    found = stored(spotted.mapInArrow(_occurrences(sketch, bitmap, bits), "h bigint, h2 int, ord bigint, text_key bigint, pos int"), "windows")
    least = stored(found.groupBy("h", "h2").agg(F.min("ord").alias("first"), F.max("ord").alias("last"), F.count(F.lit(1)).alias("n"))
                   .where("first < last").drop("last"), "repeated")  # in several documents
    # Windows with over HOT_ROWS occurrences, and a HOT_SHARE-th of all, are at most HOT_SHARE: broadcast.
    often = F.col("n") > max(HOT_ROWS, found.count() // HOT_SHARE)
    hot, rest = F.broadcast(least.where(often).drop("n")), least.where(~often).drop("n")
    again = found.join(hot, ["h", "h2"]).unionByName(found.join(hot, ["h", "h2"], "left_anti").join(rest, ["h", "h2"])).where("ord > first")
    removed = again.groupBy("ord", "text_key").agg(F.collect_list("pos").alias("removed")).withColumn("whole", F.lit(False))
    copies = (texts.join(firsts.where("first < last").select(*same, "first"), same).where("ord > first")
              .select("ord", "text_key", F.array().cast("array<int>").alias("removed"), F.lit(True).alias("whole")).distinct())
    known = (removed.unionByName(copies).groupBy("ord", "text_key")
             .agg(F.max_by("removed", F.size("removed")).alias("removed"), F.max("whole").alias("whole")))
    out = (docs.join(known, ["ord", "text_key"], "left")
           .select("doc_id", "text", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
                   F.coalesce("whole", F.lit(False)).alias("whole"))
           .mapInArrow(_written(with_text), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"))
    return out if with_text else out.drop("kept_text")
