"""Language ID by hyperdimensional letter profiles.

Every letter (lower-cased; anything else is a gap) has a random vector of
``DIM`` = 1024 signs, drawn from its code point. A letter with its two neighbours
binds to an n-gram vector: the first vector rotated by two places times the
second rotated by one times the third. A text's profile is the bundle (sum) of
its n-gram vectors, a language's prototype the bundle of the unit profiles of
its training texts, and a text belongs to the language with the largest cosine.

Training reads every text that has a lang and is not held out; prototypes are
summed as integers in tasks, so the result does not depend on the order of tasks
and the driver gets one vector a language. Prediction reads every whole text and
nothing but the text.

*Rejection* is by the share of n-grams that no training text holds, as a cosine near
the noise says little. The n-grams of all training texts are a bitmap of their hashes
with 16 bits or more for each, up to 2^30 in all (64 million n-grams; beyond that more
unseen ones count as seen). Of a text's m n-grams, up to (``UNSEEN`` = 0.25 plus the
share that 95 % of the language's held-out texts, all of them, don't exceed) times m,
plus ``SLACK`` = 2, may be unseen: one odd letter makes three.

Defined cases: null text, or one without a letter, is ``und`` with score 0, as is
every text where no language could be learned; ties go to the first language in
alphabetical order; rows without doc_id are not held out; repeated rows give
repeated result rows. Only ``doc_id``, ``text`` and, in training, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetreports.llm import words as W
from fleetreports.llm.bitmaps import BITS, hash_filter, low_spots, passes
from fleetreports.llm.tables import dropped, stored

DIM, FOLDS, UNKNOWN = 1024, 5, "und"
UNSEEN, SLACK = 0.25, 2
_RECENT, _BINS = 20, 4096  # bits of a task's table of n-grams; bins of shares
_UNIT = 1 << 20  # a unit profile's coordinates are summed in these steps
_CELLS, _BLOCK = 1_000_000, 4096  # counters, and n-gram vectors, at once
_SLICE = 512  # n-gram vectors that are made at once
_letters: dict[str, np.ndarray] = {}


def _folded() -> np.ndarray:
    """Code point -> its lower-case letter, or 0 for what isn't a letter."""
    if "fold" not in _letters:
        fold = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if i < 0x30000 and c.isalpha():
                low = c.lower()
                fold[i] = ord(low[0]) if len(low) == 1 else i
        _letters["fold"] = fold
    return _letters["fold"]


def _signs(letters: np.ndarray) -> np.ndarray:
    """Random signs of letters, as bits: (letters, DIM)."""
    words = np.arange(DIM // 64, dtype=np.uint64)
    seed = letters.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + words * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.unpackbits(W.mix(W.mix(seed) + np.uint64(1)).view(np.uint8).reshape(len(letters), -1), axis=1)


@dataclass
class _Grams:
    """N-grams of a chunk: of each letter in order, as numbers of distinct ones."""

    at: np.ndarray
    first: np.ndarray  # n + 1: n-grams of row i are at[first[i]:first[i + 1]]
    letters: np.ndarray
    three: tuple[np.ndarray, np.ndarray, np.ndarray]  # of distinct n-grams: places in letters

    def hashes(self) -> np.ndarray:
        x, y, z = (self.letters[k].astype(np.uint64) for k in self.three)
        return W.mix(x << np.uint64(42) | y << np.uint64(21) | z)

    def vectors(self, some: np.ndarray | slice) -> np.ndarray:
        """Vectors of some distinct n-grams, at most ``_BLOCK``, written slice by slice
        into the one array."""
        places = [k[some] for k in self.three]
        table = _signs(self.letters) if len(self.letters) <= _SLICE else None
        out = np.empty((len(places[0]), DIM), np.float32)
        for i in range(0, len(out), _SLICE):
            x, y, z = (_signs(self.letters[k[i:i + _SLICE]]) if table is None else table[k[i:i + _SLICE]] for k in places)
            bits = np.roll(x, 2, axis=1) ^ np.roll(y, 1, axis=1) ^ z
            np.subtract(1, bits << 1, out=out[i:i + _SLICE], dtype=np.float32)
        return out


def _profiles(c: W.Chunk) -> Iterator[tuple[int, int, np.ndarray]]:
    """Profiles of a chunk's texts: first row, row after the last, bundles."""
    for i, j, bundles, _, _ in _bundled(c):
        yield i, j, bundles


def _bundled(c: W.Chunk, seen: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, row after the last, bundles, and of each row the n-grams and how
    many of them are not in ``seen``. At most ``_BLOCK`` n-gram vectors exist at once,
    however many different n-grams there are."""
    g, n = _distinct(c), len(c)
    if g is None:
        yield 0, n, np.zeros((n, DIM), np.float32), np.zeros(n), np.zeros(n)
        return
    total = len(g.three[0])
    new = np.zeros(total) if seen is None else _new(g, seen)
    whole = g.vectors(slice(None)) if total <= _BLOCK else None
    step = max(1, _CELLS // min(total, _BLOCK))
    for i in range(0, n, step):
        j = min(n, i + step)
        at = g.at[g.first[i]:g.first[j]]
        size = np.diff(g.first[i:j + 1])
        row = np.repeat(np.arange(j - i), size)
        unseen = np.bincount(row, weights=new[at], minlength=j - i)
        if whole is not None:
            yield i, j, _counts(row, at, j - i, total) @ whole, size, unseen
            continue
        order = np.argsort(at, kind="stable")
        at, row = at[order], row[order]
        start = np.flatnonzero(np.concatenate((np.ones(min(1, len(at)), bool), at[1:] != at[:-1])))  # of the rows' distinct n-grams
        place = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(at))))
        bundles = np.zeros((j - i, DIM), np.float32)
        for k in range(0, len(start), _BLOCK):
            own = start[k:k + _BLOCK]
            to = start[k + _BLOCK] if k + _BLOCK < len(start) else len(at)
            bundles += _counts(row[own[0]:to], place[own[0]:to] - k, j - i, len(own)) @ g.vectors(at[own])
        yield i, j, bundles, size, unseen


def _new(g: _Grams, seen: np.ndarray) -> np.ndarray:
    """1 for each distinct n-gram that is not in ``seen``, else 0."""
    return (~passes(seen, low_spots(g.hashes(), len(seen).bit_length() + 2))).astype(np.float64)


def _counts(row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return np.bincount(row * columns + column, minlength=rows * columns).astype(np.float32).reshape(rows, columns)


def _distinct(c: W.Chunk) -> _Grams | None:
    """The n-grams of a chunk's texts, None where there is no letter."""
    n, data = len(c), c.data
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    off = lead[c.off]  # in code points
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    line = np.zeros(len(points) + n + 1, np.uint32)  # a gap before, between and after the texts
    doc = np.repeat(np.arange(n), np.diff(off))
    line[np.arange(len(points)) + doc + 1] = _folded()[np.minimum(points, 0x10FFFF)]
    at = np.flatnonzero(line)
    if not len(at):
        return None
    letters, code = np.unique(line, return_inverse=True) if len(line) < 4096 else (None, None)
    if letters is None:
        seen = np.zeros(0x110000, bool)
        seen[line] = True
        letters = np.flatnonzero(seen)
        rank = np.zeros(0x110000, np.int64)
        rank[letters] = np.arange(len(letters))
        code = rank[line]
    k = len(letters)
    gram = (code[at - 1] * k + code[at]) * k + code[at + 1]
    owner = doc[at - 1 - np.searchsorted(off[1:] + np.arange(1, n + 1), at - 1, "right")] if n > 1 else np.zeros(len(at), np.int64)
    if k <= 128:
        seen = np.zeros(k ** 3, bool)
        seen[gram] = True
        grams = np.flatnonzero(seen)
        rank = np.zeros(k ** 3, np.int32)
        rank[grams] = np.arange(len(grams))
        gram = rank[gram]
    else:
        grams, gram = np.unique(gram, return_inverse=True)
    return _Grams(gram, np.searchsorted(owner, np.arange(n + 1)), letters, (grams // (k * k), grams // k % k, grams % k))


def _unit(profiles: np.ndarray) -> np.ndarray:
    size = np.sqrt((profiles.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return np.divide(profiles, size, out=np.zeros(profiles.shape), where=size > 0)


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for c in W.chunks(batches, size=W.PIECE):
        lang = np.array(c.rows.column(1).to_pylist(), object)
        for i, j, p in _profiles(c):
            steps = np.rint(_unit(p) * _UNIT).astype(np.int64)
            for name in set(lang[i:j]):
                sums[name] = sums.get(name, 0) + steps[lang[i:j] == name].sum(axis=0)
    for name, total in sums.items():
        yield pa.RecordBatch.from_pydict({"lang": [name] * DIM, "place": pa.array(range(DIM), pa.int32()), "total": pa.array(total)})


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _labelled(docs: DataFrame, of: Column) -> DataFrame:
    """Texts (text, lang) of the rows that ``of`` holds for and that have a lang."""
    return docs.where(of & F.col("lang").isNotNull()).select("text", "lang")


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes, from the rows of ``docs`` (doc_id,
    text, lang) that are not held out and have a lang."""
    sums = (_labelled(docs, ~held_out(F.col("doc_id"))).mapInArrow(_bundles, "lang string, place int, total bigint")
            .groupBy("lang", "place").agg(F.sum("total").alias("total")).collect())  # DIM rows a language
    names = sorted({r["lang"] for r in sums})
    out = np.zeros((len(names), DIM))
    for r in sums:
        out[names.index(r["lang"]), r["place"]] = r["total"]
    return names, _unit(out)


def _predicted(names: list[str], prototypes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = np.array([*names, UNKNOWN], object)
        for c in W.chunks(batches, size=W.PIECE):
            best = np.full(len(c), len(names))
            score = np.zeros(len(c))
            for i, j, p in _profiles(c):
                if not names:
                    continue
                cosine = _unit(p) @ prototypes.T
                some = (p != 0).any(axis=1)
                best[i:j] = np.where(some, cosine.argmax(axis=1), len(names))
                score[i:j] = np.where(some, np.clip(cosine.max(axis=1), 0, 1), 0)
            keep = list(range(c.rows.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*[c.rows.column(k) for k in keep], pa.array(labels[best].tolist(), pa.string()), pa.array(score)],
                names=[*[c.rows.schema.names[k] for k in keep], "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score. ``model``:
    what ``learn`` gave; without it, learned from ``docs``."""
    names, prototypes = learn(docs) if model is None else model
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(_predicted(names, prototypes), "doc_id bigint, held_out boolean, lang_pred string, score double"))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the n-grams of texts, most of them once a task: those that a table of
    fixed size remembers are left out."""
    recent = np.zeros(1 << _RECENT, np.uint64)
    for c in W.chunks(batches, size=W.PIECE):
        g = _distinct(c)
        if g is not None:
            h = g.hashes()
            spot = low_spots(h, _RECENT)
            h, spot = (x[recent[spot] != h] for x in (h, spot))
            recent[spot] = h
            yield pa.RecordBatch.from_pydict({"h": pa.array(W.signed(h), pa.int64())})


def _seen(trained: DataFrame) -> np.ndarray:
    """Bitmap of the n-grams of all training texts, sized by their exact number."""
    grams = stored(trained.mapInArrow(_grams, "h bigint").distinct(), "language-grams")
    bits = max(BITS, min(30, (16 * grams.count()).bit_length()))
    out = hash_filter(grams, F.col("h"), bits)
    dropped(grams)
    return out


def _shares(seen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in W.chunks(batches, size=W.PIECE):
            g = _distinct(c)
            if g is None:
                continue
            total = np.diff(g.first)
            some = total > 0
            unseen = np.bincount(np.repeat(np.arange(len(c)), total), weights=_new(g, seen.value)[g.at], minlength=len(c))
            yield pa.RecordBatch.from_pydict({"lang": c.rows.column(1).filter(pa.array(some)), "share": pa.array(unseen[some] / total[some])})
    return run


def _quantile(shares: DataFrame, q: float) -> DataFrame:
    """lang, share: the exact quantile (as ``percentile`` gives it) of the shares (0 to 1)
    of each lang. Equal shares are counted first; the counts of ``_BINS`` bins a lang tell
    the bins that hold the two ranks around the quantile, and only these are put in order."""
    counts = stored(shares.groupBy("lang", "share").agg(F.count("*").alias("n"))
                    .withColumn("bin", F.floor(F.col("share") * _BINS)), "language-shares")
    of = Window.partitionBy("lang")
    bins = (counts.groupBy("lang", "bin").agg(F.sum("n").alias("m"))
            .select("lang", "bin", "m", (F.sum("m").over(of.orderBy("bin")) - F.col("m")).alias("before"),
                    ((F.sum("m").over(of) - 1) * F.lit(q)).alias("at"))
            .where("floor(at) < before + m and ceil(at) >= before"))
    ranked = (counts.join(bins, ["lang", "bin"])
              .withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("lang", "bin").orderBy("share"))))
    holds = lambda rank: F.min(F.when(F.expr(f"upto > {rank}(at)"), F.col("share")))
    ends = ranked.groupBy("lang").agg(F.first("at").alias("at"), holds("floor").alias("low"), holds("ceil").alias("high"))
    out = ends.select("lang", F.expr("CASE WHEN low = high THEN low ELSE (ceil(at) - at) * low + (at - floor(at)) * high END").alias("share"))
    out.counts = counts  # read by the result: to be dropped after it
    return out


def in_known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language: not ``und``, and
    without too many n-grams that no training text holds. All columns stay; so do
    all rows where no language can be learned, or no text of the language is held out."""
    names, prototypes = learn(docs)
    if not names:
        return docs
    seen = docs.sparkSession.sparkContext.broadcast(_seen(_labelled(docs, ~held_out(F.col("doc_id")))))
    most = np.ones(len(names))
    bounds = _quantile(_labelled(docs, held_out(F.col("doc_id"))).mapInArrow(_shares(seen), "lang string, share double"), 0.95)
    for r in bounds.collect():  # one row a language
        if r["lang"] in names:
            most[names.index(r["lang"])] = min(1.0, UNSEEN + r["share"])
    dropped(bounds.counts)
    return docs.where(F.col("text").isNotNull()).mapInArrow(_held(prototypes, seen, most), docs.schema)


def _held(prototypes: np.ndarray, seen, most: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in W.chunks(batches, size=W.PIECE):
            keep = np.zeros(len(c), bool)
            for i, j, p, total, unseen in _bundled(c, seen.value):
                bound = most[(_unit(p) @ prototypes.T).argmax(axis=1)]
                keep[i:j] = (total > 0) & (unseen <= bound * total + SLACK)
            yield c.rows.filter(pa.array(keep))
    return run
