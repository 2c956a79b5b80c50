"""Document quality by a linear-chain conditional random field over lines.

Every line gets features of its own characters and words (shares of capitals,
digits, symbols and marks, repeated words, word length, length, repeated line)
and those of the lines before and after. The chain's two states are bad and
good; weights of the features, the transitions and the start maximise the
likelihood of training documents, whose lines carry the document's label. A
document's score is the forward-backward marginal of *good*, averaged over its
lines by their length.

Training reads a sample of at most about ``TRAIN_DOCS`` labelled documents
outside the held-out fold (by the hash of doc_id, at a rate known from an exact
count); their line features (some dozens of numbers a line) are fitted on the
driver. Scoring reads every whole text and nothing but the text.

Defined cases: null and empty texts are one empty line; without any labelled
document the score is 0.5; labels that are null or neither 0 nor 1 are not used;
repeated rows give repeated result rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetreports.llm import words as W

TRAIN_DOCS, FOLDS, HELD_FOLD, THRESHOLD = 6000, 4, 2, 0.7
ROUNDS, RATE, DECAY = 250, 0.05, 1e-3

# Kinds of bytes: capital, small or beyond ASCII, digit, space, mark, symbol.
_KIND = np.full(256, 5, np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 0, 1, 1, 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[[ord(x) for x in ".,;:!?'\"()-"]] = 4
OWN = 13


def _lines(c: W.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of all lines of a chunk, their lengths, and each text's
    range of lines. A text of n line feeds has n + 1 lines."""
    n, data, off = len(c), c.data, c.off
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate((off[:-1], feeds + 1)), kind="stable")
    doc_feeds = np.searchsorted(feeds, off)
    first = doc_feeds + np.arange(n + 1)
    # lines in order of their start; an empty text's line comes before the next text's
    end = np.empty(len(start), np.int64)
    is_last = np.zeros(len(start), bool)
    is_last[first[1:] - 1] = True
    end[~is_last] = feeds
    end[is_last] = off[1:]
    size = end - start
    x = np.zeros((len(start), OWN), np.float32)
    length = np.maximum(size, 1)
    padded = np.concatenate((data, [np.uint8(32)]))
    kind = _KIND[padded]
    for k in (0, 2, 4, 5):
        total = np.concatenate(([0], np.cumsum(kind == k)))
        x[:, {0: 0, 2: 1, 4: 2, 5: 3}[k]] = (total[end] - total[start]) / length
    for k, mark in ((4, 33), (5, 124)):
        total = np.concatenate(([0], np.cumsum(padded == mark)))
        x[:, k] = (total[end] - total[start]) / length
    w = W.words(c)
    line = np.searchsorted(start, w.start, "right") - 1
    count = np.bincount(line, minlength=len(start))[:len(start)]
    again = np.zeros(len(w.hash), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (line[1:] == line[:-1])
    some = np.maximum(count, 1)
    x[:, 6] = np.bincount(line, weights=again, minlength=len(start))[:len(start)] / some
    x[:, 7] = size / some / 10
    x[:, 8] = np.log1p(size) / 5
    x[:, 9] = np.log1p(count) / 5
    x[:, 10] = (size > 0) & np.isin(padded[np.maximum(end - 1, 0)], [46, 33, 63])
    rank = np.argsort(W.mix(w.hash ^ line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    both = W.mix(w.hash ^ line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[rank]
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    x[:, 11] = 1 - np.bincount(line[rank], weights=new, minlength=len(start))[:len(start)] / some
    x[:, 12] = size == 0
    return x, size, first


def _with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.hstack([x, before, after, np.ones((len(x), 1), np.float32)]).astype(np.float64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in W.chunks(batches):
        x, size, first = _lines(c)
        lines = pa.ListArray.from_arrays(pa.array((first * OWN).astype(np.int32)), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([c.rows.column(1), lines], names=["quality", "lines"])


def _chains(first: np.ndarray) -> Iterator[np.ndarray]:
    """Lines of all chains by place: the first ones, the second ones, ..."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    by_size = size[order]
    for t in range(int(by_size[0]) if len(by_size) else 0):
        yield first[:-1][order[:np.searchsorted(-by_size, -t, "left")]] + t


def _marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward: log P(state) of all lines, expected transitions, log Z.
    e: score of *good* against *bad* of every line."""
    n = len(e)
    steps = list(_chains(first))
    emit = np.stack([np.zeros(n), e], axis=1)
    fwd, bwd, log_z = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros(n)
    for t, at in enumerate(steps):
        if t == 0:
            fwd[at] = start + emit[at]
        else:
            p = fwd[at - 1]
            fwd[at, 0] = np.logaddexp(p[:, 0] + trans[0, 0], p[:, 1] + trans[1, 0])
            fwd[at, 1] = np.logaddexp(p[:, 0] + trans[0, 1], p[:, 1] + trans[1, 1]) + e[at]
    last = first[1:] - 1
    for at in steps[:0:-1]:
        q = bwd[at] + emit[at]
        bwd[at - 1, 0] = np.logaddexp(q[:, 0] + trans[0, 0], q[:, 1] + trans[0, 1])
        bwd[at - 1, 1] = np.logaddexp(q[:, 0] + trans[1, 0], q[:, 1] + trans[1, 1])
    z = np.logaddexp(fwd[last, 0], fwd[last, 1])
    log_z = np.repeat(z, np.diff(first))
    inner = np.setdiff1d(np.arange(n), first[:-1], assume_unique=True)
    pairs = np.zeros((2, 2))
    for a in range(2):
        for b in range(2):
            pairs[a, b] = np.exp(fwd[inner - 1, a] + trans[a, b] + emit[inner, b] + bwd[inner, b] - log_z[inner]).sum()
    return fwd + bwd - log_z[:, None], pairs, z


def _fit(x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Weights by gradient steps (Adam) on the mean log-likelihood."""
    mean, scale = x[:, :-1].mean(axis=0), x[:, :-1].std(axis=0) + 1e-6
    x = np.hstack([(x[:, :-1] - mean) / scale, x[:, -1:]])
    docs = len(label)
    y = np.repeat(label, np.diff(first))
    inner = np.repeat(label, np.diff(first) - 1)
    seen_pairs = np.array([[(inner == 0).sum(), 0], [0, (inner == 1).sum()]], float)
    seen_start = np.array([(label == 0).sum(), (label == 1).sum()], float)
    p = np.zeros(x.shape[1] + 6)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, ROUNDS + 1):
        w, trans, start = p[:-6], p[-6:-2].reshape(2, 2), p[-2:]
        logs, pairs, _ = _marginals(x @ w, first, trans, start)
        good = np.exp(logs[:, 1])
        begin = np.exp(logs[first[:-1]]).sum(axis=0)
        g = np.concatenate([x.T @ (y - good), (seen_pairs - pairs).ravel(), seen_start - begin]) / docs - DECAY * p
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return {"mean": mean, "scale": scale, "w": p[:-6], "trans": p[-6:-2].reshape(2, 2), "start": p[-2:]}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_FOLD, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray] | None:
    """The chain's weights from ``labels`` (doc_id, quality) outside the held-out
    fold and the texts of ``docs`` (doc_id, text)."""
    rows = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
            .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))))
    n = rows.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64(F.lit("train"), F.col("doc_id")), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(draw < TRAIN_DOCS / n).dropDuplicates(["doc_id"])  # about TRAIN_DOCS rows: bounded
    got = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "quality")
           .mapInArrow(_features, "quality int, lines array<float>").collect())
    if not got:
        return None
    got.sort(key=lambda r: (r["quality"], len(r["lines"]), r["lines"][:2 * OWN]))  # the same sums whatever the order of tasks
    sizes = np.array([len(r["lines"]) // OWN for r in got])
    first = np.concatenate(([0], np.cumsum(sizes)))
    own = np.concatenate([np.array(r["lines"], np.float32) for r in got]).reshape(-1, OWN)
    return _fit(_with_neighbours(own, first), first, np.array([r["quality"] for r in got]))


def _scored(model: dict[str, np.ndarray] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in W.chunks(batches):
            x, size, first = _lines(c)
            score = np.full(len(c), 0.5)
            if model is not None:
                x = _with_neighbours(x, first)
                x[:, :-1] = (x[:, :-1] - model["mean"]) / model["scale"]
                logs, _, _ = _marginals(x @ model["w"], first, model["trans"], model["start"])
                weight = np.maximum(size, 1)
                total = np.add.reduceat(weight, first[:-1])
                score = np.clip(np.add.reduceat(weight * np.exp(logs[:, 1]), first[:-1]) / total, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [c.rows.column(0), c.rows.column(1), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = learn(docs, labels)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(_scored(model), "doc_id bigint, held_out boolean, score double, predicted int"))
