"""Hard-negative mining with GNAT-style trees.

Vectors become integers (floor(256 * x) by component); a row's score is its
integer inner product with the anchor. Higher scores come first, ties by the
smaller vec_id. Anchors are the rows whose vec_id is divisible by 50. An anchor's
positives are its first 5 other rows of the same label; its hard negatives for
a positive are the first 3 rows of other labels whose score lies in the window
50 % to 95 % of the positive's score.

1. Tasks cut their rows into blocks and build one multiway tree a block, once; the
   blocks are a table in the shared folder. With one more coordinate,
   sqrt(M^2 - |x|^2), M the block's greatest norm, the distance of a query to a
   row is a function of the score: d^2 = |q|^2 + M^2 - 2 score. So a window of
   scores is an annulus around the query. A node picks up to WAYS split points
   that are far apart, and every row goes to the nearest one (the cells of the
   hyperplanes between them). Each split point stores the range of its distances to
   the rows of every sibling subtree.
2. The anchors are a stated query set; they are sent to the blocks in groups of
   QUERIES at most, in a loop. A query that is at distance d from a split point,
   with the annulus lo..hi, can meet only subtrees whose range to this split point
   intersects max(d - hi, lo - d) .. d + hi; others are eliminated. It goes to its
   nearest subtree first; as results are found, the annulus shrinks from
   outside (to the least score among the best so far). Leaves are exact: integer
   scores of all their rows.
3. Each block returns its first 5 (or 3) rows for a query; Spark ranks them over
   all blocks, a few rows for each query and block.

Work grows with anchors times what is left of the blocks after elimination; the
shuffle with anchors times blocks; nothing but QUERIES anchors and their positives
is on the driver at a time.

Defined cases: rows with a null label, a null vector or null or non-finite
components take no part; nor do rows with a null vec_id or with another length than
the vector of the smallest vec_id. Equal rows (vec_id, label, vector) count once. A
vec_id that comes again with another vector or label is a row, and an anchor, of its
own, but no positive or negative of its own vec_id. An anchor without a positive,
or a positive without a negative in its window, gives no row; empty tables give an
empty result. Norms beyond 2^23 after scaling are an error (scores would not be
exact). Only the three named columns are read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetreports.llm.tables import dropped, stored

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
QUERIES = 16_384  # anchors in one group; they are on the driver, and broadcast, together
BLOCK, LEAF, WAYS = 8192, 64, 16
_NORM = float(1 << 23)
_NONE = np.iinfo(np.int64).min


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and v (integer components, as doubles) of the rows that take
    part; every seventh vec_id's label is shifted."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id is not null and label is not null and embedding is not null "
                      "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    first = rows.agg(F.min_by(F.size("embedding"), F.struct("vec_id", "label", "embedding"))).first()[0]
    # (tasks round down: a bigint would not hold every finite component)
    down = F.transform("embedding", lambda x: F.lit(float(SCALE)) * x)
    return rows.where(F.size("embedding") == F.lit(first or 0)).select(
        "vec_id", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"), down.alias("v"))


# ------------------------------------------------------------------------- tree


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a and b."""
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _splits(x: np.ndarray, ways: int, rng: np.random.Generator) -> np.ndarray:
    """Rows of ``x`` that are far apart: the greedy choice among 3 * ways drawn."""
    drawn = rng.permutation(len(x))[:3 * ways]
    chosen = [int(drawn[0])]
    near = _far(x[drawn], x[chosen])[:, 0]
    apart = 1e-6 * (1 + np.sqrt(np.einsum("ij,ij->i", x, x).max()))  # more than distances are rounded
    while len(chosen) < ways and near.max() > apart:
        chosen.append(int(drawn[int(np.argmax(near))]))
        near = np.minimum(near, _far(x[drawn], x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def _build(x: np.ndarray) -> dict[str, np.ndarray]:
    """The tree as arrays. Node i: split rows ``split[i]`` (-1: none), children
    ``child[i]``, ranges ``least[i], most[i]`` (split point, subtree); a leaf has
    the rows ``order[begin[i]:end[i]]``."""
    rng = np.random.Generator(np.random.PCG64(12))
    split, child, least, most, begin, end, order = [], [], [], [], [], [], []

    def grow(rows: np.ndarray) -> int:
        me = len(split)
        for held, shape, fill in ((split, WAYS, -1), (child, WAYS, -1), (least, (WAYS, WAYS), np.inf), (most, (WAYS, WAYS), -np.inf)):
            held.append(np.full(shape, fill))
        begin.append(len(order))
        end.append(len(order))
        at = rows[_splits(x[rows], WAYS, rng)] if len(rows) > LEAF else rows[:1]
        if len(at) == 1:
            order.extend(rows.tolist())
            end[me] = len(order)
            return me
        d = _far(x[rows], x[at])
        owner = d.argmin(1)
        split[me][:len(at)] = at
        for j in range(len(at)):
            mine = owner == j
            least[me][:len(at), j], most[me][:len(at), j] = d[mine].min(0), d[mine].max(0)
            child[me][j] = grow(rows[mine])
        return me

    grow(np.arange(len(x)))
    return {"split": np.array(split), "child": np.array(child), "least": np.array(least), "most": np.array(most),
            "begin": np.array(begin), "end": np.array(end), "order": np.array(order, np.int64)}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(at, BLOCK)
            ids, labels = np.asarray(rows.column(0)), np.asarray(rows.column(1))
            v = np.floor(np.asarray(rows.column(2).flatten(), np.float64)).reshape(len(ids), -1) + 0.0
            _, first = np.unique(np.column_stack([ids, labels, v.view(np.int64)]), axis=0, return_index=True)
            ids, labels, v = ids[first], labels[first], v[first]  # equal rows once, by vec_id
            square = np.einsum("ij,ij->i", v, v)
            if len(square) and not square.max() <= _NORM * _NORM:
                raise ValueError("a vector's norm is beyond the range of exact scores (2^23 after scaling)")
            x = np.column_stack([v, np.sqrt(square.max() - square)])
            marks = [int.from_bytes(blake2b(v[i].tobytes(), digest_size=7, salt=int(labels[i]).to_bytes(16, "little", signed=True)).digest()) for i in range(len(v))]
            blob = io.BytesIO()
            np.savez(blob, ids=ids, labels=labels, marks=np.array(marks, np.int64), v=v, square=np.array(square.max()), **_build(x))
            yield pa.RecordBatch.from_arrays([pa.array([blob.getvalue()], pa.binary())], names=["tree"])


# ----------------------------------------------------------------------- search


class _Search:
    """First ``k`` rows of a block for many queries at once. A query is an anchor
    (row of ``q``) with a window of scores ``least..most``."""

    def __init__(self, held: dict[str, np.ndarray], q: np.ndarray, q_ids, q_labels, least, most, k: int, same: bool):
        self.h, self.q, self.q_ids, self.q_labels, self.same, self.k = held, q, q_ids, q_labels, same, k
        self.least, self.most = least.astype(np.float64), most.astype(np.float64)
        self.sum = np.einsum("ij,ij->i", q, q) + float(held["square"])
        self.slack = 1e-6 * (1 + np.sqrt(np.maximum(self.sum, 0)))  # rounding of distances
        self.found = np.full((len(q), k), _NONE)  # score and place in one number, best first
        self.n = len(held["ids"])
        self.near = np.sqrt(np.maximum(self.sum - 2 * np.minimum(self.most, self.sum), 0))

    def far(self, rows: np.ndarray) -> np.ndarray:
        """Outer radius: the least score that can still be among the first k."""
        worst = self.found[rows, -1]
        least = np.where(worst == _NONE, self.least[rows], np.maximum(self.least[rows], -(-worst // self.n)))
        return np.sqrt(np.maximum(self.sum[rows] - 2 * np.maximum(least, -1e18), 0))

    def visit(self, node: int, rows: np.ndarray) -> None:
        h = self.h
        ways = int((h["child"][node] >= 0).sum())
        if not ways:
            return self.leaf(h["order"][h["begin"][node]:h["end"][node]], rows)
        pivots = h["split"][node][:ways].astype(np.int64)
        score = self.q[rows] @ h["v"][pivots].T
        d = np.sqrt(np.maximum(self.sum[rows][:, None] - 2 * score, 0))
        first = d.argmin(1)
        for j in range(ways):
            mine = first == j
            if mine.any():
                self.visit_if(node, j, ways, rows[mine], d[mine])
        for j in range(ways):
            mine = first != j
            if mine.any():
                self.visit_if(node, j, ways, rows[mine], d[mine])

    def visit_if(self, node: int, j: int, ways: int, rows: np.ndarray, d: np.ndarray) -> None:
        """Go on into subtree j with the queries whose annulus meets its ranges."""
        far, slack = self.far(rows)[:, None], self.slack[rows][:, None]
        inner = np.maximum(d - far, self.near[rows][:, None] - d) - slack
        meets = (self.h["most"][node][:ways, j] >= inner) & (self.h["least"][node][:ways, j] <= d + far + slack)
        rows = rows[meets.all(1)]
        if len(rows):
            self.visit(int(self.h["child"][node][j]), rows)

    def leaf(self, at: np.ndarray, rows: np.ndarray) -> None:
        ids, labels = self.h["ids"][at], self.h["labels"][at]
        for some in (rows[i:i + 4096] for i in range(0, len(rows), 4096)):
            for part in range(0, len(at), 4096):
                here = slice(part, part + 4096)
                score = self.q[some] @ self.h["v"][at[here]].T
                fits = ((labels[here][None] == self.q_labels[some][:, None]) == self.same) & (ids[here][None] != self.q_ids[some][:, None])
                fits &= (score >= self.least[some][:, None]) & (score <= self.most[some][:, None])
                # rows of a block are in the order of vec_id: the place breaks ties
                keys = np.where(fits, score.astype(np.int64) * self.n - at[here][None], _NONE)
                every = np.concatenate([self.found[some], keys], axis=1)
                kept = np.partition(every, every.shape[1] - self.k, axis=1)[:, -self.k:]
                self.found[some] = np.sort(kept, axis=1)[:, ::-1]

    def results(self) -> tuple[np.ndarray, ...]:
        """Query, vec_id, score and the row's mark of what was found."""
        self.visit(0, np.arange(len(self.q)))
        query, place = np.nonzero(self.found != _NONE)
        key = self.found[query, place]
        score = -(-key // self.n)
        place = score * self.n - key
        return query, self.h["ids"][place], score, self.h["marks"][place]


def _search(sent, k: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = sent.value
        for batch in batches:
            for blob in batch.column(0):
                with np.load(io.BytesIO(blob.as_py())) as z:
                    held = {name: z[name] for name in z.files}
                at = q["anchor"]
                found = _Search(held, q["v"][at], q["ids"][at], q["labels"][at], q["least"], q["most"], k, same).results()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query", "vec_id", "score", "mark"])
    return run


def _first(blocks: DataFrame, queries: dict[str, np.ndarray], k: int, same: bool) -> DataFrame:
    """query, vec_id, score, mark, rank: the first k rows over all blocks; a table."""
    sent = blocks.sparkSession.sparkContext.broadcast(queries)
    found = blocks.mapInArrow(_search(sent, k, same), "query bigint, vec_id bigint, score bigint, mark bigint").distinct()
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "mark")
    out = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ranked")
    sent.destroy()
    return out


def _group(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """The triplets of one group of anchors; a table."""
    spark = blocks.sparkSession
    got = anchors.toArrow()
    n = got.num_rows
    v = np.floor(np.asarray(got["v"].combine_chunks().flatten(), np.float64)).reshape(n, -1 if n else 0)
    base = {"v": v, "ids": got["vec_id"].to_numpy(), "labels": got["label"].to_numpy()}
    every = {"anchor": np.arange(n), "least": np.full(n, -np.inf), "most": np.full(n, np.inf)}
    positives = _first(blocks, base | every, POSITIVES, same=True)
    p = positives.orderBy("query", "rank").toPandas()  # POSITIVES rows an anchor
    score = p["score"].to_numpy(np.int64)
    windows = {"anchor": p["query"].to_numpy(np.int64), "least": -(-50 * score // 100), "most": 95 * score // 100}
    some = windows["least"] <= windows["most"]
    negatives = _first(blocks, base | {k: x[some] for k, x in windows.items()}, NEGATIVES, same=False)
    p = p[some].reset_index(drop=True)
    pairs = spark.createDataFrame(
        pa.table({"query": pa.array(np.arange(len(p))), "anchor_id": pa.array(base["ids"][windows["anchor"][some]].astype(np.int64)),
                  "positive_id": pa.array(p["vec_id"].to_numpy(np.int64)), "positive_score": pa.array(score[some])}))
    out = stored(pairs.join(negatives, "query").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "triplets")
    dropped(positives, negatives)
    return out


def mine(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    for ``vectors`` (vec_id, embedding, label). See the module for the method."""
    rows = usable(vectors)
    anchors = rows.where(f"vec_id % {EVERY} = 0").distinct()
    groups = max(1, -(-anchors.count() * 5 // (4 * QUERIES)))
    anchors = stored(anchors.withColumn("group", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups))), "anchors")
    blocks = stored(rows.mapInArrow(_blocks, "tree binary"), "trees")
    out = None
    for g in range(groups):
        one = _group(blocks, anchors.where(F.col("group") == g).drop("group"))
        out = one if out is None else out.unionByName(one)
    dropped(blocks, anchors)
    return out
