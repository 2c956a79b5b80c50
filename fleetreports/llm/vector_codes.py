"""Vector code compression by product quantisation, with metric trees of anchors.

Every component x becomes the integer floor(1024 * x); vectors are cut into 4
equal parts, and each part position has a codebook of up to 256 entries. The
codebooks start as the parts of the rows with the smallest vec_ids and go
through 4 rounds: every part goes to the nearest entry (squared Euclidean
distance, ties to the lower index), and an entry becomes the componentwise
floor(sum / count) of its parts; unused entries stay. Then parts are assigned
again. All of it is exact integer arithmetic.

1. Tasks cut their rows into blocks of BLOCK rows and build, for every part of a
   block, an anchors-hierarchy tree, *middle out*: about sqrt(n) anchors are
   drawn, each the point farthest from the widest anchor so far, which takes the
   points that are nearer to it (points nearer to their anchor than half the
   way to the new one are not looked at). Anchors are merged in pairs, tightest
   ball first, into the upper tree, and are themselves split the same way into
   the lower one. Every ball caches the sum and the count of its points. The
   blocks are one table in the shared folder; it is built once.
2. Each round broadcasts the codebooks (256 entries a part, whatever the input)
   and walks the trees from the top: a ball inherits its parent's candidate
   entries and drops those that are farther than the nearest one by more than
   its width. When one entry is left the ball is wholly owned, and its cached
   sum and count go to that entry at once; leaves compare their points with what
   is left of the list. A task returns one sum for each entry and component,
   Spark adds them up, and 256 * d numbers come back to the driver.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped, and so are those whose length is not that of the vector of the
smallest vec_id, or no multiple of 4. Rows with a null vec_id are coded but start
no entry; where no row has a vec_id, code and error are null. A vec_id that comes
again starts one entry, with the least of its vectors. Repeated rows give repeated
result rows, no rows an empty result. A scaled component beyond +-2^26 is an
error: squared distances would not fit a long. Only the three named columns are
read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetreports.llm.tables import dropped, stored

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK, LEAF = 8192, 32
_MOST = 1 << 26


# ------------------------------------------------------------------------ trees


def _norm(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def _anchors(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of ``x`` by the anchor that owns them, for up to ``most`` anchors."""
    at = [0]
    near, owner = _norm(x - x[0]), np.zeros(len(x), np.int64)
    for new in range(1, most):
        far = int(np.argmax(near))
        if near[far] == 0:
            break
        half = _norm(x[at] - x[far]) / 2
        look = np.flatnonzero(near > half[owner])  # the others are nearer to their own anchor
        d = _norm(x[look] - x[far])
        won = d < near[look]
        near[look[won]], owner[look[won]] = d[won], new
        at.append(far)
        near[far], owner[far] = 0.0, new
    return [rows for rows in (np.flatnonzero(owner == k) for k in range(len(at))) if len(rows)]


class _Tree:
    """Balls of one part of a block, as arrays; children of ball i are
    ``low[i], high[i]`` (-1: a leaf), its points ``order[begin[i]:end[i]]``."""

    def __init__(self, x: np.ndarray):
        self.x, self.low, self.high, self.begin, self.end, self.order = x, [], [], [], [], []
        self.root = self._grow(np.arange(len(x)))
        self.order = np.array(self.order, np.int32)
        begin, end = np.array(self.begin), np.array(self.end)
        sums = np.zeros((len(x) + 1, x.shape[1]), np.int64)
        np.cumsum(x[self.order].astype(np.int64), axis=0, out=sums[1:])
        self.sums = sums[end] - sums[begin]
        self.middle = self.sums / np.maximum(end - begin, 1)[:, None]
        self.radius = np.array([_norm(x[self.order[b:e]] - m).max() for b, e, m in zip(begin, end, self.middle, strict=True)])

    def _ball(self, low: int, high: int, begin: int, end: int) -> int:
        for name, value in (("low", low), ("high", high), ("begin", begin), ("end", end)):
            getattr(self, name).append(value)
        return len(self.low) - 1

    def _leaf(self, rows: np.ndarray) -> int:
        begin = len(self.order)
        self.order.extend(rows.tolist())
        return self._ball(-1, -1, begin, len(self.order))

    def _grow(self, rows: np.ndarray) -> int:
        """The ball of ``rows``: anchors in the middle, merged above, split below."""
        x = self.x[rows].astype(np.float64)
        groups = _anchors(x, max(2, int(len(rows) ** 0.5))) if len(rows) > LEAF else [np.arange(len(rows))]
        if len(groups) == 1:
            return self._leaf(rows)
        middle = np.array([x[g].mean(0) for g in groups])
        radius = np.array([_norm(x[g] - m).max() for g, m in zip(groups, middle, strict=True)])
        return self._merged([rows[g] for g in groups], middle, radius)

    def _merged(self, groups: list[np.ndarray], middle: np.ndarray, radius: np.ndarray) -> int:
        """Merge the tightest pair until one ball is left; then lay out the points
        so that every ball holds a run of them."""
        n = len(groups)
        size = np.array([len(g) for g in groups], np.float64)
        kids: dict[int, tuple[int, int]] = {}
        names = list(range(n))
        wide = np.array([_norm(middle - m) for m in middle]) + radius[:, None] + radius[None, :]
        np.fill_diagonal(wide, np.inf)
        for new in range(n, 2 * n - 1):
            i, j = np.unravel_index(np.argmin(wide), wide.shape)
            kids[new] = (names[i], names[j])
            both = size[i] + size[j]
            m = (middle[i] * size[i] + middle[j] * size[j]) / both
            r = max(float(np.linalg.norm(m - middle[k]) + radius[k]) for k in (i, j))
            middle[i], radius[i], size[i], names[i] = m, r, both, new
            wide[i] = wide[:, i] = _norm(middle - m) + radius + r
            wide[j], wide[:, j], wide[i, i] = np.inf, np.inf, np.inf
            size[j], radius[j] = 0, np.inf

        def lay(name: int) -> int:
            if name < n:
                return self._grow(groups[name])
            begin = len(self.order)
            low, high = (lay(k) for k in kids[name])
            return self._ball(low, high, begin, len(self.order))

        return lay(2 * n - 2)

    FIELDS = ("low", "high", "begin", "end", "order", "sums", "middle", "radius")

    def arrays(self, part: int) -> dict[str, np.ndarray]:
        return {f"{part}{k}": np.asarray(getattr(self, k)) for k in self.FIELDS} | {f"{part}root": np.array(self.root)}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(at, BLOCK)
            n = rows.num_rows
            scaled = np.floor(SCALE * np.asarray(rows.column(2).flatten(), np.float64)).reshape(n, -1)
            if scaled.size and np.abs(scaled).max() > _MOST:
                raise ValueError("a vector component is beyond the range of exact distances (+-2^26 after scaling)")
            points = scaled.astype(np.int32)
            width = points.shape[1] // PARTS
            held = {"points": points}
            for k in range(PARTS):
                held |= _Tree(points[:, k * width:(k + 1) * width]).arrays(k)
            blob = io.BytesIO()
            np.savez(blob, **held)
            off = pa.array([0, n], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(off, rows.column(0)), pa.ListArray.from_arrays(off, rows.column(1)), pa.array([blob.getvalue()], pa.binary())],
                names=["vec_ids", "labels", "trees"])


# ----------------------------------------------------------------------- rounds


def _walk(held: dict[str, np.ndarray], part: int, book: np.ndarray):
    """Owners of the points of one part, as (ball or None, entry, points):
    whole balls, and points of leaves with their entries."""
    low, high, begin, end, order, middle, radius = (held[f"{part}{k}"] for k in ("low", "high", "begin", "end", "order", "middle", "radius"))
    width = book.shape[1]
    x = held["points"][:, part * width:(part + 1) * width].astype(np.int64)
    entries = book.astype(np.float64)
    todo = [(int(held[f"{part}root"]), np.arange(len(book)))]
    while todo:
        ball, left = todo.pop()
        d = _norm(entries[left] - middle[ball])
        bound = d.min() + 2 * radius[ball]
        left = left[d <= bound + 1e-6 * (1 + bound)]  # farther ones are nearest to no point of the ball
        if len(left) == 1:
            yield ball, int(left[0]), order[begin[ball]:end[ball]]
        elif low[ball] < 0:
            rows = order[begin[ball]:end[ball]]
            for at in range(0, len(rows), 4096):  # a leaf of equal points can be large
                some = rows[at:at + 4096]
                best = ((x[some][:, None, :] - book[left][None]) ** 2).sum(2).argmin(1)  # the first of equal ones
                yield None, left[best], some
        else:
            todo += [(int(low[ball]), left), (int(high[ball]), left)]


def _load(blob) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob.as_py())) as held:
        return {k: held[k] for k in held.files}


def _sums(books):
    """Sum and count of every entry's parts, over the blocks of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        count = np.zeros(book.shape[:2], np.int64)
        total = np.zeros(book.shape, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                held = _load(blob)
                for k in range(PARTS):
                    sums = held[f"{k}sums"]
                    x = held["points"][:, k * book.shape[2]:(k + 1) * book.shape[2]]
                    for ball, entry, rows in _walk(held, k, book[k]):
                        if ball is not None:
                            total[k, entry] += sums[ball]
                            count[k, entry] += len(rows)
                        else:
                            np.add.at(total[k], entry, x[rows])
                            np.add.at(count[k], entry, 1)
        part, entry = np.nonzero(count)
        off = np.arange(len(part) + 1) * book.shape[2]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
             pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(total[part, entry].ravel()))],
            names=["part", "entry", "parts", "sums"])
    return run


def _codes(books):
    """vec_id, label, code and error of the rows of the blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = books.value
        for batch in batches:
            for i in range(batch.num_rows):
                held = _load(batch.column(2)[i])
                points = held["points"].astype(np.int64)
                code = np.zeros((len(points), PARTS), np.int64)
                error = np.zeros(len(points), np.int64)
                for k in range(PARTS):
                    for _, entry, rows in _walk(held, k, book[k]):
                        code[rows, k] = entry
                    x = points[:, k * book.shape[2]:(k + 1) * book.shape[2]]
                    error += ((x - book[k][code[:, k]]) ** 2).sum(1)
                hexed = pa.array(["".join(f"{c:02x}" for c in row) for row in code.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1).flatten(), batch.column(1).slice(i, 1).flatten(), hexed, pa.array(error)],
                    names=["vec_id", "label", "code", "error"])
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding (doubles) of the rows that are coded."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    first = rows.agg(F.min_by(F.size("embedding"), F.struct(F.col("vec_id").isNull(), "vec_id", "embedding"))).first()[0]
    return rows.where((F.size("embedding") == F.lit(first or 0)) & F.lit((first or 0) % PARTS == 0))


def _first_books(rows: DataFrame) -> np.ndarray:
    """Codebooks (part, entry, component) of the smallest vec_ids."""
    ids = [r[0] for r in rows.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(ENTRIES).collect()]
    if not ids:
        return np.zeros((PARTS, 0, 0), np.int64)
    first = (rows.where(F.col("vec_id") <= ids[-1]).groupBy("vec_id")
             .agg(F.min(F.transform("embedding", lambda x: F.floor(x * F.lit(float(SCALE))))).alias("v")).orderBy("vec_id").collect())
    whole = np.array([r["v"] for r in first], np.int64).reshape(len(first), -1)
    return np.stack(np.split(whole, PARTS, axis=1))


def codebooks(blocks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds`` rounds over the table of blocks."""
    sc = blocks.sparkSession.sparkContext
    books = books.copy()
    for _ in range(rounds):
        sent = sc.broadcast(books)
        sums = (blocks.select("trees").mapInArrow(_sums(sent), "part int, entry int, parts bigint, sums array<bigint>")
                .select("part", "entry", "parts", F.posexplode("sums").alias("place", "sum"))
                .groupBy("part", "entry", "place").agg(F.sum("parts").alias("parts"), F.sum("sum").alias("sum")).toPandas())
        part, entry, place = (sums[c].to_numpy(np.int64) for c in ("part", "entry", "place"))
        books[part, entry, place] = sums["sum"].to_numpy(np.int64) // sums["parts"].to_numpy(np.int64)
        sent.destroy()
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every usable row of
    ``vectors`` (vec_id, embedding, label). See the module for the method."""
    rows = usable(vectors)
    books = _first_books(rows)
    label = rows.schema["label"].dataType.simpleString()
    if not books.shape[1]:
        out = rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    else:
        blocks = stored(rows.mapInArrow(_blocks, f"vec_ids array<bigint>, labels array<{label}>, trees binary"), "vector-blocks")
        books = codebooks(blocks, books)
        sent = rows.sparkSession.sparkContext.broadcast(books)
        out = stored(blocks.mapInArrow(_codes(sent), f"vec_id bigint, label {label}, code string, error bigint"), "vector-codes")
        dropped(blocks)
    by_label = out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return (out.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
