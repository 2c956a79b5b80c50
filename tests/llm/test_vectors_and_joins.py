"""Vector codes, hard negatives and the n-gram Jaccard join against brute force:
the small tables with odd rows added, clustered vectors over several blocks, and
empty tables."""

import hashlib
import math
import random

import numpy as np
import pytest

from fleetreports.llm import hard_negatives, jaccard_join, vector_codes
from tests.llm.conftest import SMALL

VECTORS = "vec_id bigint, embedding array<float>, label int, code string, error string, part int, query int, v int, rank int"


def clustered(n, dims, seed, first=0):
    rng = np.random.Generator(np.random.PCG64(seed))
    middle = rng.normal(size=(7, dims))
    label = rng.integers(0, 7, n)
    return [(first + i, [float(x) for x in (middle[k] + 0.3 * rng.normal(size=dims)).astype(np.float32)], int(k)) for i, k in enumerate(label)]


def odd_vectors(dims=64):
    """Nulls, non-finite and missing components, other lengths, repeated rows and
    ids, a null id, a hot vector, null labels, far-out vectors."""
    good = [0.25] * dims
    rows = [(20_000, None, 1), (20_001, [None] + good[1:], 1), (20_002, [math.nan] + good[1:], 1), (20_003, [math.inf] + good[1:], 2),
            (20_004, good[:-4], 1), (20_005, [], 1), (20_006, good, None), (None, good, 3), (20_007, good, 3), (20_007, good, 3),
            (20_050, good, 3), (20_050, [-x for x in good], 4), (20_050, good, 3), (20_100, [1000.0 * x for x in good], 5), (20_101, [0.0] * dims, 5)]
    rows += [(21_000 + i, good, i % 2) for i in range(150)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = given + clustered(1500, 64, 3, 5_000) + odd_vectors()
    df = spark.createDataFrame([(*r, "x", "y", 1, 2, 3, 4) for r in rows], VECTORS).repartition(3).cache()
    return df, rows


def usable(rows, dims=64):
    return [r for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]


# ------------------------------------------------------------------ op11


def codes_by_hand(rows):
    rows = usable(rows)
    x = np.array([[math.floor(1024 * np.float32(c).astype(float)) for c in r[1]] for r in rows])
    first = {}
    for r, v in zip(rows, x.tolist(), strict=True):
        if r[0] is not None:
            first[r[0]] = min(first.get(r[0], v), v)
    start = np.array([first[i] for i in sorted(first)[:256]])
    parts, books = np.split(x, 4, axis=1), np.split(start, 4, axis=1)

    def nearest(p, b):
        d = ((p[:, None, :] - b[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(4):
        for k in range(4):
            own, _ = nearest(parts[k], books[k])
            books[k] = np.array([[int(s) // int((own == e).sum()) for s in parts[k][own == e].sum(0)] if (own == e).any() else books[k][e] for e in range(len(books[k]))])
    got = [nearest(p, b) for p, b in zip(parts, books, strict=True)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b.tolist() for c in e).encode()).hexdigest()
    error = sum(d for _, d in got)
    by_label = {}
    for r, e in zip(rows, error.tolist(), strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted(((r[0], "".join(f"{int(own[i]):02x}" for own, _ in got), int(error[i]), by_label[r[2]], sha) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [8192, 300])
def test_vector_codes(vectors, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    df, rows = vectors
    got = vector_codes.compress(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == codes_by_hand(rows)


def test_balls_are_owned_whole():
    """Tight clusters are settled by cached sums, not point by point."""
    rng = np.random.Generator(np.random.PCG64(5))
    book = rng.integers(-10_000, 10_000, (50, 8))
    x = (np.repeat(book, 60, axis=0) + rng.integers(-5, 5, (3000, 8))).astype(np.int32)
    held = vector_codes._Tree(x).arrays(0) | {"points": x}
    whole = points = 0
    for ball, entry, rows in vector_codes._walk(held, 0, book):
        points += len(rows)
        if ball is not None:
            whole += len(rows)
            assert (held["0sums"][ball] == x[rows].sum(0)).all()
        assert (((x[rows][:, None] - book[None]).astype(np.int64) ** 2).sum(2).argmin(1) == entry).all()
    assert points == 3000 and whole > 2900


def test_vector_codes_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_codes.compress(empty).collect() == []
    nameless = spark.createDataFrame([(None, [1.0] * 8, 1)], "vec_id bigint, embedding array<double>, label int")
    assert [(r.code, r.error) for r in vector_codes.compress(nameless).collect()] == [(None, None)]
    uneven = spark.createDataFrame([(1, [1.0] * 7, 1)], "vec_id bigint, embedding array<double>, label int")
    assert vector_codes.compress(uneven).collect() == []
    few = spark.createDataFrame([(2, [-1.5, 0.0, 2.0, 3.0], None), (1, [0.1, 0.2, 0.3, 0.4], None)], "vec_id bigint, embedding array<double>, label string")
    got = sorted(vector_codes.compress(few).collect())
    assert [r.code for r in got] == ["00000000", "01010101"] and {r.error for r in got} == {0} and {r.label_error for r in got} == {0}


# ------------------------------------------------------------------ op12


def triplets_by_hand(rows):
    rows = [(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(c))) for c in v))
            for i, v, label in usable(rows) if i is not None and label is not None]
    rows = sorted(set(rows))
    x = np.array([r[2] for r in rows], np.int64)
    out = []
    for a in rows:
        if a[0] % 50:
            continue
        score = x @ np.array(a[2], np.int64)
        order = sorted(range(len(rows)), key=lambda i: (-score[i], rows[i][0]))
        order = [i for i in order if rows[i][0] != a[0]]
        for p in [i for i in order if rows[i][1] == a[1]][:5]:
            fits = [i for i in order if rows[i][1] != a[1] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:3]
            out += [(a[0], rows[p][0], k + 1, rows[i][0], int(score[p]), int(score[i])) for k, i in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize(("block", "queries"), [(8192, 16_384), (400, 20)])
def test_hard_negatives(vectors, monkeypatch, block, queries):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "QUERIES", queries)
    df, rows = vectors
    got = hard_negatives.mine(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == triplets_by_hand(rows)


def test_siblings_are_eliminated(monkeypatch):
    """On clustered vectors most leaves are never compared."""
    rng = np.random.Generator(np.random.PCG64(9))
    v = np.floor(256 * (np.repeat(rng.normal(size=(40, 16)), 100, axis=0) + 0.02 * rng.normal(size=(4000, 16))))
    square = np.einsum("ij,ij->i", v, v)
    held = hard_negatives._build(np.column_stack([v, np.sqrt(square.max() - square)])) | {
        "ids": np.arange(4000), "labels": np.repeat(np.arange(40), 100), "marks": np.arange(4000), "v": v, "square": square.max()}
    at = np.arange(0, 4000, 50)
    s = hard_negatives._Search(held, v[at], at, held["labels"][at], np.full(80, -np.inf), np.full(80, np.inf), 5, True)
    compared = 0
    leaf = s.leaf

    def counted(rows, queries):
        nonlocal compared
        compared += len(rows) * len(queries)
        leaf(rows, queries)

    s.leaf = counted
    query, ids, score, _ = s.results()
    assert compared < 0.5 * 80 * 4000
    for k in range(80):
        every = v @ v[at[k]]
        want = sorted((-every[i], i) for i in range(4000) if held["labels"][i] == held["labels"][at[k]] and i != at[k])[:5]
        assert sorted(zip((-score[query == k]).tolist(), ids[query == k].tolist(), strict=True)) == want


def test_hard_negatives_empty(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).collect() == []
    alone = spark.createDataFrame([(50, [1.0, 2.0], 1), (51, [1.0, 2.0], 2)], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives.mine(alone).collect() == []


# ------------------------------------------------------------------ op13


def classes_by_hand(rows, n=3, percent=90):
    sets = []
    for doc_id, text in rows:
        w = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
        sets.append((doc_id, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())))
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    full = [(d, s) for d, s in sets if d is not None and s]
    for i, (a, s) in enumerate(full):
        for b, t in full[:i]:
            if 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= percent * (len(s) + len(t) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else root(d) if s else d) for d, s in sets), key=repr)


def similar_texts():
    """Crowds of near copies of many sizes, at and about the similarity; a doc_id
    with two texts that join two crowds."""
    rng = random.Random(8)
    out, k = [], 30_000
    for words in [*range(3, 36), 60, 120, 400]:
        base = [f"w{words}x{i}" for i in range(words)]
        for _ in range(6):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(text))
                kind = rng.random()
                if kind < 0.4:
                    text[at] = f"new{rng.randrange(3)}"
                elif kind < 0.7:
                    text.insert(rng.choice([0, len(text)]), f"more{rng.randrange(3)}")
                else:
                    del text[rng.choice([0, -1])]
            out.append((k, " ".join(text)))
            k += 1
    passage = " ".join(f"p{i}" for i in range(70))  # many texts hold it, none is alike
    out += [(k + i, f"{passage} " + " ".join(f"t{i}y{j}" for j in range(12))) for i in range(40)]
    return out + [(40_000, out[0][1]), (40_000, out[-50][1]), (3, out[-60][1]), (3, out[5][1])]


@pytest.mark.parametrize("light", [None, 8])
def test_jaccard_join(spark, docs, rows, monkeypatch, light):
    if light:  # all heavy
        monkeypatch.setattr(jaccard_join, "_boundary", lambda posted, sizes: (light, frozenset(r.n for r in sizes.collect())))
    more = similar_texts()
    df = docs.select("doc_id", "text", "label", "n", "rep", "token").unionByName(
        spark.createDataFrame([(i, t, 0, 0, 0, "x") for i, t in more], "doc_id bigint, text string, label int, n int, rep bigint, token string"))
    got = jaccard_join.jaccard_classes(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == classes_by_hand(rows + more)


def test_subsets_cover_all_linked_sizes():
    for n in range(9, 40):
        for m in range(9, n + 1):
            for both in range(m + 1):
                linked = 100 * both >= 90 * (n + m - both)
                assert linked == (both >= jaccard_join.overlap(m, n))
                if linked and (both < n or both < m):
                    assert (m, n) in jaccard_join.partners(n) and (m, n) in jaccard_join.partners(m)


def test_jaccard_join_empty(spark, none):
    assert jaccard_join.jaccard_classes(none).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (None, "a b c d")], "doc_id bigint, text string")
    assert sorted((tuple(r) for r in jaccard_join.jaccard_classes(blank).collect()), key=repr) == [(1, 0, 1), (2, 0, 2), (None, 2, None)]
