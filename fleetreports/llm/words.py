"""Words, shingles and windows of many texts at once, with NumPy in tasks.

``chunks`` cuts Arrow batches into pieces of about ``CHUNK`` text bytes (one
longer text is a piece of its own), so a task's memory does not depend on the
batch size. Words are the runs of bytes other than 0x20 and 0x09-0x0D of the
UTF-8 text; hashes are 64-bit polynomials over bytes and over words, mixed,
and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
PIECE = 1 << 18  # for passes whose arrays take many times the text's bytes
U = np.uint64
_P, _Q = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_TABLE = np.random.Generator(np.random.PCG64(20240611)).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_known_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept for the next chunk of the task."""
    p = _known_powers.get(base)
    if p is None or len(p) < n:
        p = np.full(max(1 << 12, 1 << int(n).bit_length()), base, dtype=np.uint64)
        p[0] = 1
        p = _known_powers[base] = np.cumprod(p, dtype=np.uint64)
    return p[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


@dataclass
class Chunk:
    """Some rows of an Arrow batch with the bytes of their texts."""

    rows: pa.RecordBatch
    data: np.ndarray  # uint8, the texts one after the other
    off: np.ndarray  # int64, n + 1 offsets into data
    valid: np.ndarray  # bool, the text is not null

    def __len__(self) -> int:
        return self.rows.num_rows

    def text(self, i: int) -> bytes:
        return self.data[self.off[i]:self.off[i + 1]].tobytes()


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind, n = np.int64 if wide else np.int32, len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    valid = np.asarray(column.is_valid()) if column.null_count else np.ones(n, bool)
    return raw, off, valid


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK) -> Iterator[Chunk]:
    """Pieces of about ``size`` text bytes, at least one row each."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        raw, off, valid = _bytes_of(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
            j = min(j, n, i + 20_000)
            yield Chunk(batch.slice(i, j - i), raw[off[i]:off[j]], off[i:j + 1] - off[i], valid[i:j])
            i = j


@dataclass
class Words:
    """Words of a chunk: byte spans, hashes, and each text's range of words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray  # row of each word
    first: np.ndarray  # n + 1: words of row i are first[i]:first[i + 1]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)


def words(chunk: Chunk, lower: bool = False) -> Words:
    data, off, n = chunk.data, chunk.off, len(chunk)
    if lower:
        data = lowered(data)
    size = len(data)
    if not size:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(0, np.uint64), z, np.zeros(n + 1, np.int64))
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(size + 1, bool)  # a text begins here
    cut[off[:-1]] = True
    cut[size] = True
    before = np.empty(size, bool)
    before[0], before[1:] = False, solid[:-1]
    start = np.flatnonzero(solid & (~before | cut[:-1]))
    after = np.empty(size, bool)
    after[-1], after[:-1] = False, solid[1:]
    end = np.flatnonzero(solid & (~after | cut[1:])) + 1
    sums = np.empty(size + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_TABLE[data] * powers(_P, size), out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * powers(inverse(_P), size)[start] + (end - start).astype(np.uint64))
    doc = np.searchsorted(off, start, "right") - 1
    return Words(start, end, hashes, doc, np.searchsorted(doc, np.arange(n + 1)).astype(np.int64))


def runs(w: Words, n: int, hashes: np.ndarray | None = None, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within one text, and where (in words)
    each begins. ``hashes``: other word hashes than those of ``w``."""
    h = w.hash if hashes is None else hashes
    total = len(h)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begin = np.flatnonzero(w.doc[:total - n + 1] == w.doc[n - 1:])
    q = (_Q + 2 * seed * 0x5851F42D4C957F2D) | 1
    q %= 1 << 64
    if n <= 8:
        h = mix(h + U(seed)) if seed else h
        value = h[:total - n + 1].copy()
        for j in range(1, n):
            value = value * U(q) + h[j:total - n + 1 + j]
        return mix(value[begin]), begin
    sums = np.empty(total + 1, np.uint64)
    sums[0] = 0
    np.cumsum((mix(h + U(seed)) if seed else h) * powers(q, total), out=sums[1:])
    return mix((sums[begin + n] - sums[begin]) * powers(inverse(q), total)[begin]), begin


def shingles(w: Words, n: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's distinct shingles of ``n`` words, sorted by hash; the whole
    sequence where a text has fewer words, none where it has no word. Returns
    the hashes one text after the other, and rows + 1 offsets."""
    value, begin = runs(w, n)
    at = np.searchsorted(begin, w.first)
    count = np.diff(w.first)
    out, off = [], np.zeros(rows + 1, np.int64)
    for i in range(rows):
        if count[i] >= n:
            s = np.sort(value[at[i]:at[i + 1]])
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif count[i]:
            v = U(int(count[i]))  # of another length than a shingle: its own seed
            for x in w.hash[w.first[i]:w.first[i + 1]]:
                v = U((int(v) * _Q + int(x)) % (1 << 64))
            s = mix(np.array([v], np.uint64))
        else:
            s = value[:0]
        out.append(s)
        off[i + 1] = off[i] + len(s)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), off


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)


def lists(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """An Arrow list column from values and offsets."""
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values))
