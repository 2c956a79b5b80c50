"""Benchmark passages in documents, also with other numbers, names and units.

*Template.* Words lose the punctuation around them and their capitals (ASCII and
Latin-1 letters). Numbers become <num>; a unit (fixed list) after a number, or
stuck to it, <unit>; a capitalised word inside a sentence <name>; what a
placeholder stands for is kept as its slot value. Punctuation alone is no token.

*Windows.* Runs of ``WINDOW`` = 5 template tokens with at least two words among
them; an item of fewer tokens is one window of its own length, which only a
text of that template has as a whole. Windows of the benchmark fill a bitmap
of fixed size; document windows that pass it are hash-joined with the benchmark's.

*Plain form.* Which words are a <name> depends on capitals and line feeds, so each
window has a plain form as well: its tokens without capitals, no placeholders. A
window is matched if either form is, the plain one at any place. An item of fewer
than ``WINDOW`` tokens is also matched by its plain tokens: anywhere in a text if it has
at least ``SHORT_TOKENS`` = 2 tokens and ``SHORT_BYTES`` = 8 bytes in them, else (a word that
any text may hold) only by a text of just these tokens. A longer item without a usable window (numbers) only by its whole
sequence of plain tokens, all its runs of ``WINDOW`` at one distance.

*Slots.* The windows of one document and item at one distance (place in the text
less place in the item) are an alignment. Its slots must be consistent: equal item
values meet equal text values (different ones may meet equal ones, as new values
are drawn freely), so a question with other numbers and names is caught.
Windows with a slot that does not are left out, the alignment's others stay;
windows whose slots all equal the item's count in any case.

A document holds an item if the windows left cover ``SHARE`` = 0.75 or more of
the item's distinct windows. Items with the same template and the same pattern
of equal slots are one class, named by its smallest item_id; the plain forms of
all of them count for the class. Without a usable window, equal plain tokens make a class.

Defined cases: null or empty texts, and items, have no window; an item without
a token matches nothing; repeated rows give one result row; rows with a
null doc_id are reported with it; only ``doc_id`` and ``text``, and ``item_id`` and
``text`` of the benchmark, are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetreports.llm import words as W
from fleetreports.llm.bitmaps import hash_filter, low_spots, passes
from fleetreports.llm.tables import stored

WINDOW, SHARE, LEAST_WORDS = 5, 0.75, 2
SHORT_TOKENS, SHORT_BYTES = 2, 8
WORD, NUM, NAME, UNIT = 0, 1, 2, 3

# Units of measure, money and time.
UNITS = [
    "mm", "cm", "m", "km", "in", "inch", "inches", "ft", "foot", "feet", "yd", "yards", "mile", "miles", "mi",
    "mg", "g", "kg", "gram", "grams", "lb", "lbs", "pounds", "oz", "ounces", "ton", "tons", "tonnes",
    "ml", "cl", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "cups",
    "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hr", "hour", "hours", "day", "days",
    "week", "weeks", "month", "months", "year", "years",
    "usd", "eur", "dollars", "dollar", "cents", "euros", "euro",
    "meter", "meters", "metre", "metres", "percent", "degrees", "mph", "kmh", "hz", "khz", "mhz", "ghz",
    "kb", "mb", "gb", "tb", "w", "kw", "kwh", "v", "volts", "j", "joules", "n", "newtons", "pa", "mol",
]

_PUNCT = np.zeros(256, bool)
_PUNCT[[i for i in range(33, 127) if not chr(i).isalnum()]] = True
_PLAIN = np.uint64(0x3C6EF372FE94F82B)
_ALONE = np.uint64(0xD1B54A32D192ED03)
_SLOT = np.array([0, 0x1234567890ABCDEF, 0x0FEDCBA987654321, 0x5A5A5A5A3C3C3C3C], np.uint64)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, as those of words."""
    table, base = W._TABLE, W._P
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(table[data] * W.powers(base, len(data)), out=sums[1:])
    return W.mix((sums[end] - sums[start]) * W.powers(W.inverse(base), len(data) + 1)[start] + (end - start).astype(np.uint64))


def _units() -> np.ndarray:
    raw = [u.encode() for u in UNITS]
    ends = np.cumsum([len(u) for u in raw])
    return np.sort(_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(u) for u in raw], ends))


_UNIT_HASHES = _units()


def _folded(data: np.ndarray) -> np.ndarray:
    low = W.lowered(data)
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    return np.where(after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), low + np.uint8(32), low).astype(np.uint8)


def _tokens(c: W.Chunk) -> tuple[W.Words, np.ndarray, np.ndarray]:
    """Template tokens of a chunk's texts: their hashes as words, each one's
    kind, and the slot value where the kind is not WORD."""
    data, n = c.data, len(c)
    w = W.words(c)
    size = len(data)
    if not len(w.start):
        return w, np.zeros(0, np.int8), np.zeros(0, np.uint64)
    low = _folded(data)
    punct = _PUNCT[data]
    place = np.arange(size, dtype=np.int64)
    right = np.minimum.accumulate(np.where(punct, size, place)[::-1])[::-1]  # the next byte that is no mark
    left = np.maximum.accumulate(np.where(punct, -1, place))
    start, end = np.minimum(right[w.start], w.end), np.maximum(left[w.end - 1] + 1, w.start)
    keep = start < end
    stops = np.isin(data[w.end - 1], [33, 46, 58, 63])
    line = np.concatenate(([0], np.cumsum(data == 10)))
    opens = np.ones(len(w.start), bool)  # a sentence begins here
    opens[1:] = stops[:-1] | (w.doc[1:] != w.doc[:-1]) | (line[w.start[1:]] != line[w.start[:-1]])
    start, end, doc, opens = start[keep], end[keep], w.doc[keep], opens[keep]
    first = np.searchsorted(doc, np.arange(n + 1)).astype(np.int64)
    digit = (data >= 48) & (data <= 57)
    other = ~(digit | np.isin(data, [46, 44, 45, 47, 37, 43]))
    digits = np.concatenate(([0], np.cumsum(digit)))
    others = np.concatenate(([0], np.cumsum(other)))
    has = digits[end] > digits[start]
    number = has & (others[end] == others[start])
    value = _hashes(low, start, end)
    # "5km": digits, then letters that are a unit.
    mixed = np.flatnonzero(has & ~number & digit[start] & ~digit[end - 1])
    glued = np.zeros(len(start), bool)
    cut = end.copy()
    if len(mixed):
        last = np.maximum.accumulate(np.where(digit, place, -1))[end[mixed] - 1] + 1
        pure = others[last] == others[start[mixed]]
        is_unit = np.isin(_hashes(low, last, end[mixed]), _UNIT_HASHES)
        glued[mixed[pure & is_unit]] = True
        cut[mixed] = np.where(pure & is_unit, last, end[mixed])
    upper = (data >= 65) & (data <= 90)
    latin = np.zeros(size, bool)
    latin[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    capital = upper | latin
    capitals = np.concatenate(([0], np.cumsum(capital)))
    name = capital[start] & (capitals[end] - capitals[start] == 1) & ~opens & ~has
    before = np.zeros(len(start), bool)
    before[1:] = number[:-1] & (doc[1:] == doc[:-1])
    unit = before & ~has & np.isin(value, _UNIT_HASHES)
    kind = np.where(unit, UNIT, np.where(number | glued, NUM, np.where(name, NAME, WORD))).astype(np.int8)
    if glued.any():  # one token more for the unit
        at = np.flatnonzero(glued)
        value[at] = _hashes(low, start[at], cut[at])
        extra = _hashes(low, cut[at], end[at])
        value, kind = np.insert(value, at + 1, extra), np.insert(kind, at + 1, UNIT)
        doc = np.insert(doc, at + 1, doc[at])
        start, end = np.insert(start, at + 1, cut[at]), np.insert(end, at + 1, end[at])
        first = np.searchsorted(doc, np.arange(n + 1)).astype(np.int64)
    template = np.where(kind == WORD, value, _SLOT[kind])
    return W.Words(start, end, template, doc, first), kind, value


def _windows(c: W.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, W.Words, np.ndarray]:
    """Usable windows of a chunk: hash, first token, row; slot values (0: a word)
    of all tokens; the tokens; their plain values."""
    t, kind, value = _tokens(c)
    slots = np.where(kind == WORD, np.uint64(0), value ^ _SLOT[kind] | np.uint64(1))
    h, begin = W.runs(t, WINDOW)
    words = np.concatenate(([0], np.cumsum(kind == WORD)))
    good = words[begin + WINDOW] - words[begin] >= LEAST_WORDS if len(begin) else np.zeros(0, bool)
    h, begin = h[good], begin[good]
    count = np.diff(t.first)
    short = np.flatnonzero((count > 0) & (count < WINDOW))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k, i in enumerate(short):
            v = np.array([int(count[i])], np.uint64)
            for x in t.hash[t.first[i]:t.first[i + 1]]:
                v = W.mix(v ^ x)
            whole[k] = v[0]
        h, begin = np.concatenate((h, whole)), np.concatenate((begin, t.first[short]))
    return h, begin, t.doc[begin] if len(begin) else begin, slots, t, value


def _plain(t: W.Words, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n plain tokens, and the first token of each."""
    h, begin = W.runs(t, n, value)
    return W.mix(h ^ (_PLAIN + np.uint64(n))), begin


def _alone(plain: np.ndarray) -> np.ndarray:
    """Hashes of plain tokens that are a text's only ones."""
    return W.mix(plain ^ _ALONE)


def _slot_lists(slots: np.ndarray, begin: np.ndarray, t: W.Words, plain: np.ndarray) -> pa.Array:
    """Slot values of each window's tokens; none of plain windows."""
    size = np.where(plain, 0, np.minimum(WINDOW, np.diff(t.first)[t.doc[begin]])) if len(begin) else begin
    off = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    at = np.repeat(begin - off[:-1], size) + np.arange(off[-1])
    return W.lists(W.signed(slots[at]), off)


#: Forms of an item's windows: of its template; plain; a run of a whole plain sequence.
TEMPLATE, PLAIN, WHOLE = 0, 1, 2


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of items: ``w`` names the window, ``h`` is the hash of one form of it."""
    for c in W.chunks(batches, size=W.PIECE):
        h, begin, row, slots, t, value = _windows(c)
        count = np.diff(t.first)
        usable = np.bincount(row, minlength=len(c)) > 0
        plain = np.zeros(len(t.hash), np.uint64)
        for n in range(1, WINDOW + 1):
            own, at = _plain(t, value, n)
            fits = (count[t.doc[at]] == n) | (n == WINDOW) & (count[t.doc[at]] > n) if len(at) else np.zeros(0, bool)
            plain[at[fits]] = own[fits]
            if n == WINDOW:
                runs = at[~usable[t.doc[at]]] if len(at) else at
        anywhere = (count >= WINDOW) | (count >= SHORT_TOKENS) & (np.bincount(t.doc, t.end - t.start, len(c)) >= SHORT_BYTES)
        whole = ~anywhere[t.doc] if len(t.hash) else np.zeros(0, bool)
        plain[whole] = _alone(plain[whole])
        w = np.concatenate((h, h, plain[runs]))
        form = np.repeat([TEMPLATE, PLAIN, WHOLE], [len(h), len(h), len(runs)])
        key = np.concatenate((h, plain[begin], plain[runs]))
        begin = np.concatenate((begin, begin, runs)).astype(np.int64)
        row = t.doc[begin] if len(begin) else begin
        alike = []  # template and pattern of equal slots
        for i in range(len(c)):
            s = slots[t.first[i]:t.first[i + 1]]
            _, pattern = np.unique(s, return_inverse=True)
            ranks = {}
            pattern = np.array([ranks.setdefault(p, len(ranks)) for p in pattern.tolist()], np.uint64)
            if not usable[i]:
                pattern = value[t.first[i]:t.first[i + 1]]
            alike.append(t.hash[t.first[i]:t.first[i + 1]].tobytes() + pattern.tobytes())
        place = np.where(form == PLAIN, 0, begin - t.first[row])
        places = np.where(form == WHOLE, count[row] - WINDOW + 1, 0)
        yield pa.RecordBatch.from_arrays(
            [c.rows.column(0).take(pa.array(row)), pa.array([alike[i] for i in row], pa.binary()), pa.array(form.astype(np.int32)),
             pa.array(W.signed(w)), pa.array(W.signed(key)), pa.array(place.astype(np.int32)), pa.array(places.astype(np.int32)),
             pa.array(count[row].astype(np.int32)), _slot_lists(slots, begin, t, form != TEMPLATE)],
            names=["own_id", "alike", "form", "w", "h", "item_at", "places", "tokens", "item_slots"])


def _doc_windows(bitmap, short: list[int]):
    """``short``: the lengths of items with fewer than WINDOW tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in W.chunks(batches, size=W.PIECE):
            h, begin, _, slots, t, value = _windows(c)
            hit = passes(bitmap.value, low_spots(h))
            found = [(h[hit], begin[hit])]
            for n in [*short, WINDOW]:
                h, begin = _plain(t, value, n)
                if n < WINDOW and len(h):
                    only = np.diff(t.first)[t.doc[begin]] == n
                    h, begin = np.concatenate((h, _alone(h[only]))), np.concatenate((begin, begin[only]))
                hit = passes(bitmap.value, low_spots(h))
                h, begin = h[hit], begin[hit]
                if n < WINDOW and len(h):  # once a text
                    order = np.lexsort((h, t.doc[begin]))
                    h, begin = h[order], begin[order]
                    new = np.concatenate(([True], (h[1:] != h[:-1]) | (t.doc[begin[1:]] != t.doc[begin[:-1]])))
                    h, begin = h[new], begin[new]
                found.append((h, begin))
            h, begin = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(h):
                row = t.doc[begin]
                plain = np.arange(len(h)) >= len(found[0][0])
                yield pa.RecordBatch.from_arrays(
                    [c.rows.column(0).take(pa.array(row)), c.rows.column(1).take(pa.array(row)), pa.array(W.signed(h)),
                     pa.array((begin - t.first[row]).astype(np.int32)), _slot_lists(slots, begin, t, plain)],
                    names=["doc_id", "text_key", "h", "at", "slots"])
    return run


def _repeated(values: str) -> Column:
    """The values that a sorted array holds more than once."""
    return F.filter(values, lambda x, i: (i > 0) & (x == F.get(F.col(values), i - 1)))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, n_matched, share): the benchmark
    items that documents hold, one row a document and item class."""
    items = stored(benchmark.select("item_id", "text").mapInArrow(
        _item_windows, "own_id bigint, alike binary, form int, w bigint, h bigint, item_at int, places int, tokens int, "
                       "item_slots array<bigint>"), "items").withColumn("alike", F.sha2("alike", 256))
    heads = items.groupBy("alike").agg(F.min("own_id").alias("item_id"))
    short = sorted(r["tokens"] for r in items.where(F.col("tokens") < WINDOW).select("tokens").distinct().collect())  # 4 rows at most
    items = (items.join(heads, "alike").where((F.col("form") != TEMPLATE) | (F.col("own_id") == F.col("item_id")))
             .select("item_id", "form", "w", "h", "item_at", "places", "item_slots").distinct())
    size = items.groupBy("item_id").agg(F.countDistinct("w").alias("n_windows"))
    bitmap = docs.sparkSession.sparkContext.broadcast(hash_filter(items, F.col("h")))
    found = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
             .mapInArrow(_doc_windows(bitmap, short), "doc_id bigint, text_key bigint, h bigint, at int, slots array<bigint>"))
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"] != 0)
    one = found.join(items, "h").select(
        "doc_id", "text_key", "item_id", F.when(F.col("form") == PLAIN, 0).otherwise(F.col("at") - F.col("item_at")).alias("distance"),
        F.col("w").alias("h"), pairs.alias("pairs"), "places", F.when(F.col("form") == WHOLE, F.col("item_at")).alias("spot"))
    aligned = (one.groupBy("doc_id", "text_key", "item_id", "distance")
               .agg(F.collect_set(F.struct("h", "pairs")).alias("windows"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
                    F.max("places").alias("places"), F.countDistinct("spot").alias("spots"))
               .where(F.col("spots") == F.col("places"))
               .withColumn("item_values", F.array_sort("pairs.item_slots")).withColumn("item_values", _repeated("item_values")))
    fair = aligned.select("doc_id", "text_key", "item_id", F.filter("windows", lambda w: F.forall(
        w["pairs"], lambda p: p["item_slots"] == p["slots"]) | ~F.arrays_overlap(w["pairs"]["item_slots"], F.col("item_values"))).alias("windows"))
    return (fair.select("doc_id", "text_key", "item_id", F.explode("windows.h").alias("h")).distinct()
            .groupBy("doc_id", "text_key", "item_id").agg(F.count("*").alias("n_matched"))
            .join(size, "item_id").withColumn("share", F.col("n_matched") / F.col("n_windows")).where(F.col("share") >= SHARE)
            .select("doc_id", "text_key", "item_id", "n_windows", "n_matched", "share"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item class it holds: doc_id,
    item_id, n_windows, n_matched, share. Documents without one have no row."""
    return matches(docs, benchmark).drop("text_key").distinct()


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all columns stay."""
    found = matches(docs, benchmark).select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct()
    return docs.join(found, docs["doc_id"].cast("bigint").eqNullSafe(F.col("_doc")) & (F.xxhash64(docs["text"]) == F.col("_key")), "left_anti")
