"""Secrets in texts: trigram inverted index, then the rules' regular
expressions. DataFrame functions only.

Each rule's regular expression gives a Boolean query of trigrams that every
match must contain (lower-cased): literal runs between open-ended parts, an AND
of ORs of trigram sets. The inverted index posts every document under the
trigrams that the rules ask for and that its text holds; a rule's candidates
are the documents whose postings satisfy its query. Only these are verified
with the expression. Rules without a mandatory trigram scan every text.

Matches are leftmost and non-overlapping per rule; a match whose tested group
is shorter than the rule's length is dropped, having used up its text. Spans
are code points, end exclusive, as ``kind:start:end`` sorted by start, then by the
kinds' order, comma-joined. The three base kinds come first; the others add
spans and never change the base's.

Defined cases: null and empty texts have no span; repeated rows give repeated
result rows; rows with a null doc_id are scanned too. Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as _c
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MOST_FORMS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``group`` of a match must have ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False
    base: bool = False


# The base kinds in their order, then the added ones. In the first
# line the length is tested after matching; in the next two, matches are whole
# runs, so the length is part of the expression.
RULES = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, any_case=True, base=True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
]


def _forms(node) -> list[list[str]]:
    """Ways to go on: lists of literal runs, cut where a part is open-ended."""
    kind, value = node
    if kind is _c.LITERAL:
        return [[chr(value)]]
    if kind is _c.IN and all(k is _c.LITERAL for k, _ in value) and len(value) <= 8:
        return [[chr(v)] for _, v in value]
    if kind is _c.SUBPATTERN:
        return _sequence(value[3])
    if kind is _c.BRANCH:
        return [f for branch in value[1] for f in _sequence(branch)]
    if kind in (_c.MAX_REPEAT, _c.MIN_REPEAT):
        least, most, part = value
        if (least, most) == (0, 1):
            return [[""], *_sequence(part)]
        if least == most and least <= 8:
            return _sequence(list(part) * least)
        return [[*w, ""] for w in _sequence(part)] if least else [["", ""]]
    return [["", ""]]  # any character may stand here


def _sequence(nodes) -> list[list[str]]:
    """All ways through a sequence, as lists of literal runs. A part that would
    give too many ways counts as open-ended, which asks for less."""
    ways = [[""]]
    for node in nodes:
        forms = _forms(node)
        if len(ways) * len(forms) > _MOST_FORMS:
            forms = [["", ""]]
        ways = [[*a[:-1], a[-1] + b[0], *b[1:]] for a, b in product(ways, forms)]
    return ways


def trigram_query(rule: Rule) -> list[frozenset[str]]:
    """Sets of lower-case trigrams: a text with a match has all trigrams of at
    least one of them. No set: every text must be scanned."""
    sets = {frozenset(run[i:i + 3].lower() for run in way for i in range(len(run) - 2)) for way in _sequence(_parser.parse(rule.pattern))}
    least = [s for s in sets if not any(o < s for o in sets)]
    return [] if frozenset() in least else sorted(least, key=sorted)


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(ord, text_key, rules): the rules, by number, whose query a document's
    postings satisfy; documents without such a rule have no row."""
    asked = [(r, q) for r, rule in enumerate(rules) if (q := trigram_query(rule))]
    grams = sorted({g for _, q in asked for s in q for g in s})
    low = docs.select("ord", "text_key", F.lower("text").alias("low"))
    postings = (low.select("ord", "text_key", F.explode(F.array_compact(F.array(
        *[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))).alias("gram")))
    held = postings.groupBy("ord", "text_key").agg(F.collect_set("gram").alias("grams"))  # at most len(grams) a document

    def true_for(query: list[frozenset[str]]) -> Column:
        hit = F.lit(False)
        for s in query:
            need = F.array(*[F.lit(grams.index(g)) for g in sorted(s)])
            hit = hit | (F.size(F.array_except(need, "grams")) == 0)
        return hit

    found = F.array_compact(F.array(*[F.when(true_for(q), F.lit(r)) for r, q in asked]))
    return held.select("ord", "text_key", found.alias("rules")).where(F.size("rules") > 0)


def _spans(number: int, rule: Rule) -> Column:
    """Array of (start, number, end) from ``_m``, ``_g`` and ``_p``: the matches, their
    tested groups and what stands between them."""
    m, g, p = (F.col(f"_{x}{number}") for x in "mgp")
    none = F.array().cast("array<struct<start:int,number:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(s, i):
        begin = s["at"] + F.length(F.get(p, i))
        end = begin + F.length(F.get(m, i))
        span = F.struct(begin.alias("start"), F.lit(number).alias("number"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(F.get(g, i)) >= rule.least, F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

    return F.when(F.size(m) > 0, F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), start, step)["out"]).otherwise(none)


def _joined(spans: Column, rules: list[Rule]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["number"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_<kind> of each rule,
    base_sha256 and spans."""
    rules = RULES if rules is None else rules
    docs = docs.select(
        F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("ord"), F.xxhash64("text").alias("text_key"))
    out = (docs.join(candidates(docs, rules), ["ord", "text_key"], "left")
           .select("doc_id", "text", F.coalesce("rules", F.array().cast("array<int>")).alias("rules")))
    empty = F.array().cast("array<string>")
    patterns = [f"(?i){r.pattern}" if r.any_case else r.pattern for r in rules]
    asked = [F.lit(True) if not trigram_query(r) else F.array_contains("rules", n) for n, r in enumerate(rules)]
    # Each step is a projection of its own, so nothing is computed twice.
    out = out.select("*", *[F.when(asked[n], F.regexp_extract_all("text", F.lit(patterns[n]), F.lit(0))).otherwise(empty).alias(f"_m{n}") for n in range(len(rules))])
    out = out.select("*", *[
        e for n, r in enumerate(rules) for e in (
            F.when(F.size(f"_m{n}") > 0, F.split("text", patterns[n], -1)).otherwise(empty).alias(f"_p{n}"),
            (F.when(F.size(f"_m{n}") > 0, F.regexp_extract_all("text", F.lit(patterns[n]), F.lit(r.group))).otherwise(empty)
             if r.group else F.col(f"_m{n}")).alias(f"_g{n}"))])
    out = out.select("doc_id", *[_spans(n, r).alias(f"_s{n}") for n, r in enumerate(rules)])
    base = [n for n, r in enumerate(rules) if r.base]
    out = out.select("*", F.array_sort(F.concat(*[F.col(f"_s{n}") for n in base])).alias("_base"),
                     F.array_sort(F.concat(*[F.col(f"_s{n}") for n in range(len(rules))])).alias("_all"))
    return out.select("doc_id", *[F.size(f"_s{n}").cast("bigint").alias(f"n_{r.kind}") for n, r in enumerate(rules)],
                      F.sha2(_joined(F.col("_base"), rules), 256).alias("base_sha256"), _joined(F.col("_all"), rules).alias("spans"))
