"""URL rules by host and path, longest match first, as a sort-merge range join.

A rule (host, path) fits its host and all subdomains where the url's path starts
with the rule's. A host's canonical key is its labels in reverse, each closed by
a slash (``net/example/www/``), so a rule's host and its subdomains are one
interval of keys, and nested rules are nested intervals.

1. Urls are cut into ranges of about ``ROWS_PER_RANGE`` in the order (key, path, id
   hash), at quantiles of a sampled set of keys; one hot host, even one hot
   url, is cut like any other stretch.
2. A rule goes to every range that its interval meets; where a range holds one
   host only, rules of that host whose paths end before or begin after the
   range stay away.
3. Each range is swept in key order, rules before urls. The sweep keeps a
   stack of the host intervals that are open, with their rules by path; it is
   popped when the key leaves an interval. A url looks up its path's prefixes,
   at the lengths that occur, from the top of the stack to its bottom.

The longest rule wins (host and path taken together, in characters; then the
longer host); of two rules with the same host and path, block wins. A url that
no rule fits gets the default verdict.

Defined cases: a null url, or one without ``://``, has an empty host and path and
no rule; rules without a host or with a null path or verdict are left out; an empty rule
table leaves every url to the default; repeated rows give repeated result rows;
only the id and url columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
ROWS_PER_RANGE, MAX_RANGES, KEYS_PER_RANGE, KEY_CHARS = 20_000, 20_000, 20, 200

# The rules of the registered query.
RULES = [("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW)]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, "host string, path string, verdict string")


def _small(text: Column) -> Column:
    """A-Z lower-cased, other characters unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(_small(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    """Labels in reverse, each closed by a slash, which no host holds."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/")))


def _utf8(row) -> tuple[bytes, bytes, int]:
    return (row[0].encode()[:KEY_CHARS], row[1].encode()[:KEY_CHARS], row[2])


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stack = None, []  # open intervals: key, {path: (verdict, rule, host length)}, path lengths
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            rules, verdicts = [], []
            cols = [b.column(b.schema.get_field_index(n)).to_pylist() for n in ("range", "key", "path", "kind", "host", "verdict")]
            for i, (part, key, path, kind, host, verdict) in enumerate(zip(*cols, strict=True)):
                if part != now:
                    now, stack = part, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, set()))
                    if stack[-1][1].get(path, (ALLOW,))[0] != BLOCK:
                        stack[-1][1][path] = (verdict, host + path, len(host))
                    stack[-1][2].add(len(path))
                    continue
                keep[i] = True
                best = None
                for _, paths, lengths in reversed(stack):
                    for size in lengths:
                        hit = paths.get(path[:size]) if size <= len(path) else None
                        if hit and (best is None or (len(hit[1]), hit[2]) > (len(best[1]), best[2])):
                            best = hit
                rules.append(best[1] if best else None)
                verdicts.append(best[0] if best else default)
            out = b.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [out.column(out.schema.get_field_index("id")), out.column(out.schema.get_field_index("host")),
                 out.column(out.schema.get_field_index("path")), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["id", "host", "path", "rule", "verdict"])
    return run


def judge(urls: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = ALLOW) -> DataFrame:
    """One row per row of ``urls``: the id, host, path, rule (host and path, or
    null) and verdict. ``rules``: host, path, verdict (allow or block)."""
    id_type = urls.schema[id_column].dataType
    u = urls.select(F.col(id_column).alias("id"), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))
    u = u.select("id", "host", "path", key_of(F.col("host")).alias("key"), F.xxhash64("id").alias("tie"))
    r = (rules.select(_small("host").alias("host"), "path", "verdict").where("host <> '' and path is not null and verdict is not null")
         .distinct().withColumn("key", key_of(F.col("host"))))

    total = u.count()
    n = max(1, min(MAX_RANGES, -(-total // ROWS_PER_RANGE)))
    drawn = []
    if n > 1:  # about KEYS_PER_RANGE shortened keys a range
        chance = F.pmod(F.xxhash64(F.lit("ranges"), "id", "key", "path"), F.lit(1 << 40)) / (1 << 40)
        drawn = sorted(map(_utf8, u.where(chance < KEYS_PER_RANGE * n / total)
                           .select(F.substring("key", 1, KEY_CHARS), F.substring("path", 1, KEY_CHARS), "tie").collect()))
    cuts = sorted({drawn[len(drawn) * i // n] for i in range(1, n)}) if drawn else []
    cut_keys = [c[0] for c in cuts]

    @F.pandas_udf("int")
    def range_of(key: pd.Series, path: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts, (k.encode()[:KEY_CHARS], p.encode()[:KEY_CHARS], t)) for k, p, t in zip(key, path, tie, strict=True)], dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_of(key: pd.Series, path: pd.Series) -> pd.Series:
        def met(k: str, p: str) -> list[int]:
            low, p8 = k.encode()[:KEY_CHARS], p.encode()[:KEY_CHARS]
            out = range(bisect_left(cut_keys, low), bisect_right(cut_keys, low + b"\xff") + 1)
            def apart(i: int) -> bool:  # the range holds this one host, and other paths
                if not 0 < i < len(cuts) or cuts[i - 1][0] != cuts[i][0] or len(cuts[i][0]) >= KEY_CHARS or cuts[i][0] != low:
                    return False
                return cuts[i][1] < p8 or cuts[i - 1][1] > p8 + b"\xff"
            return [i for i in out if not apart(i)]
        return pd.Series([met(k, p) for k, p in zip(key, path, strict=True)])

    sent = r.select(F.explode(ranges_of("key", "path")).alias("range"), "key", "path", F.lit(0).alias("kind"),
                    F.lit(None).cast(id_type).alias("id"), "host", "verdict")
    asked = u.select(range_of("key", "path", "tie").alias("range"), "key", "path", F.lit(1).alias("kind"), "id", "host",
                     F.lit(None).cast("string").alias("verdict"))
    # Rules of a key come before its urls; paths need no order, they are looked up.
    swept = (sent.unionByName(asked).repartition("range").sortWithinPartitions("range", "key", "kind")
             .select("range", "key", "path", "kind", "id", "host", "verdict"))
    schema = f"id {id_type.simpleString()}, host string, path string, rule string, verdict string"
    return swept.mapInArrow(_sweep(default), schema).withColumnRenamed("id", id_column)
