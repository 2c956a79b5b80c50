"""Shards of near-equal bytes, by sampled splitters. DataFrame functions only.

Records are ordered by the hash of their text, then by doc_id, so equal texts
lie side by side. A record's size is its UTF-8 bytes plus 1.

1. About ``SAMPLES`` keys are drawn, each record with a chance in proportion to
   its size; quantiles of the sample are the splitters. Every splitter is a
   range of its own (a text with many copies is one), the keys between two
   splitters are another.
2. A range with over twice its share of the rows (or ``MOST_ROWS``) is
   subdivided: by equal stretches of the key, or, where it is a single key, by
   the hash of doc_id. So no window below holds a hot text's rows together.
3. Sizes are summed by subrange and carried on in order; with the running sums
   within a subrange every record knows the bytes before it. Its shard is the
   sixteenth (of all bytes) in which it lies.
4. Equal texts stay together: a group of at most ``WHOLE`` = 5 % of a shard goes
   as a whole to the shard of its middle, larger ones are cut record by record.
   Shards then differ from the mean by at most that much at either end.

Law: ``bytes``. Slots count a shard's records in this order from 0.

Defined cases: null text has size 1 and a null CRC; null doc_ids come first
among equal texts; repeated rows are separate records; more shards than records
leave shards empty; an input column with the name of a result column is
replaced; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetreports.llm.tables import stored

SHARDS, RANGES, SAMPLES, MOST_ROWS, WHOLE = 16, 128, 8192, 500_000, 0.05
RESULT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values]) if values else F.array().cast("array<bigint>")


def _range_of(key: Column, cuts: list[int]) -> Column:
    """2i + 1 for a key that is splitter i, 2i for one between splitters i - 1 and i."""
    below = F.size(F.filter(_longs(cuts), lambda c: c < key))
    return 2 * below + F.array_contains(_longs(cuts), key).cast("int")


def _subrange_of(key: Column, doc_id: Column, place: Column, cuts: list[int], parts: dict[int, int]) -> Column:
    """Order-keeping part of an overfull range, or, for a single key, any."""
    many = {r: k for r, k in parts.items() if k > 1}
    out = F.lit(0)
    for r, k in many.items():  # at most RANGES ranges are overfull
        if r % 2:
            part = F.pmod(F.xxhash64(doc_id), F.lit(k))
        else:
            lo = cuts[r // 2 - 1] if r else -(1 << 63)
            hi = cuts[r // 2] if r // 2 < len(cuts) else (1 << 63) - 1
            part = F.greatest(F.lit(0), F.least(F.lit(k - 1), F.floor((key.cast("double") - F.lit(float(lo))) * F.lit(k / (float(hi) - float(lo))))))
        out = F.when(place == r, part.cast("int")).otherwise(out)
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with size, text_crc32, law, shard, slot and
    grown_shard (null: the law is ``bytes``)."""
    docs = docs.drop(*RESULT)
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    text = F.col("text")
    keyed = docs.select(
        F.col("doc_id"), *(["text", *more] if more else []),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_key"))
    narrow = stored(keyed.select("doc_id", "size", "text_crc32", "_key"), "sizes")
    total = narrow.agg(F.sum("size").alias("size"), F.count("*").alias("n")).first()
    size, n = total["size"] or 1, max(1, total["n"])

    draw = F.pmod(F.xxhash64(F.lit("splitters"), "doc_id", "_key"), F.lit(1 << 40)) / (1 << 40)
    drawn = sorted(r[0] for r in narrow.where(draw < F.col("size") * (SAMPLES / size)).select("_key").collect())  # about SAMPLES
    cuts = sorted({drawn[len(drawn) * i // RANGES] for i in range(1, RANGES)}) if drawn else []

    fair = max(1, min(MOST_ROWS, 2 * n // RANGES))
    rows = narrow.groupBy(_range_of(F.col("_key"), cuts).alias("r")).count().collect()  # at most 2 RANGES rows
    parts = {r["r"]: -(-r["count"] // fair) for r in rows}

    def placed(records: DataFrame) -> DataFrame:
        records = records.withColumn("_range", _range_of(F.col("_key"), cuts))
        return records.withColumn("_sub", _subrange_of(F.col("_key"), F.col("doc_id"), F.col("_range"), cuts, parts))

    in_order = Window.orderBy("_range", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    sums = (placed(narrow).groupBy("_range", "_sub").agg(F.sum("size").alias("_s"), F.count("*").alias("_n"))
            .withColumn("_before", F.coalesce(F.sum("_s").over(in_order), F.lit(0)))
            .withColumn("_rows_before", F.coalesce(F.sum("_n").over(in_order), F.lit(0))).drop("_s", "_n"))

    def assigned(records: DataFrame) -> DataFrame:
        part = Window.partitionBy("_range", "_sub")
        by_row = part.orderBy("_key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
        group = Window.partitionBy("_range", "_sub", "_key")
        out = (placed(records).join(F.broadcast(sums), ["_range", "_sub"])  # a row a subrange: 2 RANGES + n / fair
               .withColumn("_upto", F.sum("size").over(by_row))
               .withColumn("_row", F.row_number().over(part.orderBy("_key", "doc_id")))
               .withColumn("_peers", F.sum("size").over(part.orderBy("_key")))
               .withColumn("_group", F.sum("size").over(group)))
        whole = F.col("_group") <= F.lit(WHOLE * size / shards)
        middle2 = 2 * F.col("_before") + F.when(whole, 2 * F.col("_peers") - F.col("_group")).otherwise(2 * F.col("_upto") - F.col("size"))
        return (out.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle2 * F.lit(shards) / F.lit(2 * size))).cast("int"))
                .withColumn("_at", F.col("_rows_before") + F.col("_row") - 1))

    begin = assigned(narrow).groupBy("shard").agg(F.min("_at").alias("_begin"))  # a row a shard
    source = assigned(keyed if more else narrow)
    return (source.join(F.broadcast(begin), "shard")
            .select("doc_id", *(["text", *more] if more else []), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_at") - F.col("_begin")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The records of ``docs`` under ``path``/shard=N/, in the order of their slots
    within each file."""
    out = shard(docs, shards)
    out.repartition("shard", F.floor(F.col("slot") / MOST_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


