"""Sources mixed to target weights by Poisson replication. DataFrame functions only.

A source's repetition rate is its weight times the wanted bytes over the bytes
it has (UTF-8 plus 1 a document). Each document's count is a Poisson number with
that mean: a uniform number hashed from the seed, doc_id and text is looked up in
the source's cumulative distribution (rates over ``PART`` are sums of several
such numbers). A document is exploded by its count and all copies are shuffled
by a hash of seed, doc_id, text and copy.

A source with a rate over ``BLOCK`` holds less than a ``BLOCK``-th of the wanted bytes, so
its few rows are exploded in two steps: into blocks of ``BLOCK`` copies, which are dealt
to all tasks, and there into copies. One row never makes all its copies in one task.

The table of rates has one row a source; it is broadcast up to
``BROADCAST_SOURCES`` rows (the count is checked), else joined on source and a
salt, so a source with a third of all rows is spread either way.

Defined cases: a null source is a source of its own; sources without a weight
have weight 0 and go; null texts count 1 byte and stay candidates; rows with
equal doc_id and equal text get the same count, others (null or repeated ids with
unlike texts) draw apart; copies of rows without a doc_id are dealt by their place in
the input as well, so equal ones do not meet in one task; an input column named
``copy`` or ``mix_key`` is replaced, others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED, PART, BROADCAST_SOURCES, SALTS, BLOCK = "mix-1", 64, 100_000, 64, 4096


def hashed(*values: Column) -> Column:
    """52 bits of the MD5 of the values' text, colons between, as a bigint; null as empty."""
    texts = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, 13), 16, 10).cast("bigint")


def rates(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0) -> DataFrame:
    """(source, rate): the mean number of copies of a source's documents.
    ``weights``: (source, weight); without it every source weighs the same."""
    have = docs.groupBy("source").agg(F.sum((F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint")).alias("bytes"))
    if weights is None:
        have = have.withColumn("weight", F.lit(1.0))
    else:
        w = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double").alias("weight"))
        have = have.join(w, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    sums = have.agg(F.sum("bytes").cast("double").alias("bytes"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(sums["weight"] or 1.0)
    return have.select("source", (share * F.lit((sums["bytes"] or 0.0) * epochs) / F.col("bytes")).alias("rate"))


def _with_cdf(rate: DataFrame) -> DataFrame:
    """Adds parts and the cumulative distribution of a part's Poisson number."""
    start = F.struct(F.exp(-F.col("_mean")).alias("p"), F.exp(-F.col("_mean")).alias("c"), F.array(F.exp(-F.col("_mean"))).alias("cdf"))

    def step(s, k):
        p = s["p"] * F.col("_mean") / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["cdf"], F.array(s["c"] + p)).alias("cdf"))

    terms = F.ceil(F.col("_mean") + 12 * F.sqrt("_mean") + 20).cast("int")
    return (rate.withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
            .withColumn("_mean", F.col("rate") / F.col("_parts"))
            .withColumn("_cdf", F.aggregate(F.sequence(F.lit(1), terms), start, step)["cdf"]).drop("_mean", "rate"))


def mix(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: str = SEED, marks: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) mixed to the weights, with ``copy``
    (from 0) and ``mix_key``, the place in the global shuffle; without ``marks``
    the columns of ``docs`` only, all of them."""
    docs = docs.drop("copy", "mix_key") if marks else docs
    keep = docs.columns
    rate = rates(docs, weights, epochs)
    often = not rate.where(F.col("rate") > BLOCK).isEmpty()
    table = _with_cdf(rate)
    if docs.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        table = table.withColumnRenamed("source", "_source")
        joined = docs.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_source")))
    else:
        table = table.withColumnRenamed("source", "_source").withColumn("_salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = docs.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int"))
        joined = salted.join(table, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_salt2")))

    def drawn(part):
        u = hashed(F.lit(seed), F.col("doc_id"), F.col("_text"), part) / F.lit(float(1 << 52))
        return F.size(F.filter("_cdf", lambda c: c <= u))

    # Equal rows without a doc_id share mix_key; their place keeps them apart in the shuffle.
    joined = joined.withColumn("_text", F.md5("text")).withColumn(
        "_place", F.when(F.col("doc_id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).otherwise(F.lit(0)))
    draws = F.transform(F.sequence(F.lit(1), F.col("_parts")), drawn)
    counted = joined.withColumn("_copies", F.aggregate(draws, F.lit(0).cast("bigint"), lambda s, x: s + x)).where("_copies > 0")

    def exploded(rows, first, last):
        return (rows.withColumn("_copy", F.explode(F.sequence(first, last))).withColumn("_copy", F.col("_copy").cast("int"))
                .select(*keep, "_copy", "_place", hashed(F.lit(f"{seed}-place"), F.col("doc_id"), F.col("_text"), F.col("_copy")).alias("_mix_key")))

    zero, end = F.lit(0).cast("bigint"), F.col("_copies") - 1
    few = F.col("_parts") <= -(-BLOCK // PART)
    out = exploded(counted.where(few) if often else counted, zero, end)
    if often:
        blocks = (counted.where(~few).withColumn("_block", F.explode(F.sequence(zero, (end / BLOCK).cast("bigint"))))
                  .repartition("doc_id", "_text", "_block", "_place"))
        first = F.col("_block") * BLOCK
        out = out.unionByName(exploded(blocks, first, F.least(first + (BLOCK - 1), end)))
    out = out.repartition("_mix_key", "_place").sortWithinPartitions("_mix_key", "doc_id", "_copy")
    return out.select(*keep, F.col("_copy").alias("copy"), F.col("_mix_key").alias("mix_key")) if marks else out.select(*keep)
