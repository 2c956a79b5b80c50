"""Connected components of an edge list, by alternating star contractions.

Every round halves the longest chains or better; the edge list is written to
the shared folder each round, which cuts the lineage, and only one count comes
back to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetreports.llm.tables import dropped, stored


def _large_star(e: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of its neighbourhood."""
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(e: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of these."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _only_stars(e: DataFrame) -> bool:
    """Every larger node has one link, to a node that is no larger node itself."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest
    node that can be reached. Nulls and self-links are left out; repeated
    links count once; no link, no row."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _only_stars(now):
        new = stored(_small_star(_large_star(now)), "links")
        dropped(now)
        now = new
    out = now.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
    out = out.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
    done = stored(out, "components")
    dropped(now)
    return done
