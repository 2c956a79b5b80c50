"""Top-N rankings: globally and per group (per time window).

Both rank by ``delay`` descending; equal delays keep arrival order of the
latest report, i.e. ``(lastupdate, seq)`` ascending, which is what a stable
sort over an upsert list in arrival order gives.

Plans: the global form is ``TakeOrderedAndProject`` (each task keeps its own
top N, one task merges N x tasks rows). The per-group form is ``row_number()
<= N`` over a window partitioned by the group, which Spark plans with a
partial ``WindowGroupLimit`` before the exchange, so at most N rows per group
per map task are shuffled, however hot a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetreports.defaults import TOP_N



def delay_rank_order() -> list[Column]:
    return [F.col("delay").desc(), F.col("lastupdate").asc(), F.col("seq").asc(), F.col("id").asc()]


def top_n(df: DataFrame, n: int = TOP_N, order: Sequence[Column] | None = None) -> DataFrame:
    """Global top ``n`` rows by ``order`` (default: most delayed first)."""
    order = list(order) if order is not None else delay_rank_order()
    return df.orderBy(*order).limit(n)


def top_n_per_group(
    df: DataFrame,
    groups: Sequence[str],
    n: int = TOP_N,
    order: Sequence[Column] | None = None,
    rank_col: str = "_rank",
    keep_rank: bool = False,
) -> DataFrame:
    """Top ``n`` rows of every group by ``order`` (default: most delayed)."""
    order = list(order) if order is not None else delay_rank_order()
    w = Window.partitionBy(*groups).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
    return ranked if keep_rank else ranked.drop(rank_col)
