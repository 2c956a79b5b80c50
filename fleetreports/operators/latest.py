"""Latest report per key (the upsert at the heart of the snapshot queries).

"Latest" is the greatest ``(lastupdate, seq)``: the newest report, ties broken
by ingest order, so the answer is deterministic after any shuffle.

Two formulations, same result:

* ``rank`` (batch default): ``row_number() = 1`` over a window partitioned by
  the key. Spark plans it with a *partial* ``WindowGroupLimit`` before the
  exchange: each map task keeps one row per key, so a key that holds a third
  of all rows still ships at most one row per map task.
* ``aggregate`` (streams): ``max_by(struct(payload), struct(order))``, a
  two-phase aggregate with the same map-side reduction, and the form the
  streaming state store supports (row-number windows are not allowed on
  streams).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_ORDER = ("lastupdate", "seq")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    order: Sequence[str] = DEFAULT_ORDER,
    columns: Sequence[str] | None = None,
    method: str | None = None,
) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple.

    ``columns`` limits the payload carried through the shuffle (column
    pruning reaches the scan); by default every non-key column is kept.
    The order columns are always part of the output. ``method``: ``rank`` or
    ``aggregate``; by default ``aggregate`` on streams, ``rank`` otherwise.
    """
    keys = list(keys)
    order = list(order)
    if columns is None:
        payload = [c for c in df.columns if c not in keys]
    else:
        payload = [c for c in columns if c not in keys]
    for c in order:
        if c not in payload:
            payload.append(c)
    method = method or ("aggregate" if df.isStreaming else "rank")
    if method == "rank":
        q = lambda c: f"`{c}`"
        rank = (
            f"row_number() OVER (PARTITION BY {', '.join(map(q, keys))} "
            f"ORDER BY {', '.join(q(c) + ' DESC' for c in order)}) AS _latest_rank"
        )
        out = [*keys, *payload]
        return df.selectExpr(*map(q, out), rank).where("_latest_rank = 1").select(*out)
    if method == "aggregate":
        latest = F.max_by(F.struct(*payload), F.struct(*order)).alias("_latest")
        return df.groupBy(*keys).agg(latest).select(*keys, *[F.col("_latest")[c].alias(c) for c in payload])
    raise ValueError(f"unknown method {method!r}")
