"""Average time between a unit's recent reports (sliding count window).

After each report of a unit, the mean gap in seconds between consecutive
``lastupdate`` values among that unit's last ``n`` reports (at most ``n - 1``
gaps); 0.0 after the first report. One output row per input report.

The mean of consecutive differences telescopes: over the frame of the last
``k + 1`` reports it is ``(t_last - t_first) / k``. So each row only needs the
timestamp of the report ``k = min(n - 1, pos - 1)`` places before it, where
``pos`` is its 1-based position in the unit's ``(lastupdate, seq)`` order.
The arithmetic (integer milliseconds, then double division by ``k`` and by
1000) equals a fold over the frame exactly.

Skew: a plain ``Window.partitionBy("id")`` would send every report of a unit
through one task, and a single unit may hold a third of all rows. Instead
(halo exchange):

1. Range-partition by ``(id, lastupdate, seq)`` (sampled bounds split a hot
   unit over many partitions), sort within partitions and tag each row with
   ``monotonically_increasing_id`` (partition index in the high bits), so tags
   ascend in the order of the unit's reports. Written once as a table.
2. Of every ``(id, partition)`` only the last ``n - 1`` stamps are taken, and
   each partition is handed the last ``n - 1`` stamps that come before it (its
   halo): a table of at most ``(n - 1) * (#ids + #partitions)`` rows.
3. One window per ``(id, partition)`` over its own rows and its halo, whose size
   the range partitioning has bounded, does the rest as for a small unit.

The default ``auto`` strategy first counts reports per unit (a two-phase
aggregate) and sends only units above a row bound down this path; all other
units take one window per unit, whose size the count has just bounded.

Every step is a built-in DataFrame operator; nothing is capped or sampled away.
The ids of hot units come to the driver up to ``HOT_KEYS_BROADCAST`` of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetreports.defaults import GAP_REPORTS
from fleetreports.functions.coerce import epoch_ntz, ntz_to_millis
from fleetreports.session import materialize


_LOW_BITS = 33  # monotonically_increasing_id: row index bits within a partition


# Target rows per range partition of the skew-safe path.
RANGE_PARTITION_ROWS = 4_000_000
MAX_RANGE_PARTITIONS = 1 << 17


def range_partitions(df: DataFrame) -> int:
    """Number of range partitions: the session's shuffle partitions, or more
    where the counted rows would give partitions over the target."""
    base = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(min(max(base, -(-df.count() // RANGE_PARTITION_ROWS)), MAX_RANGE_PARTITIONS))


def _tagged(df: DataFrame, key: str, order: Sequence[str], num_partitions: int | None) -> DataFrame:
    """The rows range-partitioned by (key, order) with ``_tag``, which ascends in
    that order, and ``_part``, the partition. ``order`` must be a total order
    within a key (``seq`` makes it one).

    The rows are consumed twice, and a range exchange samples its bounds afresh
    each time it is planned, so they are written once as a table in the session's
    shared checkpoint folder (``session.materialize``): both consumers then see the
    same rows and tags, and the lineage is cut for recovery from lost executors.
    """
    sort_cols = [key, *order]
    ranged = (
        df.repartitionByRange(num_partitions or range_partitions(df), *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_tag", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(F.col("_tag"), _LOW_BITS))
    )
    return materialize(ranged, "positions")


def positions(
    df: DataFrame,
    key: str = "id",
    order: Sequence[str] = ("lastupdate", "seq"),
    num_partitions: int | None = None,
    pos_col: str = "pos",
) -> DataFrame:
    """Add the 1-based position of each row within its ``key`` in ``order``, which
    must be a total order within a key. No task ever holds all rows of a key: the
    number of the key's rows in earlier partitions is a running sum over one row
    per (key, partition), joined back."""
    tagged = _tagged(df, key, order, num_partitions)
    runs = tagged.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_tag").alias("_first"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(key, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        tagged.join(offsets, [key, "_part"])
        .withColumn(pos_col, F.col("_before") + (F.col("_tag") - F.col("_first")) + F.lit(1))
        .drop("_tag", "_part", "_first", "_before")
    )


def _halo(tagged: DataFrame, n: int, key: str) -> DataFrame:
    """``key, _part, _tag, _ms``: for each partition of a unit the last ``n - 1``
    rows of the unit before it. An earlier partition holds at least one row of
    the unit, so ``n - 1`` partitions back are enough."""
    newest = Window.partitionBy(key, "_part").orderBy(F.col("_tag").desc())
    tails = (
        tagged.select(key, "_part", "_tag", "_ms", F.row_number().over(newest).alias("_back"))
        .filter(F.col("_back") < n)
        .groupBy(key, "_part")
        .agg(F.sort_array(F.collect_list(F.struct("_tag", "_ms"))).alias("_tail"))
    )
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(1 - n, -1)
    earlier = tails.select(key, "_part", F.flatten(F.collect_list("_tail").over(before)).alias("_rows"))
    first = F.greatest(F.size("_rows") - F.lit(n - 2), F.lit(1))
    return earlier.select(key, "_part", F.explode(F.slice("_rows", first, F.lit(n - 1))).alias("_row")).select(
        key, "_part", "_row._tag", "_row._ms"
    )


NO_STAMP = "no_stamp"


def without_stamp(reports: DataFrame, key: str = "id") -> DataFrame:
    """The reports that the gap leaves out, with the reason: ``key, seq,
    lastupdate, reason``. Together with the gap's rows they are all reports."""
    left_out = F.col("lastupdate").isNull() | (F.col("lastupdate") <= epoch_ntz())
    return reports.filter(left_out).select(key, "seq", "lastupdate", F.lit(NO_STAMP).alias("reason"))


def _stamped(reports: DataFrame, key: str) -> DataFrame:
    return reports.filter(F.col("lastupdate") > epoch_ntz()).select(
        key, "seq", "lastupdate", ntz_to_millis(F.col("lastupdate")).alias("_ms")
    )


def _gap_distributed(base: DataFrame, n: int, key: str, num_partitions: int | None) -> DataFrame:
    rows = _tagged(base, key, ("lastupdate", "seq"), num_partitions).withColumn("_own", F.lit(True))
    if n > 1:
        halo = _halo(rows, n, key).withColumn("_own", F.lit(False))
        rows = rows.unionByName(halo, allowMissingColumns=True)
    return _gaps(rows, n, key, [key, "_part"], ["_tag"], "_own")


def _gap_window(base: DataFrame, n: int, key: str) -> DataFrame:
    return _gaps(base, n, key, [key], ["lastupdate", "seq"])


def _gaps(base: DataFrame, n: int, key: str, groups: Sequence[str], order: Sequence[str], own: str | None = None) -> DataFrame:
    """One window per group; rows where ``own`` is false only serve as earlier rows."""
    # O(1) per row: position, the stamp n-1 rows back (lag), and the unit's
    # first stamp for the first n-1 rows - no sliding-frame re-aggregation.
    w = Window.partitionBy(*groups).orderBy(*order)
    pos = F.row_number().over(w)
    back = F.lag("_ms", n - 1).over(w) if n > 1 else F.col("_ms")
    first = F.first("_ms").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = base.select(
        key, "seq", "lastupdate", "_ms", *([own] if own else []),
        pos.alias("_pos"), F.coalesce(back, first).alias("_base_ms"),
    )
    out = out.filter(own) if own else out
    k = F.least(F.col("_pos") - F.lit(1), F.lit(n - 1)).cast("double")
    gap = F.when(k == 0, F.lit(0.0)).otherwise(
        (F.col("_ms") - F.col("_base_ms")).cast("double") / k / F.lit(1000.0)
    )
    return out.select(key, "seq", "lastupdate", gap.alias("avg_gap_s"))


# A unit with more reports than this is "hot": its reports take the
# distributed path. A per-unit window task of this many narrow rows (about
# 40 bytes each) stays well inside one executor's memory.
HOT_KEY_ROWS = 2_000_000
# Hot-unit lists up to this many ids are broadcast to split the input;
# beyond it the split is a shuffled semi/anti join.
HOT_KEYS_BROADCAST = 200_000


def avg_report_gap(
    reports: DataFrame,
    n: int = GAP_REPORTS,
    key: str = "id",
    strategy: str = "auto",
    hot_key_rows: int = HOT_KEY_ROWS,
    num_partitions: int | None = None,
) -> DataFrame:
    """``id, seq, lastupdate, avg_gap_s`` for every report with a real stamp.

    ``strategy``:
      ``auto``        count reports per unit (two-phase aggregate): units
                      above ``hot_key_rows`` go the distributed way, the
                      rest through one window per unit, whose size the
                      count has just bounded. The source is read for the
                      counts and for the result; if there are hot units,
                      once more for their rows (written as a table).
      ``distributed`` every unit through the skew-safe path.
      ``window``      every unit through one window task (only for inputs
                      whose units are known to be small).

    Reports without a time stamp (epoch 0, i.e. ``lastupdate`` missing in the
    message) are left out: the source's fold restarts on them, which no
    position-based definition reproduces.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    base = _stamped(reports, key)
    if strategy == "window":
        return _gap_window(base, n, key)
    if strategy == "distributed":
        return _gap_distributed(base, n, key, num_partitions)
    if strategy != "auto":
        raise ValueError(f"unknown strategy {strategy!r}")

    # One pass gives the hot units; a table is written only if they are too many to list.
    counts = base.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_key_rows).select(key)
    listed = counts.limit(HOT_KEYS_BROADCAST + 1).collect()
    if not listed:
        return _gap_window(base, n, key)
    if len(listed) <= HOT_KEYS_BROADCAST:
        hot = F.broadcast(base.sparkSession.createDataFrame(listed, counts.schema))
    else:
        hot = materialize(counts, "hot-units")
    cold = _gap_window(base.join(hot, key, "left_anti"), n, key)
    heavy = _gap_distributed(materialize(base.join(hot, key, "left_semi"), "hot-rows"), n, key, num_partitions)
    return cold.unionByName(heavy)


def avg_report_gap_window(reports: DataFrame, n: int = GAP_REPORTS, key: str = "id") -> DataFrame:
    """Same result through one ``Window`` per unit (ROWS n-1 PRECEDING)."""
    return avg_report_gap(reports, n, key, strategy="window")
