"""Windowed global aggregate: mean delay per event-time window.

Every report counts (delays of any sign), so a unit that reports more often
weighs more; windows without reports emit nothing. ``avg`` is a two-phase
aggregate (partial sum/count per task, then final), so a crowded window costs
one partial row per map task, not one task holding the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetreports.defaults import AVG_MINUTES
from fleetreports.operators.windows import tumbling



def avg_delay(reports: DataFrame, minutes: float = AVG_MINUTES, ts: str = "lastupdate") -> DataFrame:
    """``window_start, window_end, avg_delay`` per tumbling window of ``minutes``."""
    return (
        reports.groupBy(tumbling(F.col(ts), minutes).alias("w"))
        .agg(F.avg("delay").alias("avg_delay"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "avg_delay")
    )
