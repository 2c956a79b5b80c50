"""Event-time tumbling windows on ``lastupdate``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration(minutes: float) -> str:
    if float(minutes).is_integer():
        return f"{int(minutes)} minutes"
    return f"{int(round(minutes * 60))} seconds"


def tumbling(ts: Column, minutes: float) -> Column:
    """Tumbling window struct (start, end) of width ``minutes``, aligned to
    the epoch, as the source job's windows are."""
    return F.window(ts, duration(minutes))
