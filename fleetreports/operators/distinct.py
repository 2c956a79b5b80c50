"""Reports that were delivered more than once.

Two reports are the same if all 16 fields of the message are equal, null-safe
(``operators.filters.same_report``); ``seq``, the place in the feed, does not count.
The first delivery stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetreports.schema import REPORT_COLUMNS

FIELDS = [c for c in REPORT_COLUMNS if c != "seq"]
WITHIN = "1 day"


def without_repeats(reports: DataFrame, within: str = WITHIN) -> DataFrame:
    """The reports, each once.

    Batch: the least ``seq`` per 16 fields, in a two-phase aggregate, so a report that a
    third of all rows repeat is one row per map task in the shuffle. Columns beside
    the report's go.

    Stream: ``dropDuplicatesWithinWatermark`` on arrival stamps: a repeat that arrives up
    to ``within`` after the first delivery is dropped, and the state holds the reports of
    that time. A message whose file is stamped more than ``within`` before the newest one
    cannot be told from a repeat and is dropped by the watermark."""
    if not reports.isStreaming:
        return reports.groupBy(*FIELDS).agg(F.min("seq").alias("seq")).select(*REPORT_COLUMNS)
    return reports.withWatermark("arrival", within).dropDuplicatesWithinWatermark(FIELDS)
