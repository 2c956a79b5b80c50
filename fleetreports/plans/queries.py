"""The job's queries, composed from operators. Each takes a report DataFrame
(active or not; the active filter is applied here, as in the source job) and
returns the structured result. Rendering to text is separate
(``functions.render``).

| query                  | result columns                                    |
| ---------------------- | ------------------------------------------------- |
| passthrough            | report columns                                    |
| north_reports          | report columns                                    |
| trains_last_stop       | id, linename, laststopid, lastupdate              |
| top_delayed            | id, linename, delay, lastupdate                   |
| top_delayed_current    | id, linename, delay, lastupdate                   |
| top_delayed_window     | window_start, id, linename, delay, lastupdate     |
| average_delay          | window_start, avg_delay                           |
| report_gap             | id, seq, lastupdate, avg_gap_s                    |
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetreports.defaults import AVG_MINUTES, GAP_REPORTS, TOP_N, TOP_WINDOW_MINUTES
from fleetreports.operators.aggregates import avg_delay
from fleetreports.operators.filters import active, delayed, north, trains
from fleetreports.operators.gap import avg_report_gap
from fleetreports.operators.latest import latest_per_key
from fleetreports.operators.topn import top_n, top_n_per_group
from fleetreports.operators.windows import duration, tumbling
from fleetreports.schema import TOP_COLUMNS, TRAIN_COLUMNS, WINDOW_TOP_COLUMNS



def passthrough(reports: DataFrame) -> DataFrame:
    """All active reports."""
    return active(reports)


def north_reports(reports: DataFrame) -> DataFrame:
    """Active reports of units heading north."""
    return north(active(reports))


def trains_last_stop(reports: DataFrame) -> DataFrame:
    """Every train seen, with its latest report's stop and time."""
    latest = latest_per_key(trains(active(reports)), ["id"], columns=["linename", "laststopid"])
    return latest.select(*TRAIN_COLUMNS)


def top_delayed(reports: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top ``n`` most delayed units since start, as deployed: reports with
    ``delay <= 0`` are dropped *before* the per-unit upsert, so a unit keeps
    its last positive delay."""
    latest = latest_per_key(delayed(active(reports)), ["id"], columns=["linename", "delay"])
    return top_n(latest, n).select(*TOP_COLUMNS)


def top_delayed_current(reports: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top ``n`` most delayed units by their *latest* report (as documented):
    upsert first, then keep units whose current delay is positive."""
    latest = latest_per_key(active(reports), ["id"], columns=["linename", "delay"])
    return top_n(delayed(latest), n).select(*TOP_COLUMNS)


def top_delayed_window(
    reports: DataFrame, minutes: float = TOP_WINDOW_MINUTES, n: int = TOP_N, ordered: bool = False
) -> DataFrame:
    """Per tumbling window of ``minutes``: the latest report of every delayed
    unit, top ``n`` by delay, listed oldest update first (ties: larger delay
    first).

    Each window's rows sit in one partition after the ranking, so the order
    within windows costs a local sort only; ``ordered=True`` adds a global
    sort over windows too (one more exchange)."""
    windowed = delayed(active(reports)).withColumn("window_start", tumbling(F.col("lastupdate"), minutes).start)
    latest = latest_per_key(windowed, ["window_start", "id"], columns=["linename", "delay"])
    top = top_n_per_group(latest, ["window_start"], n)
    within = ["window_start", "lastupdate", F.col("delay").desc(), "seq"]
    top = top.orderBy(*within) if ordered else top.sortWithinPartitions(*within)
    return top.withColumn("window_end", F.expr(f"window_start + INTERVAL {duration(minutes)}")).select(*WINDOW_TOP_COLUMNS)


def average_delay(reports: DataFrame, minutes: float = AVG_MINUTES) -> DataFrame:
    """Mean delay of all active reports per tumbling window of ``minutes``."""
    return avg_delay(active(reports), minutes)


def report_gap(reports: DataFrame, n: int = GAP_REPORTS, strategy: str = "auto") -> DataFrame:
    """After every report: mean seconds between the unit's last ``n`` reports.
    ``strategy``: ``auto``, ``window`` or ``distributed`` (see operators.gap)."""
    return avg_report_gap(active(reports), n, strategy=strategy)
