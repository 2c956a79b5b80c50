"""Windows of wall-clock time that close by the clock.

A message belongs to the window of its arrival stamp (its file's time stamp, the
same on every replay). Two steps:

1. *Closed rows*: keyed state (``transformWithState``) holds each unit's latest
   delayed report per open window, with a processing-time timer at the window's end.
   When the timer fires, the unit's rows of windows that are over come out and leave
   the state. Nothing has to arrive for that: Spark runs micro-batches for due timers
   on a quiet feed. All timers of a window fire in the same micro-batch, whatever the
   unit.
2. *Ranking*: closed rows are appended to a table, one folder per window, and every
   window that got rows is ranked again over all its rows in the table: the latest
   row per unit, the top N by delay. The result goes to the sink whole, with the number
   of rankings the window had before as ``revision``.

A message that is read when its window has been emitted already (a file stamped
earlier, a backlog, another collector's clock) is due at once: it comes out in the
next micro-batch, and its window is emitted again with the next revision. So no
report is lost, and the last revision of every window does not depend on how the
files were cut into micro-batches. A retried micro-batch replaces its own rows in the
table, and its own result if the sink overwrites by batch id.

State: units x open windows. The ranking reads the touched windows' folders only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fleetreports.defaults import FILE_ROLL_INTERVAL, TOP_N, TOP_WINDOW_MINUTES
from fleetreports.functions.coerce import instant_to_ntz, ntz_to_micros
from fleetreports.operators.filters import active, delayed
from fleetreports.operators.latest import latest_per_key
from fleetreports.operators.topn import top_n_per_group
from fleetreports.operators.windows import duration
from fleetreports.schema import WINDOW_TOP_COLUMNS
from fleetreports.session import stream_checkpoint

# Times travel as microseconds since the epoch; the last two columns of a closed row.
_STATE = "linename string, delay double, lastupdate_us bigint, seq bigint"
CLOSED_DDL = f"id string, {_STATE}, start_us bigint, end_us bigint"
_TABLE_DDL = f"{CLOSED_DDL}, batch bigint"


class LatestUntilClosed(StatefulProcessor):
    """A unit's latest report in each open window; emitted at the window's end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getMapState("latest", "start_us bigint, end_us bigint", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for chunk in rows:  # one row per window is kept of each chunk, so a hot unit is never held whole
            last = chunk.sort_values(["lastupdate_us", "seq"], kind="stable").drop_duplicates(["start_us", "end_us"], keep="last")
            for r in last.itertuples(index=False):
                window = (int(r.start_us), int(r.end_us))
                new = (r.linename, float(r.delay), int(r.lastupdate_us), int(r.seq))
                old = self.latest.getValue(window) if self.latest.containsKey(window) else None
                if old is None or tuple(old[2:]) <= new[2:]:
                    self.latest.updateValue(window, new)
                self.handle.registerTimer(max(window[1] // 1000, now + 1))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        over = [(tuple(w), tuple(v)) for w, v in self.latest.iterator() if w[1] // 1000 <= due]
        for window, _ in over:
            self.latest.removeKey(window)
        if over:
            yield pd.DataFrame([(key[0], *value, *window) for window, value in over],
                               columns=["id", "linename", "delay", "lastupdate_us", "seq", "start_us", "end_us"])

    def close(self) -> None:
        pass


def closed_rows_stream(reports: DataFrame, minutes: float = TOP_WINDOW_MINUTES) -> tuple[DataFrame, str]:
    """Each unit's latest delayed report per arrival window, once the window is over."""
    w = F.window("arrival", duration(minutes))
    rows = delayed(active(reports)).select(
        "id", "linename", "delay", ntz_to_micros(F.col("lastupdate")).alias("lastupdate_us"),
        "seq", F.unix_micros(w["start"]).alias("start_us"), F.unix_micros(w["end"]).alias("end_us"))
    out = rows.groupBy("id").transformWithStateInPandas(
        statefulProcessor=LatestUntilClosed(), outputStructType=CLOSED_DDL, outputMode="append", timeMode="processingTime")
    return out, "append"


def _with_times(rows: DataFrame) -> DataFrame:
    at = lambda c: instant_to_ntz(F.timestamp_micros(c))
    return rows.withColumns({"window_start": at("start_us"), "window_end": at("end_us"), "lastupdate": at("lastupdate_us")})


def rank_windows(closed: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top ``n`` of every window of a table of closed rows (each window whole),
    oldest update first, with the window's ``revision`` (0: the first ranking)."""
    latest = latest_per_key(closed, ["start_us", "end_us", "id"], order=["lastupdate_us", "seq"], columns=["linename", "delay"])
    top = top_n_per_group(_with_times(latest), ["window_start", "window_end"], n)
    # one row per (window, micro-batch) that brought rows: small
    revision = closed.groupBy("start_us").agg((F.count_distinct("batch") - 1).alias("revision"))
    return (top.join(revision, "start_us").select(*WINDOW_TOP_COLUMNS, "revision", "seq")
            .orderBy("window_start", "lastupdate", F.col("delay").desc(), "seq").drop("seq"))


# Up to so many touched windows are read by their folders; beyond, by a semi-join.
FOLDERS = 1000


def read_closed(spark: SparkSession, table: str, starts: list[int] | None = None) -> DataFrame:
    """The table of closed rows: whole, or the windows with these starts."""
    if starts is None:
        return spark.read.schema(_TABLE_DDL).option("basePath", table).parquet(table)
    folders = [f"{table}/start_us={s}" for s in starts]
    return spark.read.schema(_TABLE_DDL).option("basePath", table).parquet(*folders)


def append_and_rank(batch: DataFrame, batch_id: int, table: str, n: int = TOP_N) -> DataFrame | None:
    """Append a micro-batch of closed rows to the table and rank the windows it
    touched; None if there was no row."""
    spark = batch.sparkSession
    (batch.withColumn("batch", F.lit(batch_id).cast("bigint")).hint("rebalance", "start_us")  # few files a window, large windows split
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("start_us", "batch").parquet(table))
    mine = batch.select("start_us").distinct()
    starts = [r[0] for r in mine.limit(FOLDERS + 1).collect()]
    if not starts:
        return None
    if len(starts) <= FOLDERS:
        return rank_windows(read_closed(spark, table, starts), n)
    return rank_windows(read_closed(spark, table).join(mine, "start_us", "left_semi"), n)


def start_clock_windows(reports: DataFrame, sink: Callable[[DataFrame, int], None], name: str, table: str | None = None,
                        minutes: float = TOP_WINDOW_MINUTES, n: int = TOP_N, checkpoint: str | None = None,
                        trigger: dict | None = None) -> StreamingQuery:
    """Windowed top-N of arrival time, closed by the clock. ``sink(df, batch_id)``
    gets the touched windows whole, with their revision. ``table`` (default: beside
    the checkpoint) keeps the closed rows."""
    rows, mode = closed_rows_stream(reports, minutes)
    checkpoint = stream_checkpoint(reports.sparkSession, name, checkpoint)
    table = table or f"{checkpoint}-closed"

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # a micro-batch's closed rows, used twice
        try:
            ranked = append_and_rank(batch, batch_id, table, n)
            if ranked is not None:
                sink(ranked, batch_id)
        finally:
            batch.unpersist()

    writer = rows.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": FILE_ROLL_INTERVAL})).foreachBatch(step).start()
