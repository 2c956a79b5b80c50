"""Sinks and query starters.

* append results (reports, averages, gaps): a text sink (rendered lines in
  rolling part files, rolled per trigger and ``maxRecordsPerFile``) or any
  file/console/memory format;
* snapshot results (complete mode): ``foreachBatch`` writing one folder per
  batch id with overwrite, so a retried batch replaces its own output
  (file sinks refuse complete mode);
* the windowed top-N: stage-one rows through ``foreachBatch`` into the batch
  top-N step.

Checkpoints default to the session's shared checkpoint folder.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fleetreports.defaults import AVG_MINUTES, FILE_ROLL_INTERVAL, SNAPSHOT_INTERVAL, TOP_N, TOP_WINDOW_MINUTES
from fleetreports.functions.render import render
from fleetreports.schema import STAGED_SCHEMA
from fleetreports.session import stream_checkpoint
from fleetreports.sources.feed import Ingested, parsed_messages, split_parsed
from fleetreports.streaming import queries as sq

MAX_RECORDS_PER_FILE = 200_000


def _writer(df: DataFrame, mode: str, name: str, checkpoint: str | None, trigger: dict | None):
    w = df.writeStream.outputMode(mode).queryName(name)
    w = w.option("checkpointLocation", stream_checkpoint(df.sparkSession, name, checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w


def start_memory(df: DataFrame, mode: str, name: str, checkpoint: str | None = None,
                 trigger: dict | None = None) -> StreamingQuery:
    return _writer(df, mode, name, checkpoint, trigger).format("memory").start()


def start_console(df: DataFrame, mode: str, name: str, checkpoint: str | None = None,
                  trigger: dict | None = None, rows: int = 20) -> StreamingQuery:
    """A preview: the first ``rows`` rows of each micro-batch on the driver's
    console. For all rows use a file sink."""
    writer = _writer(df, mode, name, checkpoint, trigger).format("console")
    return writer.option("truncate", "false").option("numRows", int(rows)).start()


def start_text(df: DataFrame, kind: str, path: str, name: str, checkpoint: str | None = None,
               trigger: dict | None = None) -> StreamingQuery:
    """Rendered lines of an append-mode result into rolling text part files."""
    trigger = trigger or {"processingTime": FILE_ROLL_INTERVAL}
    return (
        _writer(render(df, kind), "append", name, checkpoint, trigger)
        .format("text")
        .option("path", path)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .start()
    )


def snapshot_writer(path: str, kind: str | None = None, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing each snapshot to ``path/batch=<id>``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = render(batch, kind) if kind else batch
        target = os.path.join(path, f"batch={batch_id}")
        (out.write.mode("overwrite").format("text" if kind else fmt).save(target))

    return write


def start_snapshot(df: DataFrame, mode: str, path: str, name: str, kind: str | None = None,
                   checkpoint: str | None = None, trigger: dict | None = None,
                   fmt: str = "parquet") -> StreamingQuery:
    trigger = trigger or {"processingTime": SNAPSHOT_INTERVAL}
    return _writer(df, mode, name, checkpoint, trigger).foreachBatch(snapshot_writer(path, kind, fmt)).start()


def start_top_delayed_window(reports: DataFrame, sink: Callable[[DataFrame, int], None], name: str,
                             minutes: float = TOP_WINDOW_MINUTES, n: int = TOP_N,
                             checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Windowed top-N on a stream: closed windows' latest rows per unit arrive
    whole in one micro-batch; the batch top-N step ranks them and hands the
    result to ``sink(df, batch_id)``."""
    latest, mode = sq.window_latest_stream(reports, minutes)

    def step(batch: DataFrame, batch_id: int) -> None:
        sink(sq.top_of_closed_windows(batch, n), batch_id)

    return _writer(latest, mode, name, checkpoint, trigger).foreachBatch(step).start()


def start_average_delay(reports: DataFrame, start: Callable[[DataFrame, str], StreamingQuery],
                        minutes: float = AVG_MINUTES) -> StreamingQuery:
    """Start the windowed average with late rows dropped as in the source job
    (one stateful operator: the late filter uses the current watermark).
    The session setting is restored once the query has started."""
    spark = reports.sparkSession
    df, mode = sq.average_delay_stream(reports, minutes)
    old = spark.conf.get(sq.ALLOW_MULTIPLE_CONF, "true")
    spark.conf.set(sq.ALLOW_MULTIPLE_CONF, "false")
    try:
        return start(df, mode)
    finally:
        spark.conf.set(sq.ALLOW_MULTIPLE_CONF, old)


def start_top_delayed_window_live(reports: DataFrame, sink: Callable[[DataFrame, int], None], name: str,
                                  minutes: float = TOP_WINDOW_MINUTES, n: int = TOP_N,
                                  checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Windowed top-N over arrival time: every message belongs to the window of
    its arrival stamp, and a window is ranked once a later arrival has closed
    it. How many micro-batches a window comes in makes no difference. A file that is
    read after a later one has closed its window is dropped by the watermark, and the
    last window waits for an arrival: ``clock_windows`` (the job's form) has neither
    fault."""
    latest, mode = sq.window_latest_stream(reports, minutes, arrival=True)
    trigger = trigger or {"processingTime": FILE_ROLL_INTERVAL}

    def step(batch: DataFrame, batch_id: int) -> None:
        sink(sq.top_of_closed_windows(batch, n), batch_id)

    return _writer(latest, mode, name, checkpoint, trigger).foreachBatch(step).start()


def text_batch_sink(path: str, kind: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink for ranked windows: rendered lines into
    ``path/batch=<id>`` (overwrite: a retried batch replaces its output)."""

    def write(df: DataFrame, batch_id: int) -> None:
        render(df, kind).write.mode("overwrite").text(os.path.join(path, f"batch={batch_id}"))

    return write


def start_staging(raw: DataFrame, path: str, name: str, checkpoint: str | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Parse the landing stream once into a parquet table at ``path`` (file
    sink: exactly-once through its commit log). Downstream queries stream
    from the table with ``read_staged`` instead of parsing the JSON again."""
    trigger = trigger or {"processingTime": FILE_ROLL_INTERVAL}
    writer = _writer(parsed_messages(raw), "append", name, checkpoint, trigger)
    return writer.format("parquet").option("path", path).start()


def read_staged(spark, path: str, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int | None = None) -> Ingested:
    """Stream of a staged table (schema fixed, no inference), split into
    reports and quarantine; micro-batches are bounded as those of the feed."""
    reader = spark.readStream.schema(STAGED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return split_parsed(reader.parquet(path))
