"""Replay of reports through the streaming forms.

A bounded table of reports is played as the feed: its messages are written as JSON
files, one folder of files per slice of time, and the streaming query runs over them
with ``availableNow``, once for each slice, resuming from its checkpoint each time.
Files, checkpoint and result are tables below the shared checkpoint folder. So state,
watermark and restarts work as on a live feed, and the result can be held against the
batch form of the same query.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetreports.defaults import AVG_MINUTES, GAP_REPORTS, TOP_N, TOP_WINDOW_MINUTES
from fleetreports.functions.coerce import ntz_to_micros
from fleetreports.operators.distinct import without_repeats
from fleetreports.operators.latest import latest_per_key
from fleetreports.session import checkpoint_root
from fleetreports.sources.feed import parse_messages, read_feed_stream, to_messages
from fleetreports.streaming import incremental_top, sinks
from fleetreports.streaming import queries as sq

SLICES = 3
PARTITIONS_CONF = "spark.sql.shuffle.partitions"
STATE_BYTES = 16 << 20  # of the feed for each state partition, up to the session's number

# (streaming reports, sink of its micro-batches, checkpoint, trigger) -> started query
Start = Callable[[DataFrame, Callable[[DataFrame, int], None], str, dict], StreamingQuery]


def time_slices(reports: DataFrame, slices: int = SLICES) -> list[DataFrame]:
    """The reports in ``slices`` ranges of ``lastupdate``, in order, about equal in
    number. The bounds are approximate quantiles; every report is in one slice (those
    without a stamp in the last)."""
    at = ntz_to_micros(F.col("lastupdate"))
    cuts = reports.agg(F.percentile_approx(at, [k / slices for k in range(1, slices)])).first()[0] if slices > 1 else []
    out, low = [], None
    for high in [*sorted(set(cuts or [])), None]:
        mine = F.lit(True) if low is None else at > low
        out.append(reports.filter(mine | at.isNull() if high is None else mine & (at <= high)))
        low = high
    return out


def _bytes(spark, path: str) -> int:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def _reports(feed: DataFrame, numbered: bool) -> DataFrame:
    """The feed's reports. ``numbered``: with the ``seq`` that the messages bring as their
    ``rsvp_id`` (those without one: the order of arrival)."""
    got = parse_messages(feed, with_lineage=numbered).reports
    if numbered:
        got = got.withColumn("seq", F.coalesce(F.expr("try_cast(rsvp_id AS bigint)"), "seq")).drop("rsvp_id", "payload_hash")
    return got


def replay(reports: DataFrame, start: Start, slices: int = SLICES, closing: DataFrame | None = None, keep: str = "append",
           numbered: bool = False) -> DataFrame:
    """Result table of a streaming query over the reports, slice by slice.
    ``closing``: reports that come last, to move the watermark past all windows.
    ``keep``: ``append`` (all micro-batches' rows) or ``last`` (the last snapshot).
    ``numbered``: ties go by the reports' own ``seq``, not by the order of arrival."""
    spark = reports.sparkSession
    base = os.path.join(checkpoint_root(spark), "replays", uuid.uuid4().hex)
    feed, out = f"{base}/feed", f"{base}/out"
    parts = time_slices(reports, slices) + ([closing] if closing is not None else [])
    written: list[int] = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        written.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    session_partitions = spark.conf.get(PARTITIONS_CONF)
    for k, part in enumerate(parts):
        to_messages(part, numbered).write.text(f"{feed}/slice={k}")
        stream = _reports(read_feed_stream(spark, f"{feed}/*"), numbered)
        if not k:  # the first start fixes the number of state partitions
            state_partitions = min(int(session_partitions), -(-_bytes(spark, feed) * slices // STATE_BYTES) + 1)
        spark.conf.set(PARTITIONS_CONF, str(state_partitions))
        try:
            query = start(stream, sink, f"{base}/checkpoint", {"availableNow": True})
        finally:
            spark.conf.set(PARTITIONS_CONF, session_partitions)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    schema = spark.read.parquet(f"{out}/batch={written[-1]}").schema
    if keep == "last":
        return spark.read.schema(schema).parquet(f"{out}/batch={max(written)}")
    return spark.read.schema(schema).parquet(*[f"{out}/batch={b}" for b in sorted(set(written))])


def _closing(reports: DataFrame) -> DataFrame:
    """One active, delayed report long after all others: windows before it close."""
    last = reports.orderBy(F.col("lastupdate").desc_nulls_last()).limit(1)
    return last.withColumns({"id": F.lit("closing"), "isinactive": F.lit("false"), "delay": F.lit(1.0),
                             "lastupdate": F.expr("lastupdate + INTERVAL 10 YEARS")})


def _started(df: DataFrame, mode: str, sink, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(sink).start()


def average_delay(reports: DataFrame, minutes: float = AVG_MINUTES) -> DataFrame:
    """``streaming.queries.average_delay_stream`` over the reports, all windows closed."""
    def start(stream, sink, checkpoint, trigger):
        return sinks.start_average_delay(stream, lambda df, mode: _started(df, mode, sink, checkpoint, trigger), minutes)

    return replay(reports, start, closing=_closing(reports))


def top_delayed_window(reports: DataFrame, minutes: float = TOP_WINDOW_MINUTES, n: int = TOP_N) -> DataFrame:
    """``streaming.sinks.start_top_delayed_window`` over the reports, all windows closed."""
    def start(stream, sink, checkpoint, trigger):
        return sinks.start_top_delayed_window(stream, sink, f"replay-{uuid.uuid4().hex}", minutes, n, checkpoint, trigger)

    return replay(reports, start, closing=_closing(reports))


def trains_last_stop(reports: DataFrame) -> DataFrame:
    """The last snapshot of ``streaming.queries.trains_last_stop_stream``."""
    def start(stream, sink, checkpoint, trigger):
        return _started(*sq.trains_last_stop_stream(stream), sink, checkpoint, trigger)

    return replay(reports, start, keep="last")


def trains_changes(reports: DataFrame) -> DataFrame:
    """The changes of ``streaming.queries.trains_changes_stream``, applied in order: the
    last change of every train."""
    def start(stream, sink, checkpoint, trigger):
        def numbered(batch, batch_id):
            sink(batch.withColumn("_change", F.lit(batch_id).cast("bigint")), batch_id)

        return _started(*sq.trains_changes_stream(stream), numbered, checkpoint, trigger)

    changes = replay(reports, start)
    return latest_per_key(changes, ["id"], order=["_change"]).drop("_change")


def top_delayed(reports: DataFrame, n: int = TOP_N, current: bool = False) -> DataFrame:
    """The last ranking of ``streaming.incremental_top.start_top``; equal delays and stamps by ``seq``."""
    def start(stream, sink, checkpoint, trigger):
        return incremental_top.start_top(stream, sink, f"replay-{uuid.uuid4().hex}", n, current, checkpoint, trigger)

    return replay(reports, start, keep="last", numbered=True)


def report_gap(reports: DataFrame, n: int = GAP_REPORTS) -> DataFrame:
    """``streaming.queries.report_gap_stream`` over the reports."""
    def start(stream, sink, checkpoint, trigger):
        return _started(*sq.report_gap_stream(stream, n), sink, checkpoint, trigger)

    return replay(reports, start)


def repeats_dropped(reports: DataFrame) -> DataFrame:
    """``operators.without_repeats`` on the feed of the reports."""
    def start(stream, sink, checkpoint, trigger):
        return _started(without_repeats(stream), "append", sink, checkpoint, trigger)

    return replay(reports, start)
