"""Streaming forms of the job's queries.

Each function takes a *streaming* report DataFrame (see
``fleetreports.sources.read_feed_stream`` + ``parse_messages``) and returns a
streaming DataFrame plus the output mode it needs. Event time is
``lastupdate``; Spark's watermark needs an instant, so a zone-free
``event_time`` instant is derived from it and results are converted back.

| query                 | form                                             | mode     |
| --------------------- | ------------------------------------------------ | -------- |
| passthrough, north    | stateless filter                                 | append   |
| average_delay         | watermark 0 s + tumbling window + avg            | append   |
| trains_last_stop      | latest per id in state (max_by)                  | complete |
| trains_changes        | latest per id in state, changed units only       | update   |
| top_delayed(_current) | latest per id in state, then sort + limit; the   | complete |
|                       | job runs ``incremental_top``: changed units only |          |
| top_delayed_window    | latest per (window, id) in state, append once    | append   |
|                       | the window closes, top N per window in           |          |
|                       | ``foreachBatch`` (``start_top_delayed_window``)  |          |
| report_gap            | keyed state of the last n-1 stamps per unit      | append   |
|                       | (``applyInPandasWithState``)                     |          |

State is bounded: O(units) for the snapshots, O(units x open windows) for
the windowed forms, O(units x n) for the gap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetreports.functions.coerce import epoch_ntz, instant_to_ntz, ntz_to_instant, ntz_to_micros
from fleetreports.defaults import AVG_MINUTES, GAP_REPORTS, TOP_N, TOP_WINDOW_MINUTES, WATERMARK_DELAY
from fleetreports.operators.filters import active, delayed, north
from fleetreports.operators.latest import latest_per_key
from fleetreports.operators.topn import top_n, top_n_per_group
from fleetreports.operators.windows import duration
from fleetreports.plans.queries import trains_last_stop
from fleetreports.schema import TOP_COLUMNS, WINDOW_TOP_COLUMNS

EVENT_TIME = "event_time"
# In Spark, a row one micro-batch late still reaches a window when several
# stateful operators are allowed; the source job drops it. The average query
# is a single stateful operator, so it starts with this set to false.
ALLOW_MULTIPLE_CONF = "spark.sql.streaming.statefulOperator.allowMultiple"


def with_event_time(reports: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    return reports.withColumn(EVENT_TIME, ntz_to_instant(F.col("lastupdate"))).withWatermark(EVENT_TIME, delay)


def passthrough_stream(reports: DataFrame) -> tuple[DataFrame, str]:
    return active(reports), "append"


def north_stream(reports: DataFrame) -> tuple[DataFrame, str]:
    return north(active(reports)), "append"


def average_delay_stream(reports: DataFrame, minutes: float = AVG_MINUTES) -> tuple[DataFrame, str]:
    """Mean delay per event-time window, emitted once the watermark passes the
    window end; rows behind the watermark are dropped."""
    out = (
        with_event_time(active(reports))
        .groupBy(F.window(EVENT_TIME, duration(minutes)).alias("w"))
        .agg(F.avg("delay").alias("avg_delay"))
        .select(instant_to_ntz(F.col("w.start")).alias("window_start"), instant_to_ntz(F.col("w.end")).alias("window_end"), "avg_delay")
    )
    return out, "append"


def trains_last_stop_stream(reports: DataFrame) -> tuple[DataFrame, str]:
    """Every train seen, re-emitted whole per trigger, oldest update first."""
    return trains_last_stop(reports).orderBy("lastupdate", "id"), "complete"


def trains_changes_stream(reports: DataFrame) -> tuple[DataFrame, str]:
    """The trains that got a report in the micro-batch, with their latest stop: the
    changes of ``trains_last_stop_stream``'s snapshot, in update mode."""
    return trains_last_stop(reports), "update"


def top_delayed_stream(reports: DataFrame, n: int = TOP_N) -> tuple[DataFrame, str]:
    latest = latest_per_key(delayed(active(reports)), ["id"], columns=["linename", "delay"])
    return top_n(latest, n).select(*TOP_COLUMNS), "complete"


def top_delayed_current_stream(reports: DataFrame, n: int = TOP_N) -> tuple[DataFrame, str]:
    latest = latest_per_key(active(reports), ["id"], columns=["linename", "delay"])
    return top_n(delayed(latest), n).select(*TOP_COLUMNS), "complete"


def window_latest_stream(reports: DataFrame, minutes: float = TOP_WINDOW_MINUTES,
                         arrival: bool = False) -> tuple[DataFrame, str]:
    """Latest report per (window, unit) of delayed reports; each window's rows
    are appended together, in the micro-batch after the watermark passes its
    end. Windows are of event time or, with ``arrival``, of the messages' arrival
    stamps, whatever the size of the micro-batches they come in."""
    late = delayed(active(reports))
    late = late.withWatermark("arrival", WATERMARK_DELAY) if arrival else with_event_time(late)
    w = F.window("arrival" if arrival else EVENT_TIME, duration(minutes))
    latest = (
        late.groupBy(w.alias("w"), "id")
        .agg(F.max_by(F.struct("linename", "delay", "lastupdate", "seq"), F.struct("lastupdate", "seq")).alias("m"))
        .select(
            instant_to_ntz(F.col("w.start")).alias("window_start"),
            instant_to_ntz(F.col("w.end")).alias("window_end"),
            "id",
            F.col("m.linename").alias("linename"),
            F.col("m.delay").alias("delay"),
            F.col("m.lastupdate").alias("lastupdate"),
            F.col("m.seq").alias("seq"),
        )
    )
    return latest, "append"


def top_of_closed_windows(batch: DataFrame, n: int = TOP_N) -> DataFrame:
    """Batch step of the windowed top-N: the micro-batch holds complete windows."""
    top = top_n_per_group(batch, ["window_start", "window_end"], n)
    return top.orderBy("window_start", "lastupdate", F.col("delay").desc(), "seq").select(*WINDOW_TOP_COLUMNS)


# ------------------------------------------------------------------ report gap

GAP_OUTPUT_DDL = "id string, seq bigint, lastupdate timestamp_ntz, avg_gap_s double"
GAP_STATE_DDL = "stamps array<bigint>"


# Rows of one unit that leave the state function in one piece.
GAP_OUTPUT_ROWS = 100_000


def _gap_state_function(n: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    keep = n - 1

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # One key arrives in Arrow chunks, in no order (the shuffle loses it). Only two
        # numbers a row are kept of a chunk (16 bytes), each chunk as a sorted run; so a
        # unit that holds most of a micro-batch takes a small part of its size here.
        runs = []
        for chunk in chunks:
            us, seq = chunk["_us"].to_numpy(dtype=np.int64), chunk["seq"].to_numpy(dtype=np.int64)
            order = np.lexsort((seq, us))
            runs.append((us[order], seq[order]))
        us, seq = (np.concatenate([r[i] for r in runs]) for i in (0, 1))
        runs.clear()
        order = np.lexsort((seq, us))
        us, seq = us[order], seq[order]
        del order
        prev = np.asarray(state.get[0] if state.exists else [], dtype=np.int64)
        stamps = np.concatenate([prev, us // 1000])
        state.update((stamps[-keep:].tolist() if keep else [],))
        for at in range(0, len(us), GAP_OUTPUT_ROWS):
            part = slice(at, at + GAP_OUTPUT_ROWS)
            idx = np.arange(len(prev) + at, len(prev) + at + len(us[part]))
            lo = np.maximum(idx - keep, 0)
            k = idx - lo
            with np.errstate(divide="ignore", invalid="ignore"):
                gap = np.where(k == 0, 0.0, (stamps[idx] - stamps[lo]) / k / 1000.0)
            yield pd.DataFrame({"id": key[0], "seq": seq[part], "lastupdate": us[part].astype("datetime64[us]"), "avg_gap_s": gap.astype("float64")})

    return step


def report_gap_stream(reports: DataFrame, n: int = GAP_REPORTS) -> tuple[DataFrame, str]:
    """After each report: mean seconds between the unit's last ``n`` reports,
    carried across micro-batches in keyed state of ``n - 1`` stamps."""
    base = active(reports).filter(F.col("lastupdate") > epoch_ntz()).select(
        "id", "seq", ntz_to_micros(F.col("lastupdate")).alias("_us")
    )
    out = base.groupBy("id").applyInPandasWithState(
        _gap_state_function(n), GAP_OUTPUT_DDL, GAP_STATE_DDL, "append", GroupStateTimeout.NoTimeout
    )
    return out, "append"
