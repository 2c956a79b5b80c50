"""Structured Streaming forms of the queries, keyed state and sinks."""

import sys

from pyspark import cloudpickle

from fleetreports.streaming.queries import (
    average_delay_stream,
    north_stream,
    passthrough_stream,
    report_gap_stream,
    top_delayed_current_stream,
    top_delayed_stream,
    top_of_closed_windows,
    trains_last_stop_stream,
    window_latest_stream,
)

# State functions and sinks travel to the executors with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "average_delay_stream",
    "north_stream",
    "passthrough_stream",
    "report_gap_stream",
    "top_delayed_current_stream",
    "top_delayed_stream",
    "top_of_closed_windows",
    "trains_last_stop_stream",
    "window_latest_stream",
]
