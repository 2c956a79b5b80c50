"""Report operators. Each takes and returns a DataFrame; all are built from
Catalyst operators and work on batch DataFrames (the streaming forms are in
``fleetreports.streaming``)."""

from fleetreports.operators.aggregates import avg_delay
from fleetreports.operators.filters import (
    active,
    delayed,
    is_active,
    is_delayed,
    is_north,
    is_train,
    north,
    trains,
)
from fleetreports.operators.distinct import without_repeats
from fleetreports.operators.gap import avg_report_gap, avg_report_gap_window, positions, without_stamp
from fleetreports.operators.latest import latest_per_key
from fleetreports.operators.topn import delay_rank_order, top_n, top_n_per_group
from fleetreports.operators.windows import tumbling

__all__ = [
    "active",
    "avg_delay",
    "avg_report_gap",
    "avg_report_gap_window",
    "delay_rank_order",
    "delayed",
    "is_active",
    "is_delayed",
    "is_north",
    "is_train",
    "latest_per_key",
    "north",
    "positions",
    "top_n",
    "top_n_per_group",
    "trains",
    "tumbling",
    "without_repeats",
    "without_stamp",
]
