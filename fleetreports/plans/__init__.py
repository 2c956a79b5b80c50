"""Query plans: the job's queries and their registry."""

from fleetreports.plans.queries import (
    average_delay,
    north_reports,
    passthrough,
    report_gap,
    top_delayed,
    top_delayed_current,
    top_delayed_window,
    trains_last_stop,
)

__all__ = [
    "average_delay",
    "north_reports",
    "passthrough",
    "report_gap",
    "top_delayed",
    "top_delayed_current",
    "top_delayed_window",
    "trains_last_stop",
]
