"""Query registry: one entry per query of the job, with its command-line
flags, batch form, streaming form, rendering and defaults.

Flag dispatch keeps the source job's rule: the first query whose flag is
given wins, in the order help, north, trains, delayed, delayedw, average,
diff; with none of them, every active report is passed through.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame

from fleetreports.defaults import AVG_MINUTES, GAP_REPORTS, TOP_N, TOP_WINDOW_MINUTES
from fleetreports.plans import queries as q
from fleetreports.streaming import queries as sq


@dataclass(frozen=True)
class QuerySpec:
    name: str
    flags: tuple[str, ...]
    batch: Callable[..., DataFrame]
    stream: Callable[..., tuple[DataFrame, str]] | None
    render: str
    # "append": rows are final when emitted; "snapshot": the whole result is
    # re-emitted per trigger; "windowed": closed windows, ranked per batch.
    output: str
    defaults: dict = field(default_factory=dict)
    help: str = ""


QUERIES: tuple[QuerySpec, ...] = (
    QuerySpec("north", ("1", "north"), q.north_reports, sq.north_stream, "report", "append",
              help="only units heading north"),
    QuerySpec("trains", ("2", "trains"), q.trains_last_stop, sq.trains_last_stop_stream, "train", "snapshot",
              help="every train since start with its last stop and last update"),
    QuerySpec("delayed", ("3", "delayed"), q.top_delayed, sq.top_delayed_stream, "top", "snapshot",
              {"n": TOP_N}, help="top 5 delayed units since start"),
    QuerySpec("delayedw", ("4", "delayedw"), q.top_delayed_window, None, "top", "windowed",
              {"minutes": TOP_WINDOW_MINUTES, "n": TOP_N}, help="top 5 delayed units per window"),
    QuerySpec("average", ("5", "average"), q.average_delay, sq.average_delay_stream, "average", "append",
              {"minutes": AVG_MINUTES}, help="average delay of all units per window"),
    QuerySpec("diff", ("6", "diff"), q.report_gap, sq.report_gap_stream, "gap", "append",
              {"n": GAP_REPORTS, "strategy": "auto"}, help="average time between each unit's last 10 reports"),
)
PASSTHROUGH = QuerySpec("passthrough", (), q.passthrough, sq.passthrough_stream, "report", "append",
                        help="every active report")
# Extra queries reachable by name (not by the numbered flags).
EXTRA: tuple[QuerySpec, ...] = (
    QuerySpec("delayed_current", ("delayed-current",), q.top_delayed_current, sq.top_delayed_current_stream,
              "top", "snapshot", {"n": TOP_N}, help="top 5 by each unit's latest delay"),
)

BY_NAME: dict[str, QuerySpec] = {s.name: s for s in (*QUERIES, PASSTHROUGH, *EXTRA)}
HELP_FLAGS = ("h", "help")


def select(flags: set[str]) -> QuerySpec | None:
    """The query chosen by a set of flags (without dashes); None means help."""
    if flags & set(HELP_FLAGS):
        return None
    for spec in (*QUERIES, *EXTRA):
        if flags & set(spec.flags):
            return spec
    return PASSTHROUGH


def params_for(spec: QuerySpec, **overrides) -> dict:
    out = dict(spec.defaults)
    out.update({k: v for k, v in overrides.items() if k in spec.defaults and v is not None})
    return out


def run_batch(name: str, reports: DataFrame, **params) -> DataFrame:
    spec = BY_NAME[name]
    return spec.batch(reports, **params_for(spec, **params))


def stream_form(name: str, reports: DataFrame, **params) -> tuple[DataFrame, str]:
    spec = BY_NAME[name]
    if spec.stream is None:
        raise ValueError(f"{name} runs through start_query (ranked per closed window)")
    # batch-only settings (e.g. the gap strategy) do not apply to the stream form
    accepted = inspect.signature(spec.stream).parameters
    return spec.stream(reports, **{k: v for k, v in params_for(spec, **params).items() if k in accepted})


def help_text() -> str:
    lines = ["Usage: python -m fleetreports.plans.job [OPTIONS] --input DIR [--output DIR]",
             "       python -m fleetreports.plans.job --input DIR --ingest-to TABLE_DIR",
             "       python -m fleetreports.plans.job [OPTIONS] --batch --reports TABLE_DIR",
             " With no query option, every active report is printed.", "Options:",
             "  -h, --help      print this help"]
    for spec in QUERIES:
        short, long_ = spec.flags
        lines.append(f"  -{short}, --{long_:<10s} {spec.help}")
    return "\n".join(lines)


def batch_queries() -> dict[str, Callable[..., DataFrame]]:
    return {name: partial(run_batch, name) for name in BY_NAME}
