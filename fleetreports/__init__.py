"""fleetreports: exact analytics over position reports of moving units,
on Spark DataFrames and Structured Streaming.

Layout:
  schema        report columns and raw message schema
  sources/      JSON feed ingest (+ quarantine), ``events`` adapter, fixtures
  functions/    coercion, zone-free time conversion, lineage, text rendering
  operators/    filters, latest-per-key, top-N, windowed average, report gap
  plans/        the job's queries, registry and command line
  streaming/    streaming forms of the queries, state, sinks

Typical use::

    from fleetreports import build_session, ingest, queries, render
    spark = build_session("local[8]")
    reports = ingest(spark, "/landing").reports
    render(queries.top_delayed(reports), "top").show(truncate=False)
"""

from fleetreports.functions.render import render
from fleetreports.plans import queries
from fleetreports.schema import REPORT_COLUMNS, REPORT_SCHEMA
from fleetreports.session import build_session
from fleetreports.sources.feed import ingest, parse_messages, read_report_table, write_report_tables

__all__ = [
    "REPORT_COLUMNS",
    "REPORT_SCHEMA",
    "build_session",
    "ingest",
    "parse_messages",
    "queries",
    "read_report_table",
    "render",
    "write_report_tables",
]
