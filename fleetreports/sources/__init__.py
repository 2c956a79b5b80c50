"""Sources: the JSON message feed (batch and streaming), the ``events``
adapter, and in-memory fixture builders."""

from fleetreports.sources.events import event_reports, read_events, reports_from_events
from fleetreports.sources.feed import (
    Ingested,
    ingest,
    parse_messages,
    parsed_messages,
    read_feed,
    read_feed_stream,
    read_report_table,
    split_parsed,
    to_messages,
    write_report_tables,
)
from fleetreports.sources.records import make_reports, record_message

__all__ = [
    "Ingested",
    "event_reports",
    "ingest",
    "make_reports",
    "parse_messages",
    "parsed_messages",
    "read_events",
    "read_feed",
    "read_feed_stream",
    "read_report_table",
    "record_message",
    "split_parsed",
    "to_messages",
    "write_report_tables",
    "reports_from_events",
]
