"""Scalar column functions: coercion, time conversion, lineage, rendering."""

from fleetreports.functions.coerce import (
    as_double,
    as_int,
    as_long,
    as_text,
    as_whole_double,
    instant_to_ntz,
    millis_to_ntz,
    ntz_to_instant,
    ntz_to_micros,
    ntz_to_millis,
)
from fleetreports.functions.lineage import payload_hash, rsvp_id
from fleetreports.functions.render import date_text, render

__all__ = [
    "as_double",
    "as_int",
    "as_long",
    "as_text",
    "as_whole_double",
    "date_text",
    "instant_to_ntz",
    "millis_to_ntz",
    "ntz_to_instant",
    "ntz_to_micros",
    "ntz_to_millis",
    "payload_hash",
    "render",
    "rsvp_id",
]
