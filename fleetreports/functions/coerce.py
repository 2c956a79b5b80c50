"""Column expressions that coerce loosely typed JSON text into report fields,
and zone-free time conversions.

Each attribute arrives as text (or null when absent). The coercions follow the
lenient reading of the source feed: a missing or unreadable value becomes the
type's default (``''``, 0, 0.0), a fractional number read as an integer is
truncated toward zero, and quoted numbers are accepted. Everything here is a
plain Catalyst expression (``try_cast``, ``coalesce``, ``timestamp_add``), so
it compiles into the scan stage's whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch origin as a zone-free timestamp; all time arithmetic is done against
# it, so results never depend on the session time zone.
EPOCH_NTZ_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_ntz() -> Column:
    return F.expr(EPOCH_NTZ_SQL)


def as_text(c: Column, message: Column, path: str) -> Column:
    """Text value of the attribute at ``path`` of the JSON ``message``, read as the
    text ``c``. Absent or JSON null -> ''. A nested object or array -> '' (a
    container has no scalar text); a string stays, whatever it begins with.
    Only text that looks like a container has its kind looked up, in the
    message itself."""
    lt = F.ltrim(c)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(message), path, "variant"))
    container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return (
        F.when(c.isNull(), F.lit(""))
        .when(~(lt.startswith("{") | lt.startswith("[")), c)
        .when(container, F.lit(""))
        .otherwise(c)
    )


def as_double(c: Column) -> Column:
    """Floating value; unreadable -> 0.0."""
    return F.coalesce(F.trim(c).try_cast("double"), F.lit(0.0))


def as_long(c: Column) -> Column:
    """Integral value, fraction truncated toward zero; unreadable -> 0."""
    t = F.trim(c)
    return F.coalesce(
        t.try_cast("bigint"),
        t.try_cast("double").try_cast("bigint"),
        F.lit(0).cast("bigint"),
    )


def as_int(c: Column) -> Column:
    """Small integral value (unit and line types); out of int range -> 0."""
    return F.coalesce(as_long(c).try_cast("int"), F.lit(0))


def as_whole_double(c: Column) -> Column:
    """A number read as an integer, then widened: the ``delay`` field."""
    return as_long(c).cast("double")


def millis_to_ntz(ms: Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ holding the UTC wall clock."""
    return F.timestamp_add("MILLISECOND", ms, epoch_ntz())


def micros_to_ntz(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, epoch_ntz())


def _seconds_field(ts: Column) -> Column:
    return F.extract(F.lit("SECOND"), ts)  # decimal(8,6): seconds with fraction


def ntz_to_millis(ts: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch milliseconds, floored.

    ``unix_timestamp`` reads a TIMESTAMP_NTZ's raw value and the fraction is a
    field of the wall clock, so no time zone takes part. (``timestamp_diff``
    would cast NTZ to TIMESTAMP in the session zone and be off by an hour
    around daylight-saving changes.)"""
    frac = (_seconds_field(ts) * F.lit(1000)).cast("bigint") % F.lit(1000)
    return F.unix_timestamp(ts) * F.lit(1000) + frac


def ntz_to_micros(ts: Column) -> Column:
    frac = (_seconds_field(ts) * F.lit(1_000_000)).cast("bigint") % F.lit(1_000_000)
    return F.unix_timestamp(ts) * F.lit(1_000_000) + frac


def ntz_to_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> TIMESTAMP instant, zone-free."""
    return F.timestamp_micros(ntz_to_micros(ts))


def instant_to_ntz(ts: Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ (UTC wall clock), zone-free."""
    return micros_to_ntz(F.unix_micros(ts))

