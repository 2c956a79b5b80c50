"""Per-message lineage columns (debug trail of the feed collector).

``rsvp_id``: the top-level ``rsvp_id`` of the message; ``'NOT FOUND'`` when the
message is a JSON object without it, ``'NULL'`` when the text is not a JSON
object at all. ``payload_hash``: upper-case hex MD5 of the message text,
``'-- NULL --'`` for a null message. Both are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed marker values of the collector's debug trail.
RSVP_NOT_FOUND = "NOT FOUND"
RSVP_UNPARSABLE = "NULL"
HASH_OF_NULL = "-- NULL --"


def rsvp_id(value: Column) -> Column:
    # json_object_keys is null for invalid JSON and for non-object JSON.
    is_object = F.json_object_keys(value).isNotNull()
    return F.when(~is_object | value.isNull(), F.lit(RSVP_UNPARSABLE)).otherwise(
        F.coalesce(F.get_json_object(value, "$.rsvp_id"), F.lit(RSVP_NOT_FOUND))
    )


def payload_hash(value: Column) -> Column:
    return F.coalesce(F.upper(F.md5(value)), F.lit(HASH_OF_NULL))
