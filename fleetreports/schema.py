"""Report data model.

A *report* is one position message of one unit (bus, tram, train, ...),
flattened to the fixed columns below. Every operator in the package takes
and returns DataFrames with (a subset of) these columns, batch or streaming.

``lastupdate`` is kept as ``TIMESTAMP_NTZ`` holding the UTC wall clock of the
report's epoch-millisecond stamp. That makes every batch result independent
of ``spark.sql.session.timeZone``; the streaming operators convert it to an
instant (``TIMESTAMP``) only where Spark's watermark requires one.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of a report (the 16 message attributes plus our ``seq``).
REPORT_COLUMNS: tuple[str, ...] = (
    "id",
    "vtype",
    "ltype",
    "lat",
    "lng",
    "bearing",
    "lineid",
    "linename",
    "routeid",
    "course",
    "lf",
    "delay",
    "laststopid",
    "finalstopid",
    "isinactive",
    "lastupdate",
    "seq",
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("vtype", T.IntegerType(), False),
        T.StructField("ltype", T.IntegerType(), False),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lng", T.DoubleType(), False),
        T.StructField("bearing", T.DoubleType(), False),
        T.StructField("lineid", T.LongType(), False),
        T.StructField("linename", T.StringType(), False),
        T.StructField("routeid", T.LongType(), False),
        T.StructField("course", T.StringType(), False),
        T.StructField("lf", T.StringType(), False),
        T.StructField("delay", T.DoubleType(), False),
        T.StructField("laststopid", T.LongType(), False),
        T.StructField("finalstopid", T.LongType(), False),
        T.StructField("isinactive", T.StringType(), False),
        T.StructField("lastupdate", T.TimestampNTZType(), False),
        T.StructField("seq", T.LongType(), False),
    ]
)

# The message nests its fields under ``attributes``. Every attribute is read
# as text first so that numbers, booleans, quoted numbers and junk all parse;
# the typed coercion happens afterwards (see functions.coerce).
ATTRIBUTE_NAMES: tuple[str, ...] = REPORT_COLUMNS[:-1]

RAW_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField(
            "attributes",
            T.StructType([T.StructField(n, T.StringType(), True) for n in ATTRIBUTE_NAMES]),
            True,
        ),
        T.StructField("_corrupt_record", T.StringType(), True),
    ]
)

# A staged (parsed once) message: report columns, the quarantine reason (null
# for a good message) and the raw text of quarantined messages.
STAGED_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in REPORT_SCHEMA.fields]
    + [T.StructField("arrival", T.TimestampType(), True)]
    + [T.StructField("_reason", T.StringType(), True), T.StructField("_raw", T.StringType(), True)]
)

# Output shapes of the queries (FIXTURES.md section 1).
TRAIN_COLUMNS = ("id", "linename", "laststopid", "lastupdate")
TOP_COLUMNS = ("id", "linename", "delay", "lastupdate")
WINDOW_TOP_COLUMNS = ("window_start", "window_end", "id", "linename", "delay", "lastupdate")
AVG_COLUMNS = ("window_start", "window_end", "avg_delay")
GAP_COLUMNS = ("id", "seq", "lastupdate", "avg_gap_s")
