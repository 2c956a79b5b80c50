"""In-memory report builders (test and fixture sources).

``make_reports`` mirrors the short record constructor of the source job's
tests: ``(id, vtype, bearing, lineid, linename, delay, laststopid,
lastupdate_ms)``, with ``ltype = vtype``, ``lat = lng = 0.0``, ``routeid = 0``,
``course = lf = ''``, ``finalstopid = -1`` and ``isinactive = 'false'``.
``seq`` is the list position, i.e. arrival order.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetreports.functions.coerce import millis_to_ntz
from fleetreports.schema import REPORT_COLUMNS

Record = Sequence  # (id, vtype, bearing, lineid, linename, delay, laststopid, lastupdate_ms)

_RAW_DDL = (
    "id string, vtype int, bearing double, lineid bigint, linename string, "
    "delay double, laststopid bigint, lastupdate_ms bigint, seq bigint"
)


def make_reports(spark: SparkSession, records: Iterable[Record]) -> DataFrame:
    rows = [
        (str(r[0]), int(r[1]), float(r[2]), int(r[3]), str(r[4]), float(int(r[5])), int(r[6]), int(r[7]), i)
        for i, r in enumerate(records)
    ]
    df = spark.createDataFrame(rows, _RAW_DDL)
    return df.select(
        "id",
        "vtype",
        F.col("vtype").alias("ltype"),
        F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lng"),
        "bearing",
        "lineid",
        "linename",
        F.lit(0).cast("bigint").alias("routeid"),
        F.lit("").alias("course"),
        F.lit("").alias("lf"),
        "delay",
        "laststopid",
        F.lit(-1).cast("bigint").alias("finalstopid"),
        F.lit("false").alias("isinactive"),
        millis_to_ntz(F.col("lastupdate_ms")).alias("lastupdate"),
        "seq",
    ).select(*REPORT_COLUMNS)


def record_message(record: Record, **extra) -> str:
    """The JSON feed message of a short record (for streaming replays)."""
    rid, vtype, bearing, lineid, linename, delay, laststopid, ts = record[:8]
    attrs = {
        "id": str(rid),
        "vtype": int(vtype),
        "ltype": int(vtype),
        "lat": 0.0,
        "lng": 0.0,
        "bearing": float(bearing),
        "lineid": int(lineid),
        "linename": linename,
        "routeid": 0,
        "course": "",
        "lf": "",
        "delay": int(delay),
        "laststopid": int(laststopid),
        "finalstopid": -1,
        "isinactive": "false",
        "lastupdate": int(ts),
    }
    attrs.update(extra)
    return json.dumps({"attributes": attrs})
