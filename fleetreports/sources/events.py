"""Adapter from the driver's ``events`` table to reports.

The test tables hold no vehicle feed, so ``events`` plays it (FIXTURES.md
section 3): one event is one report of unit ``user_id``. The same expressions
are written in SQL in ``__spark_entry__.oracle_sql`` for the DuckDB oracle.

Fixed mapping values (kept together):
  event_type -> vtype : click 1, view 2, signup 3, error 4, purchase 5, other 0
  bearing             : (event_id * 37) % 360
  lineid / linename   : user_id % 40 / 'L' followed by it
  delay               : floor(value) - 20
  laststopid          : first run of digits in props (the ``k`` value)
  isinactive          : 'true' when laststopid % 10 = 0, else 'false'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from fleetreports.functions.coerce import EPOCH_NTZ_SQL

VTYPE_BY_EVENT = (("click", 1), ("view", 2), ("signup", 3), ("error", 4), ("purchase", 5))


def _adapter_sql(ts_type: str) -> list[str]:
    vtype = "CASE event_type " + " ".join(f"WHEN '{n}' THEN {c}" for n, c in VTYPE_BY_EVENT) + " ELSE 0 END"
    k = "COALESCE(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT), 0L)"
    if ts_type == "timestamp_ntz":
        ts = "ts"
    elif ts_type == "timestamp":
        ts = f"timestampadd(MICROSECOND, unix_micros(ts), {EPOCH_NTZ_SQL})"
    else:  # epoch milliseconds
        ts = f"timestampadd(MILLISECOND, CAST(ts AS BIGINT), {EPOCH_NTZ_SQL})"
    return [
        "CAST(user_id AS STRING) AS id",
        f"CAST({vtype} AS INT) AS vtype",
        "0 AS ltype",
        "0.0D AS lat",
        "0.0D AS lng",
        "CAST((event_id * 37) % 360 AS DOUBLE) AS bearing",
        "CAST(user_id % 40 AS BIGINT) AS lineid",
        "concat('L', CAST(user_id % 40 AS STRING)) AS linename",
        "0L AS routeid",
        "'' AS course",
        "'' AS lf",
        "CAST(floor(value) AS DOUBLE) - 20.0D AS delay",
        f"{k} AS laststopid",
        "0L AS finalstopid",
        f"CASE WHEN {k} % 10 = 0 THEN 'true' ELSE 'false' END AS isinactive",
        f"{ts} AS lastupdate",
        "CAST(event_id AS BIGINT) AS seq",
    ]


def reports_from_events(events: DataFrame) -> DataFrame:
    """Map an ``events`` DataFrame to report columns (projection only: no
    shuffle, and the parquet scan reads just the six source columns).

    Written as one ``selectExpr`` so that building the plan is a single call
    and a single analysis pass."""
    ts_type = next(f.dataType.simpleString() for f in events.schema.fields if f.name == "ts")
    return events.selectExpr(*_adapter_sql(ts_type))


# Schema of the driver's ``events`` table (FIXTURES.md section 3). Passing it
# skips schema inference from parquet footers on every read.
EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def read_events(spark: SparkSession, sf_dir: str, infer_schema: bool = False) -> DataFrame:
    reader = spark.read if infer_schema else spark.read.schema(EVENTS_DDL)
    return reader.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def event_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of the ``events`` table under ``sf_dir``."""
    return reports_from_events(read_events(spark, sf_dir))
