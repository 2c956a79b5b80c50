"""

``entry(spark)`` runs the flagship query (top 5 most delayed units) on the
sf0.001 tables; ``queries()`` registers every query of the job over the
``events`` table (played as the report feed, see FIXTURES.md section 3);
``oracle_sql()`` gives the same queries in DuckDB SQL over the same parquet
views. Column names and types are aligned one to one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from fleetreports.functions import render
from fleetreports.plans import queries as q
from fleetreports.sources.events import event_reports
from fleetreports.sources.feed import parse_messages, to_messages
from fleetreports.streaming import replay

# The training-data operators are an optional part: they are registered where
# the subpackage (and the pipeline module) is there. Any other import error
# inside them is an error.
try:
    from fleetreports.llm import queries as llm
except ModuleNotFoundError as gone:
    if gone.name not in ("fleetreports.llm", "fleetreports.llm.queries"):
        raise
    llm = None
try:
    import corpus_pipeline
except ModuleNotFoundError as gone:
    if gone.name != "corpus_pipeline" and llm is not None:
        raise
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return q.top_delayed(event_reports(spark, SMOKE_DIR))


def _on_events(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(event_reports(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _rendered(fn: Callable[[DataFrame], DataFrame], kind: str) -> Callable[[DataFrame], DataFrame]:
    return lambda reports: render(fn(reports), kind)


def _hot_unit(reports: DataFrame) -> DataFrame:
    """A third of all reports (users with user_id % 3 = 0) merged into one
    unit '0': the skewed input of the hot-unit gap query."""
    from pyspark.sql import functions as F

    hot = (F.col("id").cast("bigint") % 3) == 0
    return reports.withColumn("id", F.when(hot, F.lit("0")).otherwise(F.col("id")))


def _gap_hot_unit(reports: DataFrame) -> DataFrame:
    # The hot unit (a third of all rows) takes the range-partitioned path, the
    # other units one window each.
    from fleetreports.defaults import GAP_REPORTS
    from fleetreports.operators.filters import active
    from fleetreports.operators.gap import avg_report_gap

    return avg_report_gap(active(_hot_unit(reports)), n=GAP_REPORTS, strategy="auto", hot_key_rows=1000)


def _blanked(reports: DataFrame) -> DataFrame:
    """Every fifth event without a usable stamp."""
    from pyspark.sql import functions as F

    from fleetreports.functions.coerce import epoch_ntz

    return reports.withColumn("lastupdate", F.when(F.col("seq") % 5 == 0, epoch_ntz()).otherwise(F.col("lastupdate")))


def _gap_accounted(reports: DataFrame) -> DataFrame:
    """Gap of the stamped reports, and the others with the reason: every active
    report is in the result once."""
    from pyspark.sql import functions as F

    from fleetreports.operators import without_stamp
    from fleetreports.operators.filters import active

    blanked = _blanked(reports)
    gap = q.report_gap(blanked, n=10).withColumn("reason", F.lit(None).cast("string"))
    return gap.unionByName(without_stamp(active(blanked)).withColumn("avg_gap_s", F.lit(None).cast("double")))


def _bracketed(reports: DataFrame) -> DataFrame:
    """Ids and line names that begin like a JSON container, on part of the units."""
    from pyspark.sql import functions as F

    unit = F.col("id").cast("bigint")

    def marked(name: str):
        c = F.col(name)
        return (F.when(unit % 7 == 0, F.concat(F.lit("["), c, F.lit("]")))
                .when(unit % 11 == 0, F.concat(F.lit("{"), c)).otherwise(c).alias(name))

    return reports.withColumns({"id": marked("id"), "linename": marked("linename")})


def _feed_reports(reports: DataFrame) -> DataFrame:
    """The events as JSON messages, read back by the ingest (all reports)."""
    return parse_messages(to_messages(_bracketed(reports))).reports.drop("seq")


def _delivered_again(reports: DataFrame) -> DataFrame:
    """All reports, and every third once more under another place in the feed."""
    from pyspark.sql import functions as F

    return reports.unionByName(reports.where("seq % 3 = 0").withColumn("seq", F.col("seq") + F.lit(1_000_000_000)))


def _stream_distinct(reports: DataFrame) -> DataFrame:
    got = replay.repeats_dropped(_delivered_again(reports))
    return got.select("id", "delay", "laststopid", "lastupdate")


def _distinct_reports(reports: DataFrame) -> DataFrame:
    from fleetreports.operators import without_repeats

    return without_repeats(_delivered_again(reports))


def _turn_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as feed messages: JSON with and without ``rsvp_id``, and
    their bare texts, which are no JSON."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.selectExpr(
        "CASE conv_id % 3 WHEN 0 THEN concat('{\"rsvp_id\":\"r', conv_id, '\",\"attributes\":{\"id\":\"[', turn, ']\"}}')"
        " WHEN 1 THEN concat('{\"attributes\":{\"id\":{\"a\":', turn, '},\"delay\":\"', conv_id, '.9\"}}')"
        " ELSE concat('x ', text) END AS value")


def _feed_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = parse_messages(_turn_messages(spark, sf_dir), with_lineage=True)
    return (got.reports.select("id", "delay", "rsvp_id", "payload_hash")
            .unionByName(got.quarantine.selectExpr("'' AS id", "0D AS delay", "rsvp_id", "payload_hash")))


def _feed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_messages(_turn_messages(spark, sf_dir)).quarantine.select("value", "reason")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per implemented query; each takes (spark, sf_dir)."""
    more = dict(llm.queries()) if llm else {}
    if llm and corpus_pipeline:
        more["pipeline"] = corpus_pipeline.run
    return more | {
        "active_reports": _on_events(q.passthrough),
        "north": _on_events(q.north_reports),
        "trains_last_stop": _on_events(q.trains_last_stop),
        "top5_delayed": _on_events(q.top_delayed),
        "top5_delayed_current": _on_events(q.top_delayed_current),
        "top5_delayed_window": _on_events(partial(q.top_delayed_window, minutes=3)),
        "top5_delayed_window_1d": _on_events(partial(q.top_delayed_window, minutes=24 * 60)),
        "avg_delay_1m": _on_events(partial(q.average_delay, minutes=1)),
        "avg_delay_3m": _on_events(partial(q.average_delay, minutes=3)),
        "avg_report_gap": _on_events(partial(q.report_gap, n=10)),
        "avg_report_gap_hot_unit": _on_events(_gap_hot_unit),
        "gap_accounted": _on_events(_gap_accounted),
        "feed_reports": _on_events(_feed_reports),
        "feed_lineage": _feed_lineage,
        "feed_quarantine": _feed_quarantine,
        "stream_avg_delay": _on_events(partial(replay.average_delay, minutes=1)),
        "stream_top5_window": _on_events(partial(replay.top_delayed_window, minutes=3)),
        "stream_trains": _on_events(replay.trains_last_stop),
        "stream_trains_changes": _on_events(replay.trains_changes),
        "stream_top5": _on_events(replay.top_delayed),
        "stream_top5_current": _on_events(partial(replay.top_delayed, current=True)),
        "distinct_reports": _on_events(_distinct_reports),
        "stream_distinct": _on_events(_stream_distinct),
        "stream_gap": _on_events(lambda reports: replay.report_gap(reports, n=10).drop("seq")),
        "render_reports": _on_events(_rendered(q.passthrough, "report")),
        "render_north": _on_events(_rendered(q.north_reports, "report")),
        "render_trains": _on_events(_rendered(q.trains_last_stop, "train")),
        "render_top5": _on_events(_rendered(q.top_delayed, "top")),
        "render_top5_window": _on_events(_rendered(partial(q.top_delayed_window, minutes=3), "top")),
        "render_avg_delay": _on_events(_rendered(partial(q.average_delay, minutes=1), "average")),
        "render_report_gap": _on_events(_rendered(partial(q.report_gap, n=10), "gap")),
    }


# ---------------------------------------------------------------- oracle SQL

# The events -> reports adapter in DuckDB SQL (same expressions as
# fleetreports.sources.events), then the active filter.
_ACTIVE = """
WITH reports AS (
  SELECT {id_expr} AS id,
         CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3
                         WHEN 'error' THEN 4 WHEN 'purchase' THEN 5 ELSE 0 END AS vtype,
         0 AS ltype,
         CAST(0.0 AS DOUBLE) AS lat,
         CAST(0.0 AS DOUBLE) AS lng,
         CAST((event_id * 37) % 360 AS DOUBLE) AS bearing,
         CAST(user_id % 40 AS BIGINT) AS lineid,
         'L' || CAST(user_id % 40 AS VARCHAR) AS linename,
         CAST(0 AS BIGINT) AS routeid,
         '' AS course,
         '' AS lf,
         CAST(floor(value) AS DOUBLE) - 20.0 AS delay,
         COALESCE(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT), 0) AS laststopid,
         CAST(0 AS BIGINT) AS finalstopid,
         CASE WHEN COALESCE(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT), 0) % 10 = 0
              THEN 'true' ELSE 'false' END AS isinactive,
         CAST(ts AS TIMESTAMP) AS lastupdate,
         CAST(event_id AS BIGINT) AS seq
  FROM events
),
active AS (SELECT * FROM reports WHERE isinactive = 'false')
"""
_ACTIVE_HOT = _ACTIVE.replace("{id_expr}", "CASE WHEN user_id % 3 = 0 THEN '0' ELSE CAST(user_id AS VARCHAR) END")
_ACTIVE = _ACTIVE.replace("{id_expr}", "CAST(user_id AS VARCHAR)")

_REPORT_COLS = (
    "id, vtype, ltype, lat, lng, bearing, lineid, linename, routeid, course, lf, "
    "delay, laststopid, finalstopid, isinactive, lastupdate, seq"
)

_NORTH = "(bearing >= 0 AND bearing <= 45) OR bearing >= 315"

# Latest report per id: greatest (lastupdate, seq).
_LATEST = "row_number() OVER (PARTITION BY id ORDER BY lastupdate DESC, seq DESC)"


def _trains_sql() -> str:
    return _ACTIVE + f"""
SELECT id, linename, laststopid, lastupdate FROM (
  SELECT *, {_LATEST} AS rn FROM active WHERE vtype = 5
) WHERE rn = 1"""


def _top5_sql() -> str:
    return _ACTIVE + f"""
SELECT id, linename, delay, lastupdate FROM (
  SELECT *, {_LATEST} AS rn FROM active WHERE delay > 0
) WHERE rn = 1
ORDER BY delay DESC, lastupdate, seq, id LIMIT 5"""


def _top5_current_sql() -> str:
    return _ACTIVE + f"""
SELECT id, linename, delay, lastupdate FROM (
  SELECT *, {_LATEST} AS rn FROM active
) WHERE rn = 1 AND delay > 0
ORDER BY delay DESC, lastupdate, seq, id LIMIT 5"""


def _bucket(minutes: int) -> str:
    width_us = minutes * 60 * 1_000_000
    return f"make_timestamp((epoch_us(lastupdate) // {width_us}) * {width_us})"


def _top5_window_sql(minutes: int) -> str:
    return _ACTIVE + f"""
SELECT window_start, window_start + INTERVAL {minutes} MINUTE AS window_end, id, linename, delay, lastupdate FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start
                               ORDER BY delay DESC, lastupdate, seq, id) AS rk
  FROM (
    SELECT *, row_number() OVER (PARTITION BY window_start, id
                                 ORDER BY lastupdate DESC, seq DESC) AS rn
    FROM (SELECT *, {_bucket(minutes)} AS window_start FROM active WHERE delay > 0)
  ) WHERE rn = 1
) WHERE rk <= 5
ORDER BY window_start, lastupdate, delay DESC, seq"""


def _avg_sql(minutes: int) -> str:
    return _ACTIVE + f"""
SELECT {_bucket(minutes)} AS window_start, {_bucket(minutes)} + INTERVAL {minutes} MINUTE AS window_end, avg(delay) AS avg_delay
FROM active GROUP BY 1, 2"""


def _gap_sql(n: int, active: str | None = None) -> str:
    return (active or _ACTIVE) + f"""
SELECT id, seq, lastupdate,
       CASE WHEN cnt = 1 THEN CAST(0.0 AS DOUBLE)
            ELSE CAST(ms - first_ms AS DOUBLE) / CAST(cnt - 1 AS DOUBLE) / 1000.0 END AS avg_gap_s
FROM (
  SELECT id, seq, lastupdate, epoch_us(lastupdate) // 1000 AS ms,
         first_value(epoch_us(lastupdate) // 1000) OVER w AS first_ms,
         count(*) OVER w AS cnt
  FROM active
  WHERE lastupdate > TIMESTAMP '1970-01-01 00:00:00'
  WINDOW w AS (PARTITION BY id ORDER BY lastupdate, seq ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)
)"""


def _streamed(sql: str) -> str:
    """The same query over the feed, whose messages carry epoch milliseconds."""
    return sql.replace("CAST(ts AS TIMESTAMP) AS lastupdate", "make_timestamp(epoch_us(ts) // 1000 * 1000) AS lastupdate")


# Text renderings (Java Date.toString text in UTC; doubles via VARCHAR).
_DATE_TEXT = "strftime(lastupdate, '%a %b %d %H:%M:%S UTC %Y')"


def _wrap(inner: str, line: str) -> str:
    # inner is a full statement starting with the shared CTE; wrap its SELECT.
    head, _, body = inner.partition("\nSELECT ")
    return head + f"\n, result AS (SELECT {body})\nSELECT {line} AS value FROM result"


_REPORT_LINE = (
    "'Vehicle{id=''' || id || ''', vtype=' || CAST(vtype AS VARCHAR) || ', ltype=' || CAST(ltype AS VARCHAR)"
    " || ', lat=' || CAST(lat AS VARCHAR) || ', lng=' || CAST(lng AS VARCHAR)"
    " || ', bearing=' || CAST(bearing AS VARCHAR) || ', lineid=' || CAST(lineid AS VARCHAR)"
    " || ', linename=''' || linename || ''', routeid=' || CAST(routeid AS VARCHAR)"
    " || ', course=''' || course || ''', lf=''' || lf || ''', delay=' || CAST(delay AS VARCHAR)"
    " || ', laststopid=' || CAST(laststopid AS VARCHAR) || ', finalstopid=' || CAST(finalstopid AS VARCHAR)"
    " || ', isinactive=''' || isinactive || ''', lastupdate=' || " + _DATE_TEXT + " || '''}'"
)
_TRAIN_LINE = (
    "'trainID:' || id || ' trainName:' || linename || ' last stop:' || CAST(laststopid AS VARCHAR)"
    " || ' last update:' || " + _DATE_TEXT
)
_TOP_LINE = (
    "'ID:' || id || ' name:' || linename || ' delay:' || CAST(delay AS VARCHAR)"
    " || ' last update:' || " + _DATE_TEXT
)
_AVG_LINE = "'Average delay:' || CAST(avg_delay AS VARCHAR)"
_GAP_LINE = "'ID: ' || id || ' Average: ' || CAST(avg_gap_s AS VARCHAR)"


_ACCOUNTED = _gap_sql(10, _ACTIVE.replace("FROM events", "FROM (SELECT * REPLACE (CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE ts END AS ts) FROM events)"))
_ACCOUNTED = _ACCOUNTED.replace("SELECT id, seq, lastupdate,\n", "SELECT id, seq, lastupdate, CAST(NULL AS VARCHAR) AS reason,\n") + """
UNION ALL SELECT id, seq, lastupdate, 'no_stamp' AS reason, CAST(NULL AS DOUBLE) AS avg_gap_s
FROM active WHERE lastupdate <= TIMESTAMP '1970-01-01 00:00:00'"""
_MARKED = "CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN '[' || {c} || ']' WHEN CAST(id AS BIGINT) % 11 = 0 THEN '{{' || {c} ELSE {c} END AS {c}"
_FEED = (
    _ACTIVE + "SELECT " + ", ".join(
        _MARKED.format(c=c) if c in ("id", "linename")
        else "make_timestamp(epoch_us(lastupdate) // 1000 * 1000) AS lastupdate" if c == "lastupdate" else c
        for c in _REPORT_COLS.split(", ") if c != "seq") + " FROM reports"
)
_TURNS = """
WITH turns AS (
  SELECT conv_id, turn, CASE conv_id % 3
    WHEN 0 THEN '{"rsvp_id":"r' || conv_id || '","attributes":{"id":"[' || turn || ']"}}'
    WHEN 1 THEN '{"attributes":{"id":{"a":' || turn || '},"delay":"' || conv_id || '.9"}}'
    ELSE 'x ' || text END AS value
  FROM conversations
)
"""
_LINEAGE = _TURNS + """
SELECT CASE conv_id % 3 WHEN 0 THEN '[' || turn || ']' ELSE '' END AS id,
       CAST(CASE conv_id % 3 WHEN 1 THEN conv_id ELSE 0 END AS DOUBLE) AS delay,
       CASE conv_id % 3 WHEN 0 THEN 'r' || conv_id WHEN 1 THEN 'NOT FOUND' ELSE 'NULL' END AS rsvp_id,
       upper(md5(value)) AS payload_hash
FROM turns WHERE value IS NOT NULL"""
_QUARANTINE = _TURNS + "SELECT value, 'malformed_json' AS reason FROM turns WHERE conv_id % 3 = 2 AND value IS NOT NULL"


def oracle_sql() -> dict[str, str]:
    active_sql = _ACTIVE + f"SELECT {_REPORT_COLS} FROM active"
    north_sql = _ACTIVE + f"SELECT {_REPORT_COLS} FROM active WHERE {_NORTH}"
    more = dict(llm.oracle_sql()) if llm else {}
    if llm and corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return more | {
        "active_reports": active_sql,
        "north": north_sql,
        "trains_last_stop": _trains_sql(),
        "top5_delayed": _top5_sql(),
        "top5_delayed_current": _top5_current_sql(),
        "top5_delayed_window": _top5_window_sql(3),
        "top5_delayed_window_1d": _top5_window_sql(24 * 60),
        "avg_delay_1m": _avg_sql(1),
        "avg_delay_3m": _avg_sql(3),
        "avg_report_gap": _gap_sql(10),
        "avg_report_gap_hot_unit": _gap_sql(10, _ACTIVE_HOT),
        "gap_accounted": _ACCOUNTED,
        "feed_reports": _FEED,
        "feed_lineage": _LINEAGE,
        "feed_quarantine": _QUARANTINE,
        "stream_avg_delay": _streamed(_avg_sql(1)),
        "stream_top5_window": _streamed(_top5_window_sql(3)),
        "stream_trains": _streamed(_trains_sql()),
        "stream_trains_changes": _streamed(_trains_sql()),
        "stream_top5": _streamed(_top5_sql()),
        "stream_top5_current": _streamed(_top5_current_sql()),
        "distinct_reports": _ACTIVE + f"SELECT {_REPORT_COLS.replace(', seq', '')}, min(seq) AS seq FROM reports GROUP BY ALL",
        "stream_distinct": _streamed(_ACTIVE + "SELECT id, delay, laststopid, lastupdate FROM reports"),
        "stream_gap": f"SELECT id, lastupdate, avg_gap_s FROM ({_streamed(_gap_sql(10))})",
        "render_reports": _wrap(active_sql, _REPORT_LINE),
        "render_north": _wrap(north_sql, _REPORT_LINE),
        "render_trains": _wrap(_trains_sql(), _TRAIN_LINE),
        "render_top5": _wrap(_top5_sql(), _TOP_LINE),
        "render_top5_window": _wrap(_top5_window_sql(3), _TOP_LINE),
        "render_avg_delay": _wrap(_avg_sql(1), _AVG_LINE),
        "render_report_gap": _wrap(_gap_sql(10), _GAP_LINE),
    }
