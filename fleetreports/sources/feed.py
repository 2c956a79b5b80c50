"""Message feed ingest: JSON text lines -> typed reports + quarantine.

The feed lands as text files, one JSON message per line (a collector writes
them into a landing folder). Batch and streaming share one code path:
``spark.read.text`` / ``spark.readStream.text`` give a ``value`` column, and
``parse_messages`` turns it into reports with ``from_json`` (PERMISSIVE, every
attribute read as text) followed by the typed coercions of
``functions.coerce``. Malformed lines are not dropped silently: they are kept
apart in a quarantine DataFrame with a reason, and the job continues.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetreports.functions.coerce import (
    as_double,
    as_int,
    as_long,
    as_text,
    as_whole_double,
    millis_to_ntz,
    ntz_to_millis,
)
from fleetreports.functions.lineage import payload_hash, rsvp_id
from fleetreports.schema import RAW_MESSAGE_SCHEMA, REPORT_COLUMNS

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}

# Quarantine reasons.
REASON_MALFORMED = "malformed_json"
REASON_EMPTY = "empty_message"
REASON_STAMP = "stamp_out_of_range"

# Spark's file source leaves out files older than this, counted from the newest;
# its own default is a week, which would lose what a collector hands in late.
MAX_FILE_AGE = "365d"


@dataclass(frozen=True)
class Ingested:
    """Result of one ingest: parsed reports (active or not) and set-aside rows."""

    reports: DataFrame
    quarantine: DataFrame


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a landing folder (or file glob) of JSON-lines text."""
    return spark.read.text(path)


# Where a line of the feed comes from: its file's time stamp, the file and the
# first byte of the split. Given to ``parse_messages``, they make ``seq`` the order of arrival.
_PLACE = ("_stamp", "_path", "_start")


def read_feed_placed(spark: SparkSession, path: str) -> DataFrame:
    """``read_feed`` with the place of each line, from Spark's file metadata."""
    at = {"_stamp": "file_modification_time", "_path": "file_path", "_start": "file_block_start"}
    return read_feed(spark, path).select("value", *[F.col(f"_metadata.{f}").alias(c) for c, f in at.items()])


def read_feed_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Streaming read of a landing folder. ``max_files_per_trigger`` /
    ``max_bytes_per_trigger`` bound a micro-batch (the back-pressure role of
    the collector's bounded queue). A file stamped more than ``max_file_age``
    before the newest one is not read by Spark's source."""
    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    # A message's arrival is its file's time stamp: the same on every replay.
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias("arrival"))


# Epoch milliseconds of 0001-01-01 and 9999-12-31 23:59:59.999 (UTC): stamps
# outside cannot be timestamps and take the missing-value default (epoch 0).
_MIN_MS = -62135596800000
_MAX_MS = 253402300799999


def in_timestamp_range(ms: Column) -> Column:
    return F.when((ms >= F.lit(_MIN_MS)) & (ms <= F.lit(_MAX_MS)), ms).otherwise(F.lit(0).cast("bigint"))


def _report_projection(attrs: Column, lastupdate_ms: Column, message: Column) -> list[Column]:
    a = lambda name: attrs.getField(name)
    text = lambda name: as_text(a(name), message, f"$.attributes.{name}").alias(name)
    return [
        text("id"),
        as_int(a("vtype")).alias("vtype"),
        as_int(a("ltype")).alias("ltype"),
        as_double(a("lat")).alias("lat"),
        as_double(a("lng")).alias("lng"),
        as_double(a("bearing")).alias("bearing"),
        as_long(a("lineid")).alias("lineid"),
        text("linename"),
        as_long(a("routeid")).alias("routeid"),
        text("course"),
        text("lf"),
        as_whole_double(a("delay")).alias("delay"),
        as_long(a("laststopid")).alias("laststopid"),
        as_long(a("finalstopid")).alias("finalstopid"),
        text("isinactive"),
        millis_to_ntz(in_timestamp_range(lastupdate_ms)).alias("lastupdate"),
    ]


# ``seq``: the millisecond of the file's time stamp (43 bits, until the 2240s) above 20
# bits: the number of a line within it or, on a stream, of its hash.
_HASH_BITS = 20

# Split tables up to this many rows (24 bytes each) are broadcast once counted.
SPLITS_BROADCAST = 1_000_000


def _millis(stamp: Column) -> Column:
    return F.greatest(F.unix_millis(stamp), F.lit(0))


def stream_seq(value: Column, stamp: Column | None = None) -> Column:
    """Ingest order on a stream, where rows cannot be numbered: the millisecond of the
    file's time stamp in the high bits and a content hash in the low 20. Messages of
    later files order after those of earlier ones, however the files are cut into
    micro-batches; within one stamp the order goes by the hash. Without a stamp the
    micro-batch's time stands for it (recorded in the offset log, so a replayed batch
    gets the same numbers)."""
    milli = _millis(F.current_timestamp() if stamp is None else stamp)
    low = F.xxhash64(value).bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
    return F.shiftleft(milli, _HASH_BITS).bitwiseOR(low)


def arrival_order(parsed: DataFrame, counted: bool = False) -> DataFrame:
    """``seq`` of a batch with places (``seq`` holds row ids): the millisecond of the
    file's time stamp and, within it, the number of the line in the order of (path, line).
    It is unique, the same in every ingest that reads the same files of a stamp, and later
    files come after earlier ones. A millisecond with more than 2^20 lines runs on into
    those after it, so only ingests whose files are stamped that close can share numbers.

    A task reads the lines of a split one after the other, so a line's number in its
    split is the distance of row ids; lines are counted per split, and running sums over
    that small table (one row per split) give each split's first number. ``counted``: the
    rows are a table already; then the splits are written as one and broadcast up to
    ``SPLITS_BROADCAST`` of them. Otherwise the text is read once more for the count, and
    Spark chooses the join by size. The file's path is compared by a 64-bit hash.
    """
    rows = parsed.withColumn("_file", F.xxhash64("_path"))
    splits = rows.groupBy("_file", "_start").agg(
        F.min("_stamp").alias("_stamp"), F.min("_path").alias("_path"), F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_lines")
    ).withColumn("_milli", _millis(F.col("_stamp")))
    in_milli = Window.partitionBy("_milli").orderBy("_stamp", "_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_start", "_first", "_milli",
                           F.coalesce(F.sum("_lines").over(in_milli), F.lit(0)).alias("_before"), "_lines")
    # One row per time stamp: the first number that is free for it.
    stamps = splits.groupBy("_milli").agg(F.sum("_lines").alias("_lines"))
    so_far = Window.orderBy("_milli")
    earlier = F.coalesce(F.sum("_lines").over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stamps = stamps.select("_milli", earlier.alias("_earlier"))
    start = F.max(F.shiftleft("_milli", _HASH_BITS) - F.col("_earlier")).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    stamps = stamps.select("_milli", (start + F.col("_earlier")).alias("_at"))
    places = splits.join(stamps, "_milli").select("_file", "_start", (F.col("_at") + F.col("_before") - F.col("_first")).alias("_shift"))
    if counted:
        from fleetreports.session import materialize

        places = materialize(places, "splits")
        places = F.broadcast(places) if places.count() <= SPLITS_BROADCAST else places
    out = rows.join(places, ["_file", "_start"]).withColumn("seq", F.col("seq") + F.col("_shift"))
    return out.select(*[c for c in parsed.columns if c not in _PLACE])


def parsed_messages(raw: DataFrame, value_col: str = "value", with_lineage: bool = False) -> DataFrame:
    """One parse of the messages: report columns plus ``_reason`` (null for a
    good message) and ``_raw`` (the text, kept only for quarantined rows).
    ``split_parsed`` turns it into reports and quarantine."""
    value = F.col(value_col)
    arrival = [c for c in ("arrival", *_PLACE) if c in raw.columns]
    stamp = F.col("arrival") if "arrival" in raw.columns else None
    parsed = raw.filter(value.isNotNull()).select(
        *arrival,
        value.alias("_value"),
        F.from_json(value, RAW_MESSAGE_SCHEMA, _JSON_OPTIONS).alias("_m"),
        (stream_seq(value, stamp) if raw.isStreaming else F.monotonically_increasing_id()).alias("seq"),
    )
    corrupt = F.col("_m._corrupt_record").isNotNull()
    empty = F.trim(F.col("_value")) == ""
    attrs = F.col("_m.attributes")

    stamp = as_long(attrs.getField("lastupdate"))
    out_of_range = (stamp < F.lit(_MIN_MS)) | (stamp > F.lit(_MAX_MS))
    cols = _report_projection(attrs, stamp, F.col("_value")) + [F.col("seq")]
    if with_lineage:
        cols += [rsvp_id(F.col("_value")).alias("rsvp_id"), payload_hash(F.col("_value")).alias("payload_hash")]
    status = F.when(corrupt, F.lit(REASON_MALFORMED)).when(empty, F.lit(REASON_EMPTY)).when(out_of_range, F.lit(REASON_STAMP)).otherwise(F.lit(None))
    return parsed.select(
        *cols,
        *arrival,
        status.alias("_reason"),
        # the raw text is kept only where the quarantine needs it
        F.when(corrupt | empty | out_of_range, F.col("_value")).alias("_raw"),
    )


def split_parsed(combined: DataFrame) -> Ingested:
    """Reports (every message that is JSON) and quarantine of a parsed frame."""
    report_cols = [c for c in combined.columns if c not in ("_reason", "_raw")]
    reports = combined.filter(F.col("_reason").isNull() | (F.col("_reason") != REASON_MALFORMED)).select(
        *report_cols
    )
    lineage = [c for c in ("rsvp_id", "payload_hash") if c in combined.columns]
    quarantine = combined.filter(F.col("_reason").isNotNull()).select(
        F.col("_raw").alias("value"), F.col("_reason").alias("reason"), F.col("seq"), *lineage
    )
    return Ingested(reports, quarantine)


def parse_messages(
    raw: DataFrame, value_col: str = "value", with_lineage: bool = False, materialize_parse: bool = False
) -> Ingested:
    """Parse JSON messages into reports.

    Null messages are skipped. A message whose text is not JSON goes to
    quarantine. An empty message, a JSON value that is not an object, or an
    object without ``attributes`` yields a default report (empty
    ``isinactive``), which the active filter drops later, as in the source
    job; empty messages, and those whose stamp is no possible time (their report
    takes epoch 0), are also listed in the quarantine for visibility.
    ``seq`` numbers the messages in ingest order (used only to break ties
    between equal ``lastupdate``): ``arrival_order`` for a batch with places
    (``read_feed_placed``), else unique row ids; ``stream_seq`` on a stream.

    Both results derive from one parse. When both are consumed (batch),
    ``materialize_parse=True`` writes the parsed rows once to the shared
    checkpoint folder, so the JSON text is parsed once, not per output. (On
    streams, ``streaming.sinks.start_staging`` does the same through a table.)
    """
    combined = parsed_messages(raw, value_col, with_lineage)
    counted = materialize_parse and not raw.isStreaming
    if counted:
        from fleetreports.session import materialize

        combined = materialize(combined, "parsed")
    if set(_PLACE) <= set(combined.columns):
        combined = arrival_order(combined, counted)
    return split_parsed(combined)


def ingest(spark: SparkSession, path: str, with_lineage: bool = False, materialize_parse: bool = False) -> Ingested:
    """Batch ingest of a landing folder; ``seq`` is the order of arrival."""
    return parse_messages(read_feed_placed(spark, path), with_lineage=with_lineage, materialize_parse=materialize_parse)


def to_messages(reports: DataFrame, numbered: bool = False) -> DataFrame:
    """Inverse of ``parse_messages``: one JSON message (``value``) per report,
    ``lastupdate`` as epoch milliseconds. Used to replay tables as a feed.
    ``numbered``: ``seq`` goes along as the message's ``rsvp_id``."""
    attrs = [F.col(c) for c in REPORT_COLUMNS if c not in ("lastupdate", "seq")]
    attrs.append(ntz_to_millis(F.col("lastupdate")).alias("lastupdate"))
    message = [F.col("seq").cast("string").alias("rsvp_id")] if numbered else []
    return reports.select(F.to_json(F.struct(*message, F.struct(*attrs).alias("attributes"))).alias("value"))


def report_columns(df: DataFrame) -> DataFrame:
    """Project to the report columns, in order."""
    return df.select(*REPORT_COLUMNS)


REPORTS_TABLE = "reports"
QUARANTINE_TABLE = "quarantine"


def write_report_tables(ingested: Ingested, path: str, partition_by_day: bool = True, ingest_id: str = "0") -> None:
    """Write parsed reports (parquet, by ingest and UTC day of ``lastupdate``) and
    the quarantine under ``path``. Repeating an ingest replaces what the same
    ``ingest_id`` wrote before. Rows are range-partitioned by day and id first,
    so a day is a few files, not one for each task. Parse once with
    ``materialize_parse=True`` when writing both."""
    reports, part = ingested.reports, f"ingest={ingest_id}"
    target = f"{path.rstrip('/')}/{REPORTS_TABLE}/{part}"
    if partition_by_day:
        dated = reports.withColumn("day", F.to_date(F.col("lastupdate")))
        dated.repartitionByRange("day", "id").write.mode("overwrite").partitionBy("day").parquet(target)
    else:
        reports.write.mode("overwrite").parquet(target)
    ingested.quarantine.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{QUARANTINE_TABLE}/{part}")


def read_report_table(spark: SparkSession, path: str) -> DataFrame:
    """Reports of a table written by ``write_report_tables`` (columns in report
    order; the ``day`` partition column is available for pruning)."""
    df = spark.read.parquet(f"{path.rstrip('/')}/{REPORTS_TABLE}")
    extra = [c for c in df.columns if c not in REPORT_COLUMNS]
    return df.select(*REPORT_COLUMNS, *extra)
