"""Top N of all units on a stream, with work that grows with the changed units.

The complete-mode forms in ``streaming.queries`` sort every unit again on each
trigger. Here the units are dealt into buckets by a hash of their id, and a trigger
touches only the buckets, and in them only the units, that got a report:

1. *Combine*: each Arrow batch of a task keeps its latest report per unit, so a unit
   that holds most of a micro-batch sends a row per Arrow batch, not all its rows.
2. *Bucket state* (``transformWithState``): each unit's latest report in a map state,
   read and written one unit at a time, and beside it an ordered list of candidates,
   the first units of the bucket. A changed unit leaves the list and enters again at
   its new place; a unit that ranks behind the last candidate stays out. When falling
   units have left fewer than N candidates, the list is filled again from the bucket's
   units, which takes at least ``SPARE`` such falls. A bucket whose first N
   changed emits them.
3. *Merge* (``foreachBatch``): the buckets' first N, one small table of at most
   ``buckets * N`` rows, are updated by the emitted buckets and ranked. The table is
   written once per micro-batch below the checkpoint, so a restart goes on with it and
   a retried micro-batch replaces its own.

The result after each micro-batch is that of the complete-mode form. Ties as there:
``delay`` descending, then ``lastupdate``, ``seq``, ``id``.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fleetreports.defaults import SNAPSHOT_INTERVAL, TOP_N
from fleetreports.functions.coerce import instant_to_ntz, ntz_to_micros
from fleetreports.operators.filters import active, delayed
from fleetreports.operators.topn import top_n
from fleetreports.schema import TOP_COLUMNS
from fleetreports.session import rocksdb_state, stream_checkpoint

BUCKETS = 256  # fixed at a query's first start, as the state partitions are
SPARE = 64  # candidates kept beyond N

_UNIT = "linename string, delay double, lastupdate_us bigint, seq bigint"
_ROW_DDL = f"bucket int, id string, {_UNIT}"
#: A bucket's first units; one row without id and delay where a bucket has none any more.
TOPS_DDL = _ROW_DDL
_COLUMNS = ["bucket", "id", "linename", "delay", "lastupdate_us", "seq"]


def _latest_of(chunk: pd.DataFrame) -> pd.DataFrame:
    return chunk.sort_values(["lastupdate_us", "seq"], kind="stable").drop_duplicates("id", keep="last")


def _combine(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for chunk in chunks:
        yield _latest_of(chunk)


class BucketTop(StatefulProcessor):
    """The latest report of each unit of a bucket, and the bucket's first units in order.

    The candidates are always the first units of the bucket (all others rank behind the
    last of them); ``whole`` says that they are all units that can be ranked."""

    def __init__(self, n: int, spare: int, positive_only: bool) -> None:
        self.n, self.most, self.positive_only = n, n + spare, positive_only

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.units = handle.getMapState("units", "id string", _UNIT)
        self.candidates = handle.getValueState(
            "candidates", "delay array<double>, lastupdate_us array<bigint>, seq array<bigint>, id array<string>, "
            "linename array<string>, whole boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, whole = self._read()
        before = first[:self.n]
        for chunk in rows:
            for r in _latest_of(chunk).itertuples(index=False):
                new = (r.linename, float(r.delay), int(r.lastupdate_us), int(r.seq))
                old = self.units.getValue((r.id,)) if self.units.containsKey((r.id,)) else None
                if old is not None and tuple(old[2:]) > new[2:]:
                    continue
                self.units.updateValue((r.id,), new)
                if old is not None:
                    gone = self._entry(r.id, tuple(old))
                    at = bisect.bisect_left(first, gone)
                    if at < len(first) and first[at] == gone:
                        del first[at]
                if self.positive_only and not new[1] > 0:
                    continue
                mine = self._entry(r.id, new)
                if whole or (first and mine < first[-1]):
                    bisect.insort(first, mine)
                    if len(first) > self.most:
                        first.pop()
                        whole = False
        if len(first) < self.n and not whole:
            all_of = (self._entry(k[0], tuple(v)) for k, v in self.units.iterator())
            first = heapq.nsmallest(self.most + 1, (e for e in all_of if not self.positive_only or e[0] < 0))
            whole = len(first) <= self.most
            del first[self.most:]
        self._write(first, whole)
        if first[:self.n] != before:
            out = [(key[0], i, name, -delay, us, seq) for delay, us, seq, i, name in first[:self.n]]
            yield pd.DataFrame(out or [(key[0], None, None, None, None, None)], columns=_COLUMNS)

    @staticmethod
    def _entry(unit: str, value: tuple) -> tuple:
        linename, delay, us, seq = value
        return (-delay, us, seq, unit, linename)

    def _read(self) -> tuple[list[tuple], bool]:
        if not self.candidates.exists():
            return [], True
        delay, us, seq, unit, name, whole = self.candidates.get()
        return list(zip((-d for d in delay), us, seq, unit, name, strict=True)), whole

    def _write(self, first: list[tuple], whole: bool) -> None:
        delay, us, seq, unit, name = ([e[i] for e in first] for i in range(5))
        self.candidates.update(([-d for d in delay], us, seq, unit, name, whole))

    def close(self) -> None:
        pass


def bucket_tops_stream(reports: DataFrame, n: int = TOP_N, current: bool = False, buckets: int = BUCKETS,
                       spare: int = SPARE) -> tuple[DataFrame, str]:
    """The first ``n`` units of every bucket that changed. ``current``: by each unit's latest
    report; otherwise by its latest delayed report (see ``plans.queries``)."""
    rows = active(reports) if current else delayed(active(reports))
    rows = rows.select(F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("bucket"), "id", "linename", "delay",
                       ntz_to_micros(F.col("lastupdate")).alias("lastupdate_us"), "seq")
    out = rows.mapInPandas(_combine, _ROW_DDL).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=BucketTop(n, spare, current), outputStructType=TOPS_DDL, outputMode="update", timeMode="none")
    return out, "update"


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _versions(spark: SparkSession, table: str) -> list[int]:
    """Micro-batches that have a merged table; all but the latest are committed."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/batch=*")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    return sorted(int(f.getPath().getName().split("=")[1]) for f in found)


def merge_tops(batch: DataFrame, batch_id: int, table: str) -> DataFrame:
    """The buckets' first units after this micro-batch: its buckets, and the others as the
    micro-batch before left them. Kept: this version and the one before."""
    spark = batch.sparkSession
    versions = [v for v in _versions(spark, table) if v < batch_id]
    tops = batch
    if versions:
        before = spark.read.schema(TOPS_DDL).parquet(f"{table}/batch={versions[-1]}")
        changed = batch.select("bucket").distinct()
        tops = before.join(changed, "bucket", "left_anti").select(*_COLUMNS).unionByName(batch)
    target = f"{table}/batch={batch_id}"
    tops.where("id is not null").coalesce(1).write.mode("overwrite").parquet(target)  # at most buckets * n rows
    for old in versions[:-1]:
        _delete(spark, f"{table}/batch={old}")
    return spark.read.schema(TOPS_DDL).parquet(target)


def rank_tops(tops: DataFrame, n: int = TOP_N) -> DataFrame:
    rows = tops.withColumn("lastupdate", instant_to_ntz(F.timestamp_micros("lastupdate_us")))
    return top_n(rows, n).select(*TOP_COLUMNS)


def start_top(reports: DataFrame, sink: Callable[[DataFrame, int], None], name: str, n: int = TOP_N, current: bool = False,
              checkpoint: str | None = None, trigger: dict | None = None, buckets: int = BUCKETS,
              spare: int = SPARE) -> StreamingQuery:
    """Global top ``n``: ``sink(df, batch_id)`` gets the whole ranking after each micro-batch."""
    rows, mode = bucket_tops_stream(reports, n, current, buckets, spare)
    checkpoint = stream_checkpoint(reports.sparkSession, name, checkpoint)
    table = f"{checkpoint}-tops"

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the changed buckets' first units, used twice
        try:
            sink(rank_tops(merge_tops(batch, batch_id, table), n), batch_id)
        finally:
            batch.unpersist()

    writer = rows.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", checkpoint)
    with rocksdb_state(reports.sparkSession):
        return writer.trigger(**(trigger or {"processingTime": SNAPSHOT_INTERVAL})).foreachBatch(step).start()
