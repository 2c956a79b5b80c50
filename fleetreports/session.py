"""Spark session helpers.

Nothing here is needed to *use* the operators on an existing session; these
are the defaults for the CLI job, the tests and the benchmark.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.errors import PySparkAttributeError
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
_STATE_PACKAGE = "org.apache.spark.sql.execution.streaming.state"
_HEAP_STORE = f"{_STATE_PACKAGE}.HDFSBackedStateStoreProvider"
ROCKSDB_CONF = {
    STATE_STORE_CONF: f"{_STATE_PACKAGE}.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "fleetreports", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # PySpark 4 records the Python call site of every Column it builds
        # (a stack walk per call, ~1-2 ms); the job builds plans, not
        # notebooks, so plan building skips it. Errors lose only the Python
        # line reference.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Streaming state (latest report per unit, open windows, gap stamps)
        # grows with the number of units: keep it in RocksDB (off-heap, on
        # local disk, checkpointed incrementally) instead of the JVM heap.
        **ROCKSDB_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    If the session names none, ``fallback`` is set; without one, a fresh
    scratch folder is made only in local mode. On a cluster an unset folder is
    an error: a machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except (AttributeError, PySparkAttributeError):  # sessions without a SparkContext handle (Spark Connect)
        sc = None
    current = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getConf().get(CHECKPOINT_CONF, None) if sc else None)
    if not current:
        if fallback:
            current = fallback
        elif (sc.master if sc is not None else (spark.conf.get("spark.master", "") or "")).startswith("local"):
            current = tempfile.mkdtemp(prefix="fleetreports-ckpt-")
        else:
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (e.g. on the cluster's file system)")
        spark.conf.set(CHECKPOINT_CONF, current)
    if sc is not None and sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(current)
    return current


def stream_checkpoint(spark: SparkSession, query_name: str, location: str | None = None) -> str:
    """Checkpoint location of a streaming query: explicit, else under the
    shared checkpoint folder."""
    if location:
        return location
    return os.path.join(checkpoint_root(spark), "streams", query_name)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside keep their state in RocksDB where the session has
    Spark's default store, on which ``transformWithState`` cannot run. A query copies the
    session's settings as it starts, so they are as before afterwards; a store that the
    session names itself stays."""
    if spark.conf.get(STATE_STORE_CONF) != _HEAP_STORE:
        yield
        return
    before = {k: spark.conf.get(k, None) for k in ROCKSDB_CONF}
    for k, v in ROCKSDB_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df, label: str):
    """Write ``df`` once as a parquet table under the shared checkpoint folder
    and read it back: cuts the lineage (recovery after executor loss reads the
    table, not a recomputation) and gives every consumer the same rows. One
    pass, columnar and compressed, unlike ``Dataset.checkpoint`` which computes
    its input once to count and again to write."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), "fleetreports-tables", f"{label}-{uuid.uuid4().hex}")
    _materialized[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_materialized: dict[str, SparkSession] = {}


def drop_materialized() -> None:
    """Remove the tables that ``materialize`` has written. Lazy results that read
    them must have been consumed. Runs by itself when the process ends."""
    for path in list(_materialized):
        spark = _materialized.pop(path)
        if spark.sparkContext._jsc is not None:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _drop_at_exit() -> None:
    try:
        drop_materialized()
    except (Py4JError, ConnectionError, AttributeError):
        pass  # the session ended first; the files stay in the checkpoint folder
