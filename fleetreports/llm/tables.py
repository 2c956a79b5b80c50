"""Intermediate tables in the cluster's shared checkpoint folder.

``stored`` writes a DataFrame once as parquet below ``spark.checkpoint.dir``
and reads it back: later stages, and recomputation after a lost executor,
start from the files. ``dropped`` removes one such table as soon as nothing
reads it any more; those that a returned lazy result still reads are removed
when the Python process ends, or earlier by ``drop_all``.
"""

from __future__ import annotations

import atexit
import gc
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from fleetreports.session import checkpoint_root

_open: dict[str, SparkSession] = {}


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table of the shared folder, and read back."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/fleetreports-llm/{label}-{uuid.uuid4().hex}"
    _open[path] = spark
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def dropped(*tables: DataFrame | None) -> None:
    """Remove tables made by ``stored`` that nothing reads any more."""
    for t in tables:
        path = getattr(t, "stored_path", None)
        if path and path in _open:
            _delete(_open.pop(path), path)


def released(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps: it does so
    when the driver collects its garbage, which it would do late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_all() -> None:
    """Remove every table that ``stored`` made and that still exists."""
    for path in list(_open):
        spark = _open.pop(path)
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


@atexit.register
def _at_exit() -> None:
    try:
        drop_all()
    except (Py4JError, ConnectionError, AttributeError):
        pass  # the session has ended before; its files stay in the checkpoint folder
