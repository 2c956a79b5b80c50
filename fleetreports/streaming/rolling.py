"""Text files that roll by size and by time.

``rolling_text`` is a streaming sink (a Python data source on Arrow batches): every
task writes its lines into part files and begins a new one when the next line would
take the file over ``rollBytes`` (1 MiB), or when the file is ``rollSeconds`` (10 s)
old. A micro-batch is committed by one small file ``_rolled/<batch id>.json`` that
lists its part files. ``read_rolled`` reads what is listed, so part files of a failed
or repeated attempt are never seen; a batch that is committed again replaces its list
and removes the part files of the list before.

Paths are opened through ``pyarrow.fs`` (local, HDFS, S3, GCS), by the tasks themselves;
on a cluster the folder must be a shared one.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from fleetreports.functions.render import render
from fleetreports.session import stream_checkpoint

FORMAT = "rolling_text"
ROLL_BYTES, ROLL_SECONDS = 1 << 20, 10.0
LOG = "_rolled"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class PartFiles(WriterCommitMessage):
    names: list[str]


class _Roll:
    """The open part file of one task."""

    def __init__(self, path: str, most: int, seconds: float):
        self.fs, self.path = _store(path)
        self.most, self.seconds = most, seconds
        self.task, self.names, self.out = uuid.uuid4().hex, [], None

    def line(self, text: str) -> None:
        data = text.encode() + b"\n"
        if self.out is not None and (self.size + len(data) > self.most or time.monotonic() - self.since >= self.seconds):
            self.close()
        if self.out is None:
            name = f"part-{self.task}-{len(self.names):05d}.txt"
            self.out, self.size, self.since = self.fs.open_output_stream(f"{self.path}/{name}"), 0, time.monotonic()
            self.names.append(name)
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class RollingTextWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.most = int(options.get("rollbytes", ROLL_BYTES))
        self.seconds = float(options.get("rollseconds", ROLL_SECONDS))
        fs, path = _store(self.path)
        fs.create_dir(f"{path}/{LOG}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartFiles:
        roll = _Roll(self.path, self.most, self.seconds)
        try:
            for batch in iterator:
                for text in batch.column(0):
                    if text.is_valid:
                        roll.line(text.as_py())
        finally:
            roll.close()
        return PartFiles(roll.names)

    def _remove(self, names: list[str]) -> None:
        fs, path = _store(self.path)
        for name in names:
            if fs.get_file_info(f"{path}/{name}").type != pafs.FileType.NotFound:
                fs.delete_file(f"{path}/{name}")

    def commit(self, messages: list[PartFiles | None], batchId: int) -> None:
        fs, path = _store(self.path)
        names = [name for m in messages if m is not None for name in m.names]
        log = f"{path}/{LOG}/{batchId}.json"
        before = []
        if fs.get_file_info(log).type != pafs.FileType.NotFound:  # the batch ran before
            with fs.open_input_stream(log) as f:
                before = json.loads(f.read())
        with fs.open_output_stream(f"{log}.new") as f:
            f.write(json.dumps(names).encode())
        fs.move(f"{log}.new", log)
        self._remove([name for name in before if name not in names])

    def abort(self, messages: list[PartFiles | None], batchId: int) -> None:
        self._remove([name for m in messages if m is not None for name in m.names])


class RollingText(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> RollingTextWriter:
        return RollingTextWriter({k.lower(): v for k, v in self.options.items()})


def start_rolling(df: DataFrame, kind: str, path: str, name: str, checkpoint: str | None = None, trigger: dict | None = None,
                  roll_bytes: int = ROLL_BYTES, roll_seconds: float = ROLL_SECONDS) -> StreamingQuery:
    """Rendered lines of an append-mode result into part files of at most
    ``roll_bytes`` (but for a single longer line) and ``roll_seconds``."""
    df.sparkSession.dataSource.register(RollingText)
    writer = (render(df, kind).writeStream.format(FORMAT).outputMode("append").queryName(name)
              .option("checkpointLocation", stream_checkpoint(df.sparkSession, name, checkpoint))
              .option("path", path).option("rollBytes", roll_bytes).option("rollSeconds", roll_seconds))
    return writer.trigger(**(trigger or {"processingTime": f"{int(ROLL_SECONDS)} seconds"})).start()


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """The committed lines (column ``value``) of a folder of rolled files."""
    fs, at = _store(path.rstrip("/"))
    names = []
    for info in fs.get_file_info(pafs.FileSelector(f"{at}/{LOG}", allow_not_found=True)):
        if info.path.endswith(".json"):
            with fs.open_input_stream(info.path) as f:
                names += json.loads(f.read())
    if not names:
        return spark.createDataFrame([], "value string")
    return spark.read.text([f"{path.rstrip('/')}/{name}" for name in sorted(names)])
