"""Rolling text files: size, time, repeated and failed batches; repeats in the feed;
memory of the gap's state function."""

import json
import os
import time
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from fleetreports.operators import without_repeats
from fleetreports.sources import parse_messages, read_feed_stream
from fleetreports.streaming import queries as sq
from fleetreports.streaming import rolling
from tests.test_goldens import rec
from tests.test_streaming import landing, msgs


def parts(path):
    return {f: os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-")}


def test_files_roll_by_size_and_restart(spark, scratch_dir):
    records = [[rec(i, bearing=10, t=1000 + i) for i in range(k, k + 40)] for k in (0, 40)]
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(r) for r in records])
    out, ck = os.path.join(scratch_dir, "out"), os.path.join(scratch_dir, "ck")

    def run():
        reports = parse_messages(read_feed_stream(spark, folder, max_files_per_trigger=1)).reports
        q = rolling.start_rolling(sq.north_stream(reports)[0], "report", out, "rolling", ck, {"availableNow": True}, roll_bytes=2000)
        q.awaitTermination(200)
        assert q.exception() is None
        return sorted(r.value for r in rolling.read_rolled(spark, out).collect())

    lines = run()
    assert len(lines) == 80 and len(set(lines)) == 80
    sizes = parts(out)
    assert len(sizes) > 5 and max(sizes.values()) <= 2000
    # the last batch again, as after a crash between the sink's commit and Spark's
    os.unlink(os.path.join(ck, "commits", "1"))
    crc = os.path.join(ck, "commits", ".1.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    assert run() == lines
    listed = [n for f in os.listdir(os.path.join(out, rolling.LOG)) if f.endswith(".json") for n in json.load(open(os.path.join(out, rolling.LOG, f)))]
    assert sorted(listed) == sorted(parts(out))  # nothing of the first attempt is left


def batch(*lines):
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


def test_rolls_by_time_and_keeps_long_lines(spark, scratch_dir):
    out = os.path.join(scratch_dir, "o")
    w = rolling.RollingTextWriter({"path": out, "rollbytes": "10", "rollseconds": "0.2"})

    def slow():
        yield batch("a", None, "b")
        time.sleep(0.3)
        yield batch("c", "x" * 50, "", "é")

    first = w.write(slow())
    assert [open(os.path.join(out, n), encoding="utf-8").read() for n in first.names] == ["a\nb\n", "c\n", "x" * 50 + "\n", "\né\n"]
    w.commit([first, None], 0)
    failed = w.write(iter([batch("z")]))
    w.abort([failed], 1)
    assert sorted(parts(out)) == sorted(first.names)
    assert w.write(iter([])).names == []
    assert sorted(r.value for r in rolling.read_rolled(spark, out).collect()) == sorted(["a", "b", "c", "x" * 50, "", "é"])
    assert rolling.read_rolled(spark, os.path.join(scratch_dir, "none")).collect() == []


def test_repeats_are_dropped_on_streams_and_batches(spark, scratch_dir):
    a, b = rec("1", delay=3, t=1000), rec("1", delay=4, t=1000)
    folder = landing(os.path.join(scratch_dir, "in"), [msgs([a, b, a]), msgs([b]), msgs([rec("2", t=5), a])])
    got = []
    reports = parse_messages(read_feed_stream(spark, folder, max_files_per_trigger=1)).reports
    (without_repeats(reports).writeStream.option("checkpointLocation", os.path.join(scratch_dir, "ck")).trigger(availableNow=True)
     .foreachBatch(lambda df, i: got.extend((r.id, r.delay) for r in df.collect())).start().awaitTermination(200))
    assert sorted(got) == [("1", 3.0), ("1", 4.0), ("2", 0.0)]


class _State:
    exists, get = False, None

    def update(self, value):
        self.get = value


def test_gap_state_of_a_hot_unit_is_small():
    """Two million reports of one unit in shuffled chunks of 10,000."""
    n, size = 2_000_000, 10_000
    order = np.random.Generator(np.random.PCG64(1)).permutation(n)

    def chunks():
        for at in range(0, n, size):
            seq = order[at:at + size].astype(np.int64)
            yield pd.DataFrame({"id": ["unit"] * len(seq), "seq": seq, "_us": 1_700_000_000_000_000 + seq // 2 * 2_000_000})

    state = _State()
    tracemalloc.start()
    seen, last = 0, None
    for out in sq._gap_state_function(10)(("unit",), chunks(), state):
        assert len(out) <= sq.GAP_OUTPUT_ROWS and (np.diff(out["seq"]) == 1).all()
        seen, last = seen + len(out), out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n and len(state.get[0]) == 9 and last["avg_gap_s"].iloc[-1] == 8000 / 9 / 1000  # stamps come in pairs
    assert peak < 200e6  # 100 bytes a row; the rows themselves are some 300 as JSON
