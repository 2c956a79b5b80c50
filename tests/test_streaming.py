"""Streaming forms: goldens replayed as ordered files (one per micro-batch),
late data, and stream = batch parity on the driver's events table."""

import os
import time

import pytest
from pyspark.sql import functions as F

from fleetreports.plans import queries as q
from fleetreports.sources import event_reports, parse_messages, read_feed_stream, record_message, to_messages
from fleetreports.streaming import queries as sq
from fleetreports.streaming import sinks
from tests.test_goldens import G2_W1, G2_W2, G3_W1, G3_W2, G4, G6_EXPECT, g6_records, rec


def landing(folder, batches):
    """Write one file per micro-batch, with increasing modification times."""
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, lines in enumerate(batches):
        path = os.path.join(folder, f"batch-{i:04d}.json")
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (base + i, base + i))
    return folder


def stream_reports(spark, folder):
    return parse_messages(read_feed_stream(spark, folder, max_files_per_trigger=1)).reports


def run_collect(df, mode, ckpt, step=None):
    """Run to completion (availableNow) collecting every micro-batch's rows."""
    batches = []

    def collect(batch, batch_id):
        out = step(batch) if step else batch
        batches.append((batch_id, [r.asDict() for r in out.collect()]))

    qry = (df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
           .trigger(availableNow=True).foreachBatch(collect).start())
    qry.awaitTermination(300)
    assert qry.exception() is None
    return [rows for _, rows in sorted(batches, key=lambda b: b[0])]


def msgs(records):
    return [record_message(r) for r in records]


def test_g2_trains_snapshots(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(G2_W1), msgs(G2_W2)])
    df, mode = sq.trains_last_stop_stream(stream_reports(spark, folder))
    assert mode == "complete"
    snaps = [b for b in run_collect(df, mode, os.path.join(scratch_dir, "ck")) if b]
    order = lambda rows: [r["id"] for r in sorted(rows, key=lambda r: (r["lastupdate"], r["id"]))]
    assert order(snaps[0]) == ["1", "2", "3", "4"]
    assert [r["id"] for r in snaps[1]] == ["2", "4", "1", "3", "5"]  # oldest update first
    assert {r["id"]: r["laststopid"] for r in snaps[1]}["1"] == 20


def test_g3_top5_snapshots(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(G3_W1), msgs(G3_W2)])
    reports = stream_reports(spark, folder)
    df, mode = sq.top_delayed_stream(reports)
    snaps = [b for b in run_collect(df, mode, os.path.join(scratch_dir, "ck1")) if b]
    assert [r["id"] for r in snaps[0]] == ["1", "2", "4", "3", "7"]
    assert [r["id"] for r in snaps[1]] == ["1", "2", "4", "3", "5"]
    df, mode = sq.top_delayed_current_stream(reports)
    snaps = [b for b in run_collect(df, mode, os.path.join(scratch_dir, "ck2")) if b]
    assert [r["id"] for r in snaps[1]] == ["2", "4", "3", "5", "6"]


def test_g4_top5_per_window_stream(spark, scratch_dir):
    closing = [rec(99, delay=1, t=500000)]  # moves the watermark past both windows
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(G4[:6]), msgs(G4[6:]), msgs(closing)])
    latest, mode = sq.window_latest_stream(stream_reports(spark, folder), minutes=1)
    batches = run_collect(latest, mode, os.path.join(scratch_dir, "ck"), step=sq.top_of_closed_windows)
    emitted = [[r["id"] for r in b] for b in batches if b]
    assert emitted == [["1", "2", "3", "4", "5"], ["10", "8", "6", "5", "2"]]


def test_g5_average_stream(spark, scratch_dir):
    w1 = [rec(i, delay=d, t=10000) for i, d in enumerate([100, 60, 10, 50, 1, 8])]
    w2 = [rec(i, delay=d, t=70000) for i, d in enumerate([5, 100, 70, 45, 15, 5])]
    closing = [rec(99, delay=0, t=130000)]
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(w1), msgs(w2), msgs(closing)])
    got = []

    def start(df, mode):
        return (df.writeStream.outputMode(mode).option("checkpointLocation", os.path.join(scratch_dir, "ck"))
                .trigger(availableNow=True).foreachBatch(lambda b, i: got.extend(b.collect())).start())

    qry = sinks.start_average_delay(stream_reports(spark, folder), start, minutes=1)
    qry.awaitTermination(300)
    assert spark.conf.get(sq.ALLOW_MULTIPLE_CONF) == "true"  # restored
    assert [r.avg_delay for r in sorted(got, key=lambda r: r.window_start)] == [229 / 6, 40.0]


LATE = [[(1, 100, 10000), (5, 8, 11000)], [(6, 5, 70000)], [(9, 999, 30000)],
        [(9, 999, 31000), (1, 0, 190000)], [(9, 999, 32000)]]


def test_late_rows_are_dropped(spark, scratch_dir):
    batches = [msgs([rec(i, delay=d, t=t) for i, d, t in b]) for b in LATE]
    folder = landing(os.path.join(scratch_dir, "in"), batches)
    got = []

    def start(df, mode):
        return (df.writeStream.outputMode(mode).option("checkpointLocation", os.path.join(scratch_dir, "ck"))
                .trigger(availableNow=True).foreachBatch(lambda b, i: got.extend(b.collect())).start())

    sinks.start_average_delay(stream_reports(spark, folder), start, minutes=1).awaitTermination(300)
    first = min(got, key=lambda r: r.window_start)
    assert first.avg_delay == 54.0


@pytest.mark.parametrize("split", [1, 3])
def test_g6_gap_stream(spark, scratch_dir, split):
    lines = msgs(g6_records())
    size = -(-len(lines) // split)
    folder = landing(os.path.join(scratch_dir, "in"), [lines[i:i + size] for i in range(0, len(lines), size)])
    df, mode = sq.report_gap_stream(stream_reports(spark, folder), n=5)
    rows = [r for b in run_collect(df, mode, os.path.join(scratch_dir, "ck")) for r in b]
    got = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["lastupdate"], r["seq"])):
        got.setdefault(r["id"], []).append(r["avg_gap_s"])
    assert got == G6_EXPECT


def test_gap_stream_equals_batch_on_events(spark, scratch_dir):
    reports = event_reports(spark, "/root/testdata/sf0.001")
    lines = [r.value for r in to_messages(reports.orderBy("lastupdate", "seq")).collect()]
    folder = landing(os.path.join(scratch_dir, "in"), [lines[i:i + 250] for i in range(0, len(lines), 250)])
    df, mode = sq.report_gap_stream(stream_reports(spark, folder), n=10)
    streamed = sorted((r["id"], r["lastupdate"], r["avg_gap_s"]) for b in
                      run_collect(df, mode, os.path.join(scratch_dir, "ck")) for r in b)
    batch = sorted((r.id, r.lastupdate, r.avg_gap_s) for r in q.report_gap(reports).collect())
    # the feed carries epoch milliseconds: compare on the same resolution
    trunc = lambda rows: [(i, t.replace(microsecond=t.microsecond // 1000 * 1000), g) for i, t, g in rows]  # noqa
    assert trunc(streamed) == trunc(batch)


def test_north_text_sink(spark, scratch_dir):
    rows = [rec(1, bearing=340, t=1000), rec(2, bearing=90, t=1000)]
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(rows)])
    df, mode = sq.north_stream(stream_reports(spark, folder))
    out = os.path.join(scratch_dir, "out")
    qry = sinks.start_text(df, "report", out, "north_text", os.path.join(scratch_dir, "ck"),
                           trigger={"availableNow": True})
    qry.awaitTermination(300)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 1 and lines[0].startswith("Vehicle{id='1', vtype=1, ltype=1, lat=0.0")
    assert lines[0].endswith("lastupdate=Thu Jan 01 00:00:01 UTC 1970'}")


def test_snapshot_sink_is_idempotent_per_batch(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(G3_W1), msgs(G3_W2)])
    df, mode = sq.top_delayed_stream(stream_reports(spark, folder))
    out = os.path.join(scratch_dir, "out")
    qry = sinks.start_snapshot(df, mode, out, "top5_snap", kind="top", checkpoint=os.path.join(scratch_dir, "ck"),
                               trigger={"availableNow": True})
    qry.awaitTermination(300)
    last = sorted(d for d in os.listdir(out) if d.startswith("batch="))[-1]
    lines = sorted(r.value for r in spark.read.text(os.path.join(out, last)).collect())
    assert len(lines) == 5 and all(line.startswith("ID:") for line in lines)


def test_average_stream_equals_batch_on_events(spark, scratch_dir):
    reports = event_reports(spark, "/root/testdata/sf0.001")
    lines = [r.value for r in to_messages(reports.orderBy("lastupdate", "seq")).collect()]
    folder = landing(os.path.join(scratch_dir, "in"), [lines[i:i + 200] for i in range(0, len(lines), 200)])
    got = []

    def start(df, mode):
        return (df.writeStream.outputMode(mode).option("checkpointLocation", os.path.join(scratch_dir, "ck"))
                .trigger(availableNow=True).foreachBatch(lambda b, i: got.extend(b.collect())).start())

    sinks.start_average_delay(stream_reports(spark, folder), start, minutes=3).awaitTermination(300)
    streamed = {r.window_start: r.avg_delay for r in got}
    batch = {r.window_start: r.avg_delay for r in q.average_delay(reports, 3).collect()}
    last_open = max(batch)  # the newest window never closes without later data
    assert streamed == {w: a for w, a in batch.items() if w != last_open}


@pytest.mark.parametrize("files", [1, 2, 10])
def test_live_window_does_not_depend_on_micro_batches(spark, scratch_dir, files):
    # two arrival windows of three files each, and a later arrival that closes them
    parts = [G4[:2], G4[2:4], G4[4:6], G4[6:8], G4[8:9], G4[9:], [rec(99, delay=1)]]
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(p) for p in parts])
    base = 1_700_000_040
    for i, name in enumerate(sorted(os.listdir(folder))):
        at = base + [1, 20, 50, 61, 90, 110, 400][i]
        os.utime(os.path.join(folder, name), (at, at))
    got = []
    reports = parse_messages(read_feed_stream(spark, folder, max_files_per_trigger=files)).reports
    sinks.start_top_delayed_window_live(
        reports, lambda df, i: got.extend(df.collect()), "live_top", minutes=1,
        checkpoint=os.path.join(scratch_dir, "ck"), trigger={"availableNow": True},
    ).awaitTermination(300)
    assert [r.id for r in got] == ["1", "2", "3", "4", "5"] + ["10", "8", "6", "5", "2"]
    assert {(r.window_end - r.window_start).total_seconds() for r in got} == {60}


def test_gap_stream_resumes_from_checkpoint(spark, scratch_dir):
    records = g6_records()
    half = len(records) // 2
    folder = os.path.join(scratch_dir, "in")
    ckpt = os.path.join(scratch_dir, "ck")
    landing(folder, [msgs(records[:half])])
    first = run_collect(sq.report_gap_stream(stream_reports(spark, folder), n=5)[0], "append", ckpt)
    # a new file arrives after the query stopped; a new run resumes from the checkpoint
    path = os.path.join(folder, "batch-0001.json")
    with open(path, "w") as f:
        f.write("\n".join(msgs(records[half:])) + "\n")
    second = run_collect(sq.report_gap_stream(stream_reports(spark, folder), n=5)[0], "append", ckpt)
    rows = [r for b in first + second for r in b]
    assert len(rows) == len(records)  # nothing replayed twice, nothing lost
    got = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["lastupdate"], r["seq"])):
        got.setdefault(r["id"], []).append(r["avg_gap_s"])
    assert got == G6_EXPECT


def test_top5_snapshot_state_survives_restart(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "in")
    ckpt = os.path.join(scratch_dir, "ck")
    landing(folder, [msgs(G3_W1)])
    first = run_collect(sq.top_delayed_current_stream(stream_reports(spark, folder))[0], "complete", ckpt)
    assert [r["id"] for r in first[-1]] == ["1", "2", "4", "3", "7"]
    with open(os.path.join(folder, "batch-0001.json"), "w") as f:
        f.write("\n".join(msgs(G3_W2)) + "\n")
    second = run_collect(sq.top_delayed_current_stream(stream_reports(spark, folder))[0], "complete", ckpt)
    assert [r["id"] for r in second[-1]] == ["2", "4", "3", "5", "6"]  # unit 1 recovered to 0 after restart


def test_state_store_holds_the_latest_report_of_each_unit(spark, scratch_dir):
    """What the checkpoint holds, read with Spark's state readers, is the latest report per unit of all
    input so far, also after a restart; and the number of state partitions stays that of the first start."""
    folder, ckpt = os.path.join(scratch_dir, "in"), os.path.join(scratch_dir, "ck")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for k, records in enumerate((G3_W1, G3_W2)):
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"batch-{k:04d}.json"), "w") as f:
            f.write("\n".join(msgs(records)) + "\n")
        try:
            spark.conf.set("spark.sql.shuffle.partitions", str(3 + k))  # a later setting does not change the state
            run_collect(sq.top_delayed_current_stream(stream_reports(spark, folder))[0], "complete", ckpt)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
        (operator,) = spark.read.format("state-metadata").load(ckpt).where("stateStoreName = 'default'").collect()
        assert operator.numPartitions == 3
        state = spark.read.format("statestore").load(ckpt)
        held = {r.id: r.m for r in state.selectExpr("key.id", "to_json(value) AS m").collect()}
        reports = parse_messages(spark.read.text(folder)).reports
        want = {r.id: r for r in q.latest_per_key(q.active(reports), ["id"], columns=["linename", "delay"]).collect()}
        assert set(held) == set(want)
        assert all(f'"delay":{want[i].delay}' in m and f'"linename":"{want[i].linename}"' in m for i, m in held.items())
