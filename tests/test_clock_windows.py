"""Wall-clock windows that close by the clock: a quiet feed, late files, micro-batches
of any size, retried batches."""

import os
import time

import pytest

from fleetreports.sources import parse_messages, read_feed_stream
from fleetreports.streaming import clock_windows as cw
from tests.test_goldens import G4, rec
from tests.test_streaming import landing, msgs

BASE = 1_700_000_040  # a whole minute


def stamped(folder, at):
    for i, name in enumerate(sorted(os.listdir(folder))):
        os.utime(os.path.join(folder, name), (at[i], at[i]))


def run_until(spark, folder, scratch, files, enough, minutes=1, seconds=90):
    """Windows by their last ranking: start -> (revision, rows)."""
    windows, batches = {}, []
    reports = parse_messages(read_feed_stream(spark, folder, max_files_per_trigger=files)).reports

    def sink(df, batch_id):
        batches.append(batch_id)
        got = {}
        for r in df.collect():
            got.setdefault(r.window_start, (r.revision, []))[1].append((r.id, r.delay))
        windows.update(got)

    query = cw.start_clock_windows(reports, sink, f"clock_{files}", minutes=minutes, checkpoint=os.path.join(scratch, "ck"),
                                   trigger={"processingTime": "200 milliseconds"})
    end = time.time() + seconds
    while time.time() < end and not enough(windows) and query.isActive:
        time.sleep(0.3)
    query.stop()
    assert query.exception() is None
    return windows


@pytest.mark.parametrize("files", [1, 10])
def test_last_ranking_does_not_depend_on_micro_batches(spark, scratch_dir, files):
    parts = [G4[:2], G4[2:4], G4[4:6], G4[6:8], G4[8:9], G4[9:]]
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(p) for p in parts])
    stamped(folder, [BASE + s for s in (1, 20, 50, 61, 90, 110)])
    ids = lambda w: [[i for i, _ in rows] for _, (_, rows) in sorted(w.items())]
    want = [["1", "2", "3", "4", "5"], ["10", "8", "6", "5", "2"]]
    assert ids(run_until(spark, folder, scratch_dir, files, lambda w: ids(w) == want)) == want


def test_quiet_feed_closes_its_window_and_late_files_revise_it(spark, scratch_dir):
    """The last window comes out without a later arrival; a file with an older stamp,
    read last, ends up in its window."""
    folder = landing(os.path.join(scratch_dir, "in"),
                     [msgs([rec("a", delay=5, t=1000)]), msgs([rec("b", delay=7, t=2000)]), msgs([rec("late", delay=99, t=3000)])])
    stamped(folder, [BASE + 5, BASE + 130, BASE + 20])
    found = lambda w: sorted((rows for _, rows in w.values()), key=str)
    want = sorted([[("a", 5.0), ("late", 99.0)], [("b", 7.0)]], key=str)
    # one file per micro-batch, in the order of their stamps; then a file stamped long ago
    got = run_until(spark, folder, scratch_dir, 1, lambda w: found(w) == want)
    assert found(got) == want
    path = os.path.join(folder, "batch-9.json")
    with open(path, "w") as f:
        f.write("\n".join(msgs([rec("later", delay=50, t=4000), rec("a", delay=60, t=5000)])) + "\n")
    os.utime(path, (BASE + 21, BASE + 21))
    want[0] = [("late", 99.0), ("later", 50.0), ("a", 60.0)]
    again = run_until(spark, folder, scratch_dir, 1, bool)  # resumes from the checkpoint
    assert [rows for _, rows in again.values()] == [want[0]]
    assert all(revision >= 1 for revision, _ in again.values())


def test_window_stays_open_until_its_time_is_over(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs([rec("now", delay=3, t=1000)])])
    ahead = time.time() + 12
    stamped(folder, [ahead])
    window_end = int(ahead) // 6 * 6 + 6
    got = run_until(spark, folder, scratch_dir, 1, bool, minutes=0.1)
    assert time.time() >= window_end and [rows for _, rows in got.values()] == [[("now", 3.0)]]


def test_a_retried_batch_replaces_its_rows(spark, scratch_dir):
    table = os.path.join(scratch_dir, "closed")
    rows = lambda *r: spark.createDataFrame([(i, "L", d, t, 0, 0, 60_000_000) for i, d, t in r], cw.CLOSED_DDL)
    cw.append_and_rank(rows(("a", 1.0, 1), ("b", 2.0, 2)), 0, table).collect()
    for _ in range(2):
        got = cw.append_and_rank(rows(("a", 9.0, 3), ("c", 4.0, 0)), 1, table).collect()
        assert [(r.id, r.delay, r.revision) for r in got] == [("c", 4.0, 1), ("b", 2.0, 1), ("a", 9.0, 1)]
    assert cw.read_closed(spark, table).count() == 4
    assert cw.append_and_rank(rows(("a", 9.0, 3)).limit(0), 2, table) is None
