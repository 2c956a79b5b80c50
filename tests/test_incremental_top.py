"""Global top N on a stream whose work grows with the changed units."""

import os
import random

import pytest
from pyspark.sql import functions as F

from fleetreports import session
from fleetreports.plans import queries as q
from fleetreports.sources import parse_messages
from fleetreports.sources.feed import to_messages
from fleetreports.streaming import incremental_top as it
from fleetreports.streaming import replay
from tests.test_goldens import G3_W1, G3_W2, rec
from tests.test_streaming import landing, msgs, stream_reports


def rankings(spark, folder, scratch_dir, current, n=5, **kw):
    """The ranking after each micro-batch, by id."""
    got = {}
    query = it.start_top(stream_reports(spark, folder), lambda df, i: got.__setitem__(i, [(r.id, r.delay) for r in df.collect()]),
                         f"top-{os.path.basename(scratch_dir)}-{current}", n, current, os.path.join(scratch_dir, f"ck-{current}"),
                         {"availableNow": True}, **kw)
    query.awaitTermination(300)
    assert query.exception() is None
    return [got[i] for i in sorted(got)]


def test_g3(spark, scratch_dir):
    folder = landing(os.path.join(scratch_dir, "in"), [msgs(G3_W1), msgs(G3_W2)])
    first, second = rankings(spark, folder, scratch_dir, False)
    assert [i for i, _ in first] == ["1", "2", "4", "3", "7"]
    assert [i for i, _ in second] == ["1", "2", "4", "3", "5"]
    first, second = rankings(spark, folder, scratch_dir, True)
    assert [i for i, _ in second] == ["2", "4", "3", "5", "6"]


@pytest.mark.parametrize("current", [False, True])
def test_equals_the_batch_form_after_every_micro_batch(spark, scratch_dir, current):
    """Units rise, fall, recover, tie and come late; two spare candidates, so that buckets fill up again."""
    rng, t, batches = random.Random(5), 0, []
    for k in range(5):
        rows = []
        for _ in range(60):
            t += 1000
            unit = 0 if rng.random() < 0.3 else rng.randrange(40)
            rows.append(rec(unit, delay=rng.choice([-5, 0, 1, 7, rng.randrange(1, 90) // (k + 1)]), t=t - (50_000 if rng.random() < 0.1 else 0)))
        batches.append(msgs(rows))
    folder = landing(os.path.join(scratch_dir, "in"), batches)
    got = rankings(spark, folder, scratch_dir, current, buckets=3, spare=2)
    assert len(got) == len(batches)
    batch_form = q.top_delayed_current if current else q.top_delayed
    for k, ranking in enumerate(got):
        paths = [os.path.join(folder, f"batch-{i:04d}.json") for i in range(k + 1)]
        want = [(r.id, r.delay) for r in batch_form(parse_messages(spark.read.text(paths)).reports).collect()]
        assert ranking == want


def test_restart_and_empty_buckets(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "in")
    landing(folder, [msgs([rec(1, delay=9, t=1000), rec(2, delay=8, t=1000)])])
    assert rankings(spark, folder, scratch_dir, True)[-1] == [("1", 9.0), ("2", 8.0)]
    for k, (rows, want) in enumerate([([rec(1, delay=0, t=2000)], [("2", 8.0)]), ([rec(2, delay=-1, t=2000)], []),
                                      ([rec(1, delay=3, t=3000)], [("1", 3.0)])]):
        with open(os.path.join(folder, f"more-{k}.json"), "w") as f:
            f.write("\n".join(msgs(rows)) + "\n")
        assert rankings(spark, folder, scratch_dir, True)[-1] == want


@pytest.mark.parametrize("current", [False, True])
def test_session_with_the_default_state_store(spark, scratch_dir, current):
    """A session that knows nothing of RocksDB: the query runs, restarts, and leaves the settings as they were."""
    folder = os.path.join(scratch_dir, "in")
    before = {k: spark.conf.get(k, None) for k in session.ROCKSDB_CONF}
    try:
        for k in before:
            spark.conf.unset(k)
        spark.conf.set(session.STATE_STORE_CONF, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
        plain = {k: spark.conf.get(k, None) for k in before}
        landing(folder, [msgs([rec(1, delay=9, t=1000), rec(2, delay=8, t=1000)])])
        assert rankings(spark, folder, scratch_dir, current)[-1] == [("1", 9.0), ("2", 8.0)]
        with open(os.path.join(folder, "more.json"), "w") as f:
            f.write("\n".join(msgs([rec(1, delay=2, t=2000)])) + "\n")
        assert rankings(spark, folder, scratch_dir, current)[-1] == [("2", 8.0), ("1", 2.0)]
        assert {k: spark.conf.get(k, None) for k in before} == plain
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_repeated_micro_batch_and_versions_kept(spark, scratch_dir):
    table = os.path.join(scratch_dir, "tops")
    row = lambda bucket, unit, delay: (bucket, unit, "L", delay, 1000, 1)
    gone = (1, None, None, None, None, None)
    batches = [[row(0, "a", 5.0), row(1, "b", 4.0)], [row(0, "c", 6.0), row(0, "a", 5.0)], [gone], [row(1, "b", 1.0)]]
    want = [["a", "b"], ["c", "a", "b"], ["c", "a"], ["c", "a", "b"]]
    for k, rows in enumerate(batches):
        for _ in range(2):  # a repeated micro-batch replaces its own
            got = it.rank_tops(it.merge_tops(spark.createDataFrame(rows, it.TOPS_DDL), k, table))
            assert [r.id for r in got.collect()] == want[k]
    assert it._versions(spark, table) == [2, 3]


@pytest.mark.parametrize("current", [False, True])
def test_replay_breaks_ties_by_the_reports_own_number(spark, current):
    """Forty units with one delay and stamp, and two reports of each, equal but for linename and number."""
    sent = [rec(u, delay=9, t=1000, name=turn) for u in range(40) for turn in ("a", "b")]
    reports = parse_messages(spark.createDataFrame([(m,) for m in msgs(sent)], "value string")).reports
    reports = reports.withColumn("seq", F.expr("IF(linename = 'a', 7, 100) * 1000 - CAST(id AS bigint) * 11"))
    batch_form = q.top_delayed_current if current else q.top_delayed
    want = [tuple(r) for r in batch_form(reports).collect()]
    assert [tuple(r) for r in replay.top_delayed(reports, current=current).collect()] == want
    assert [r[0] for r in want] == ["39", "38", "37", "36", "35"] and {r[1] for r in want} == {"b"}


def test_numbered_messages(spark):
    """A report without a number has none in its message and takes the order of arrival."""
    reports = parse_messages(spark.createDataFrame([(m,) for m in msgs([rec(1), rec(2)])], "value string")).reports
    value = to_messages(reports.withColumn("seq", F.expr("IF(id = '1', 5L, NULL)")), numbered=True)
    got = {r.id: r.seq for r in replay._reports(value, True).collect()}
    assert got["1"] == 5 and got["2"] is not None
