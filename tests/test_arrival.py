"""``seq`` is the order of arrival: file stamp, then file, then line."""

import os

import pytest

from fleetreports.plans import queries as q
from fleetreports.sources import feed, ingest, parse_messages, read_feed_stream, read_report_table, write_report_tables
from fleetreports.streaming import queries as sq
from tests.test_goldens import rec
from tests.test_streaming import msgs, run_collect

BASE = 1_700_000_000


def put(folder, files):
    """name -> (seconds after BASE, lines)"""
    os.makedirs(folder, exist_ok=True)
    for name, (second, lines) in files.items():
        path = os.path.join(folder, name)
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (BASE + second, BASE + second))
    return folder


def unit_lines(first, many):
    return msgs([rec(first + k, t=1000) for k in range(many)])


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("materialized", [False, True])
def test_order_over_files_and_splits(spark, scratch_dir, small_splits, materialized):
    """A small old file, a large new one and two of one second, whose lines take many splits."""
    folder = put(os.path.join(scratch_dir, "in"), {
        "z-first.json": (0, unit_lines(0, 3)), "a-last.json": (20, unit_lines(1000, 400)),
        "n.json": (10, unit_lines(300, 100)), "m.json": (10, unit_lines(100, 200))})
    rows = ingest(spark, folder, materialize_parse=materialized).reports.select("id", "seq").collect()
    assert spark.read.text(folder).rdd.getNumPartitions() > 10
    assert len({r.seq for r in rows}) == 703 == len(rows)
    assert [int(r.id) for r in sorted(rows, key=lambda r: r.seq)] == [0, 1, 2, *range(100, 400), *range(1000, 1400)]
    seq = {int(r.id): r.seq for r in rows}
    assert seq[100] == (BASE + 10) * 1000 << 20 and seq[300] == seq[100] + 200 and seq[1399] == ((BASE + 20) * 1000 << 20) + 399


def test_full_stamp_runs_on(spark, scratch_dir, monkeypatch):
    monkeypatch.setattr(feed, "_HASH_BITS", 3)  # eight lines a stamp
    folder = put(os.path.join(scratch_dir, "in"), {
        "a.json": (0, unit_lines(0, 30)), "b.json": (0.001, unit_lines(30, 2)), "c.json": (0.005, unit_lines(32, 3))})
    rows = sorted(ingest(spark, folder).reports.select("seq", "id").collect())
    first = BASE * 1000 << 3
    assert [r.seq for r in rows] == [*range(first, first + 32), *range(first + 40, first + 43)]
    assert [int(r.id) for r in rows] == list(range(35))


def test_later_file_wins_across_ingests(spark, scratch_dir):
    """Equal stamps: the report of the file that came later is the latest, whichever was read first."""
    old = put(os.path.join(scratch_dir, "old"), {"b.json": (0, [*unit_lines(500, 50), *msgs([rec(1, delay=5, t=9000), rec(1, delay=6, t=9000)])])})
    new = put(os.path.join(scratch_dir, "new"), {"a.json": (60, msgs([rec(1, delay=7, t=9000)]))})
    table = os.path.join(scratch_dir, "table")
    for name, folder in (("0", new), ("1", old)):
        write_report_tables(ingest(spark, folder, materialize_parse=True), table, ingest_id=name)
    assert [(r.id, r.delay) for r in q.top_delayed(read_report_table(spark, table)).collect()] == [("1", 7.0)]


def test_later_file_wins_on_a_stream(spark, scratch_dir):
    folder = put(os.path.join(scratch_dir, "in"), {f"{9 - k}.json": (k, msgs([rec(1, delay=k + 1, t=9000)])) for k in range(6)})
    for files in (1, 6):  # one file a micro-batch, or all in one
        reports = parse_messages(read_feed_stream(spark, folder, max_files_per_trigger=files)).reports
        df, mode = sq.top_delayed_stream(reports)
        last = run_collect(df, mode, os.path.join(scratch_dir, f"ck{files}"))[-1]
        assert [(r["id"], r["delay"]) for r in last] == [("1", 6.0)]


def test_no_files_with_lines(spark, scratch_dir):
    folder = put(os.path.join(scratch_dir, "in"), {"a.json": (0, [])})
    got = ingest(spark, folder, materialize_parse=True)
    assert [r.isinactive for r in got.reports.collect()] == [""] and got.quarantine.count() == 1
